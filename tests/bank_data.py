"""A small made-up bank, as raw JSON records, holding the awkward cases."""

import json

STAMP = "2021-09-05T08:15:30.000-04:00"

BRANCHES = [
    dict(BRANCH_CODE=1, BRANCH_NAME="Hill Savings", BRANCH_STREET="Quarry Road", BRANCH_CITY="Fernley",
         BRANCH_STATE="OR", BRANCH_ZIP=40217, BRANCH_PHONE="9075551234", LAST_UPDATED=STAMP),
    dict(BRANCH_CODE=2, BRANCH_NAME="Hill Savings", BRANCH_STREET="Harbor Way", BRANCH_CITY="Millbrook",
         BRANCH_STATE="VT", BRANCH_ZIP=3068, BRANCH_PHONE="9075558", LAST_UPDATED=STAMP),
    dict(BRANCH_CODE=3, BRANCH_NAME="Hill Savings", BRANCH_STREET="Lane", BRANCH_CITY="Nowhere",
         BRANCH_STATE="OR", BRANCH_ZIP=None, BRANCH_PHONE=None, LAST_UPDATED=STAMP),
]


def _customer(ssn, first, middle, last, apartment, state, zip_code, phone, city="Lake"):
    return dict(
        SSN=ssn, FIRST_NAME=first, MIDDLE_NAME=middle, LAST_NAME=last,
        CREDIT_CARD_NO=str(4000000000000000 + ssn % 1000), APT_NO=apartment, STREET_NAME="Main St",
        CUST_CITY=city, CUST_STATE=state, CUST_COUNTRY="United States", CUST_ZIP=zip_code,
        CUST_PHONE=phone, CUST_EMAIL="someone@example.com", LAST_UPDATED=STAMP,
    )


CUSTOMERS = [
    _customer(123456001, "MARY-JANE", "ANN", "o'brien", "4", "OR", "03068", 2025550),
    _customer(123456002, "josé", None, "DE LA CRUZ", "12", "OR", "3068", 2025550147),
    _customer(123456003, "amy", "b", "stone", None, None, "40217", None),
    _customer(123456004, "no", "x", "purchases", "1", "VT", "40217", 2025550149),
]


def _paid(at, card, year, month, day, ssn, branch, kind, value):
    return dict(
        CREDIT_CARD_NO=str(4000000000000000 + card), YEAR=year, MONTH=month, DAY=day,
        CUST_SSN=ssn, BRANCH_CODE=branch, TRANSACTION_ID=at, TRANSACTION_TYPE=kind,
        TRANSACTION_VALUE=value,
    )


CREDITS = [
    _paid(1, 1, 2018, 2, 3, 123456001, 1, "Healthcare", 10.10),
    _paid(2, 1, 2018, 2, 14, 123456001, 2, "Gas", 20.20),
    _paid(3, 1, 2018, 2, 14, 123456001, 1, "Bills", 0.10),
    _paid(4, 2, 2018, 2, 28, 123456002, 1, "Healthcare", 30.40),
    _paid(5, 2, 2018, 10, 1, 123456002, 2, "Gas", None),
    _paid(6, 3, 2018, 11, 30, 123456003, 2, "Healthcare", 5.55),
    _paid(7, 9, 2018, 11, 30, 999999999, 2, "Healthcare", 100.0),  # unknown customer
    _paid(8, 1, 2018, 12, 30, 123456001, 99, "Healthcare", 0.01),  # unknown branch
    _paid(9, 2, 2018, 2, 30, 123456002, 2, "Gas", 0.01),           # no such day
]

LOANS = [
    dict(Application_ID="L1", Application_Status="Y", Self_Employed="Yes", Gender="Male",
         Married="Yes", Income="low"),
    dict(Application_ID="L2", Application_Status="N", Self_Employed="Yes", Gender="Female",
         Married="Yes", Income="high"),
    dict(Application_ID="L3", Application_Status="Y", Self_Employed="Yes", Gender="Male",
         Married="No", Income="high"),
    dict(Application_ID="L4", Application_Status="N", Self_Employed=None, Gender="Male",
         Married="Yes", Income="low"),
    dict(Application_ID="L5", Application_Status="N", Self_Employed="No", Gender=None,
         Married="Yes", Income="low"),
]


def write_lines(path, records, extra=()):
    path.write_text("".join(json.dumps(r) + "\n" for r in records) + "".join(extra))
    return str(path)


def write_bank(folder):
    """The four raw files; loans as one array over many lines."""
    loans = folder / "loan.json"
    loans.write_text(json.dumps(LOANS, indent=2))
    return {
        "branch": write_lines(folder / "branch.json", BRANCHES),
        "credit": write_lines(folder / "credit.json", CREDITS),
        "customer": write_lines(folder / "customer.json", CUSTOMERS),
        "loan": str(loans),
    }
