import pytest

from cardlake.llm.common import ship
from cardlake.llm.queries import tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def tokenizer():
    return tokenizer_path()


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]), with further columns whose names
    the operators use themselves."""
    def made(rows, schema=DOC):
        rows = [(*r, *[None] * (5 - len(r))) for r in rows]
        docs = spark.createDataFrame(rows, schema)
        for name in ("row", "digest", "keep_id", "score", "kept", "shard", "_text", "word", "n"):
            docs = docs.selectExpr("*", f"'x' AS {name}")
        return docs
    return made


ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a"), (5, "a"), (None, "a"),
    (6, "word " * 30_000), (7, "x" * 50_000), (8, "¡ñandú! 漢字 😀"), (9, "1234 #$%"),
    (10, "  two  spaces \n lead"), (None, None),
]


@pytest.fixture(scope="session")
def odd(make):
    return make([(i, t, "en" if n % 2 else None, None) for n, (i, t) in enumerate(ODD_TEXTS)])


@pytest.fixture(scope="session")
def none(make):
    return make([])
