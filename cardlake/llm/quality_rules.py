"""Quality rules: counts of each text, and robust outliers of what they say together.

The statistics of a text, transformed to be about normal, make a vector. For each
language and source a minimum-covariance-determinant estimate (centre and scatter of
the half and more of the vectors that lie closest together) says what is usual, and
vectors too far from it by Mahalanobis distance are rejected. A text's own counting noise
is added to the scatter: what is said by a few words or lines says little, and a
statistic that is zero in nearly all texts has no scatter of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import SPACES, fresh, let, saved, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# Words that one repeat adds to those in repeated windows: three, and the three before.
REPEAT_WORDS = 6
# Share of the rows that the centre and scatter are taken from, and what makes the
# scatter of that share of normal vectors in 4 dimensions a whole one: 0.75 over
# P(chi2 of 6 <= 5.3853), where 5.3853 is the 0.75 quantile of chi2 of 4.
SHARE = 0.75
CONSISTENCY = 0.75 / 0.5045
# 0.975 quantile of chi2 of 4: rows up to here make the last estimate.
REWEIGHT = 11.1433
# Squared distance beyond which a row is rejected: chi2 of 4 exceeds it once in ten million.
CUTOFF = 38.2
# Rows a language and source need for an estimate of their own.
MIN_ROWS = 25
STEPS = 3
# Up to so many estimates are broadcast (some 300 bytes each).
MAX_BROADCAST_GROUPS = 30_000

# Length of words, and shares of symbols, of copied lines and of repeated words.
_DIMENSIONS = range(4)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first one included.

    Texts whose windows all differ need no more than that check. For the others the
    windows are sorted with their places; neighbours that are equal give the places,
    and places closer than 3 share words. Windows are compared by 64-bit hash.
    """
    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def places(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            repeated = F.filter(
                ordered,
                lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["w"] == x["w"]))
                | ((i < last) & (F.get(ordered, i + 1)["w"] == x["w"])))
            return F.sort_array(F.transform(repeated, lambda x: x["i"]))

        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("words"))
        total = F.aggregate(
            let(pairs, places), start,
            lambda s, p: F.struct(
                p.alias("last"),
                (s["words"] + F.least(F.lit(3), p - s["last"])).alias("words")))
        return total["words"]

    def counted(words: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
        count = let(windows, lambda w: F.when(
            F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))
        return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(count)

    return let(words, counted)


def statistics(docs: DataFrame, text: str, carried: list[Column]) -> DataFrame:
    """``carried`` and the counts of each text; null counts as empty."""
    whole = text_or_empty(text)
    read = docs.select(*carried, whole.alias("_text"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    kept = [c for c in read.columns if c != "_text"]
    parts = read.select(
        *kept, words_of(F.col("_text")).alias("_words"), lines.alias("_lines"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, "")))
        .cast("long").alias("n_symbols"))
    counts = parts.select(
        *kept, F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """The transformed statistics, logarithm of a length and roots of shares, and the
    variance each has from counting alone: that of a root of a share k/n is 1/(4n)."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return [
        F.log(chars / words).alias("x0"),
        F.sqrt(F.col("n_symbols") / chars).alias("x1"),
        F.sqrt(F.col("n_dup_lines") / lines).alias("x2"),
        F.sqrt(F.col("n_repeat_words") / words).alias("x3"),
        (0.25 / words).alias("v0"), (0.25 / chars).alias("v1"), (0.25 / lines).alias("v2"),
        (0.25 * REPEAT_WORDS / words).alias("v3"),
    ]


def _group_key(level: int, lang: Column | None, source: Column | None) -> Column:
    parts = [F.lit(level).alias("level")]
    parts += [] if lang is None else [lang.cast("string").alias("lang")]
    parts += [] if source is None else [source.cast("string").alias("source")]
    return F.to_json(F.struct(*parts))


def _group_table(rows: DataFrame, min_rows: int) -> DataFrame:
    """(own, grp): the group each language and source is judged with.

    Its own where it has ``min_rows``; else the small sources of its language
    together, and if these are too few, all that is left over.
    """
    own = rows.groupBy("own", "pooled").agg(F.count("*").alias("n"))
    small = own.filter(F.col("n") < min_rows)
    pooled = small.groupBy("pooled").agg(F.sum("n").alias("n_pooled"))
    return own.join(pooled, "pooled", "left").select("own", F.when(
        F.col("n") >= min_rows, F.col("own")).when(
        F.col("n_pooled") >= min_rows, F.col("pooled")).otherwise(
        F.lit("rest")).alias("grp"))


def _joined(rows: DataFrame, table: DataFrame, key: str, size: int, how: str = "inner") -> DataFrame:
    """Rows with their group's line of a table of ``size`` lines, broadcast where small."""
    return rows.join(F.broadcast(table) if size <= MAX_BROADCAST_GROUPS else table, key, how)


def _with_distance(rows: DataFrame) -> DataFrame:
    """``rows`` (x*, v*, m*, s*) with ``far``: the squared Mahalanobis distance by the
    scatter s plus the row's own noise v, by the Cholesky factor of that sum.

    Step by step with ``let``: written out, the factor's terms would fill a page of code
    for each row.
    """
    size = len(_DIMENSIONS)

    def column(j: int, before: list[Column], far: Column) -> Column:
        """``far`` with what column j of the factor and the places after it add. ``before``:
        of each column, its values from the diagonal down, and its coordinate."""
        if j == size:
            return far

        def left(i: int) -> Column:
            rest = F.col(f"s{i}{j}") + F.col(f"v{i}") if i == j else F.col(f"s{i}{j}")
            for k, known in enumerate(before):
                rest = rest - known[i - k] * known[j - k]
            return rest

        away = F.col(f"x{j}") - F.col(f"m{j}")
        for k, known in enumerate(before):
            away = away - known[j - k] * known[size - k]
        return let(F.sqrt(F.greatest(left(j), F.lit(1e-12))), lambda root: let(
            F.array(root, *[left(i) / root for i in range(j + 1, size)], away / root),
            lambda new: column(j + 1, [*before, new], far + new[size - j] * new[size - j])))

    return rows.withColumn("far", column(0, [], F.lit(0.0)))


def _moments(near: DataFrame, factor: float) -> DataFrame:
    """(grp, m*, s*) of the rows, scatter times ``factor``.

    Products are summed about the estimate before, so that nothing large cancels.
    """
    shifted = {i: F.col(f"x{i}") - F.col(f"m{i}") for i in _DIMENSIONS}
    sums = [F.avg(shifted[i]).alias(f"d{i}") for i in _DIMENSIONS]
    sums += [F.first(f"m{i}").alias(f"m{i}") for i in _DIMENSIONS]
    sums += [F.avg(shifted[i] * shifted[j]).alias(f"p{i}{j}")
             for i in _DIMENSIONS for j in range(i + 1)]
    table = near.groupBy("grp").agg(*sums)

    def scatter(i: int, j: int) -> Column:
        value = (F.col(f"p{i}{j}") - F.col(f"d{i}") * F.col(f"d{j}")) * factor
        return value.alias(f"s{i}{j}")

    return table.select(
        "grp", *[(F.col(f"m{i}") + F.col(f"d{i}")).alias(f"m{i}") for i in _DIMENSIONS],
        *[scatter(i, j) for i in _DIMENSIONS for j in range(i + 1)])


def fit(measured: DataFrame, min_rows: int = MIN_ROWS, steps: int = STEPS):
    """((own, grp) table, (grp, m*, s*) table, lines of each) from rows with ``own``, ``pooled``, ``x*``, ``v*``.

    Starts from medians and median deviations; each step takes the ``SHARE`` of a
    group's rows that lie nearest and estimates from them; the last takes all rows
    within the 0.975 quantile. Everything is grouped sums and mergeable quantiles.
    """
    groups = saved(_group_table(measured, min_rows))
    n_groups = groups.count()
    rows = _joined(measured, groups, "own", n_groups)

    def middle(column: Column, name: str) -> Column:
        return F.percentile_approx(column, 0.5, 10_000).alias(name)

    medians = saved(rows.groupBy("grp").agg(*[middle(F.col(f"x{i}"), f"m{i}") for i in _DIMENSIONS]))
    n_estimates = medians.count()
    spread = _joined(rows, medians, "grp", n_estimates).groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in _DIMENSIONS],
        *[middle(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), f"a{i}") for i in _DIMENSIONS])
    estimates = saved(spread.select(
        "grp", *(f"m{i}" for i in _DIMENSIONS),
        *[(F.pow(1.4826 * F.col(f"a{i}"), F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"s{i}{j}")
          for i in _DIMENSIONS for j in range(i + 1)]))
    for _ in range(steps):
        far = _with_distance(_joined(rows, estimates, "grp", n_estimates))
        bounds = saved(far.groupBy("grp").agg(
            F.percentile_approx("far", SHARE, 10_000).alias("bound")))
        near = _joined(far, bounds, "grp", n_estimates).filter("far <= bound")
        estimates = saved(_moments(near, CONSISTENCY))
    far = _with_distance(_joined(rows, estimates, "grp", n_estimates))
    estimates = saved(_moments(far.filter(F.col("far") <= REWEIGHT), 1.0))
    return groups, estimates, n_groups, n_estimates


def _with_groups(stats: DataFrame) -> DataFrame:
    return stats.select(
        "*", _group_key(0, F.col("_lang"), F.col("_source")).alias("own"),
        _group_key(1, F.col("_lang"), None).alias("pooled"), *vector())


def _judged(measured: DataFrame, model, cutoff: float) -> DataFrame:
    """``measured`` with ``far`` (null where no row gave an estimate) and ``kept``."""
    groups, estimates, n_groups, n_estimates = model
    known = _joined(measured, groups, "own", n_groups, "left")
    far = _with_distance(_joined(known, estimates, "grp", n_estimates, "left"))
    usual = F.coalesce(F.col("far") <= cutoff, F.lit(True))
    return far.withColumn("kept", ~F.col("base_failed") & usual)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measured(docs: DataFrame, text: str, lang: str, source: str, carried: list[Column]) -> DataFrame:
    carried = [*carried, F.col(lang).alias("_lang"), F.col(source).alias("_source")]
    return _with_groups(statistics(docs, text, carried))


def quality_verdicts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
    source: str = "source", cutoff: float = CUTOFF, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_failed, kept, distance.

    Fewer than 50 words, or more than half of them in repeated 3-word windows, fail
    the base rule; those rows do not take part in the estimates and are not kept. The
    others are kept unless their squared distance exceeds ``cutoff``. Null and empty
    texts have no word and fail. Null languages and sources are values of their own.
    Small groups are judged together (see ``_group_table``). Repeated rows count each;
    an empty table gives an empty answer; further columns of ``docs`` do not matter.
    """
    measured = saved(_measured(docs, text, lang, source, [F.col(doc_id).alias("doc_id")]))
    model = fit(measured.filter(~F.col("base_failed")), min_rows)
    return _judged(measured, model, cutoff).select(
        "doc_id", *COUNTS, "base_failed", "kept", F.sqrt("far").alias("distance"))


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    cutoff: float = CUTOFF, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """``docs`` without the rows ``quality_verdicts`` rejects, all columns as they are.

    The counts are made again beside the rows, which costs less than a shuffle of the
    texts by row.
    """
    measured = saved(_measured(docs, text, lang, source, []).filter(~F.col("base_failed"))
                     .select("own", "pooled", *(f"{c}{i}" for c in "xv" for i in _DIMENSIONS)))
    model = fit(measured, min_rows)
    whole = fresh(docs, "whole")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole)
    again = _measured(docs, text, lang, source, [row])
    kept = _judged(again, model, cutoff).filter("kept")
    return kept.select(*[F.col(whole)[c].alias(c) for c in docs.columns])
