"""Quality rules with a robust multivariate outlier test.

Per language and source the minimum covariance determinant of a transformed
statistic vector is estimated, and documents far from the centre in Mahalanobis
distance are rejected.

Vector (fixed values): logarithm of the mean word length, square root of symbols
per word character, repeated lines per line, repeated words per word.  Each is
divided by its floor, the standard deviation below which a difference is not worth
a rejection, and rounded to 1/64: sums of whole numbers are exact in any order, so
a recomputed task can't change a verdict.

Estimation: starts from the exact coordinate-wise median and from the classical
estimate; every C-step sums, per (group, start, bin of distance), counts and
moments, and takes bins up to the one that completes three quarters of the group.
One pass per step, map-side combined, a few hundred bins per group at most: a
source with a third of all rows shuffles no more than a small one.  The start with
the smaller determinant wins.

Documents that fail a base rule (under 50 words, or more than half of the words in
repeated three-word windows) are no input of the estimates.  A language and source with
fewer than ``MIN_ROWS`` others is judged by the estimate of all rows of its language, or
of all rows if these are too few as well; a table with fewer rejects none.

Nulls and edges: a null or empty text has no words and fails the base rule; null
language or source is a group of its own; ties of distance stay together; repeated
rows are judged alike; an empty table gives an empty result.
"""

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.llm.common import NON_BREAK, let, materialize, words

SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
#: standard deviations below which differences don't count
FLOORS = (0.1, 0.05, 0.1, 0.1)
UNIT = 64
DIMS = len(FLOORS)
SHARE = 0.75
#: makes the scatter of the inner three quarters consistent for normal data, 4 dimensions
CONSISTENCY = 1.486
#: chi-square quantile 0.9999, 4 degrees of freedom
CUT = 23.51
MIN_ROWS = 40
VECTOR_ROWS = 50_000
STEPS = 3
BINS_PER_OCTAVE = 16
KEYS = ["lang", "source"]
#: an estimate's group: 0 language and source, 1 language, 2 everything
GROUP = ["level", "g_lang", "g_source"]
_X = [f"x{i}" for i in range(DIMS)]
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _repeat_words(tokens: Column, n: Column) -> Column:
    """Words in three-word windows that occur twice or more."""

    def hashes(w):
        return F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )

    def covered(windows):
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def repeated(s):
            def twice(x, i):
                before = F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                return before | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

            return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["p"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            let(ordered, repeated),
            start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    def count(windows):
        # most texts repeat nothing: no sort for them
        none = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(none, F.lit(0)).otherwise(covered(windows))

    return F.when(n >= 3, let(let(tokens, hashes), count)).otherwise(F.lit(0))


def statistics(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns``, lang, source, base statistics, base_failed and the vector of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = (
        docs.select(*columns, *KEYS, words(F.col("text")).alias("w"), text.alias("t"))
        .withColumn("n", F.size("w"))
        .select(
            *columns, *KEYS,
            F.col("n").cast("long").alias("n_words"),
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("t", SYMBOLS, "")).cast("long").alias("n_symbols"),
            let(
                F.filter(F.split("t", "\n"), lambda line: line.rlike(NON_BREAK)),
                lambda kept: F.struct(
                    F.size(kept).alias("n"), (F.size(kept) - F.size(F.array_distinct(kept))).alias("dup")
                ),
            ).alias("lines"),
            _repeat_words(F.col("w"), F.col("n")).cast("long").alias("n_repeat_words"),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = (
        F.log(chars / n),
        F.sqrt(F.col("n_symbols") / chars),
        F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        F.col("n_repeat_words") / n,
    )
    vector = [
        F.round(v * F.lit(UNIT / floor)).cast("long").alias(x)
        for v, floor, x in zip(values, FLOORS, _X, strict=True)
    ]
    return (
        base.withColumn("n_dup_lines", F.col("lines.dup").cast("long"))
        .withColumn("n_lines", F.col("lines.n").cast("long"))
        .select(
            *columns, *KEYS, "n_words", "word_chars", "n_symbols", "n_dup_lines",
            "n_repeat_words", failed.alias("base_failed"), *vector,
        )
    )


def _same(columns: list[str], others: list[str]) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(columns, others, strict=True)]
    return functools.reduce(Column.__and__, pairs)


def _join_small(rows: DataFrame, side: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows with the columns of their group in ``side``, nulls being equal.

    ``side`` has one row per group and no hint: Spark broadcasts it below its size limit
    and splits the rows of a large group beyond it.
    """
    side = side.withColumnsRenamed({k: f"side_{k}" for k in keys})
    others = [f"side_{k}" for k in keys]
    return rows.join(side, _same(keys, others), how).drop(*others)


def _places(stats: DataFrame) -> tuple[DataFrame, int]:
    """The group that judges each language and source, written; rows that pass the base rules."""
    passed = F.count(F.when(~F.col("base_failed"), 1))
    counts = _small(stats.groupBy(*KEYS).agg(passed.alias("n")), "mcd-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    of_lang = F.sum("n").over(W.partitionBy("lang"))
    level = (
        F.when(F.col("n") >= MIN_ROWS, 0)
        .when(F.col("of_lang") >= MIN_ROWS, 1)
        .otherwise(2 if total >= MIN_ROWS else 3)
    )
    places = _small(
        counts.withColumn("of_lang", of_lang).select(*KEYS, level.alias("level")).select(
            *KEYS, "level",
            F.when(F.col("level") < 2, F.col("lang")).alias("g_lang"),
            F.when(F.col("level") < 1, F.col("source")).alias("g_source"),
        ),
        "mcd-places",
    )
    return places, total


def _small(df: DataFrame, label: str) -> DataFrame:
    """A written table with one row per group, in few files."""
    return materialize(df.coalesce(8), label)


def _grouped(stats: DataFrame, places: DataFrame, total: int) -> DataFrame:
    """Vectors of the rows that pass the base rules, once per group that they inform; written.

    A vector takes a hundredth of its text, so there are fewer partitions than of texts.
    """
    text = stats.schema["lang"].dataType, stats.schema["source"].dataType
    none = [F.lit(None).cast(t) for t in text]
    groups = F.array(*[
        F.struct(
            F.lit(level).alias("level"),
            (F.col("lang") if level < 2 else none[0]).alias("g_lang"),
            (F.col("source") if level < 1 else none[1]).alias("g_source"),
        )
        for level in range(3)
    ])
    rows = stats.filter(~F.col("base_failed")).select(F.inline(groups), *_X)
    informed = _join_small(rows, places.select(*GROUP).distinct(), GROUP, "left_semi")
    parts = max(1, math.ceil(total / VECTOR_ROWS))
    return materialize(informed.coalesce(parts), "mcd-vectors")


def _factor(params: DataFrame) -> DataFrame:
    """Lower Cholesky factor l_ij of the scatter s_ij plus the squared floors."""
    for j in range(DIMS):
        diagonal = F.col(f"s{j}{j}") + F.lit(float(UNIT**2))
        for k in range(j):
            diagonal = diagonal - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        # the floors keep it positive; rounding may not
        params = params.withColumn(f"l{j}{j}", F.sqrt(F.greatest(diagonal, F.lit(1.0))))
        for i in range(j + 1, DIMS):
            rest = F.col(f"s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            params = params.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    spread = F.lit(1.0)
    for j in range(DIMS):
        spread = spread * F.col(f"l{j}{j}")
    return params.withColumn("spread", spread)


_PARAMS = [f"m{i}" for i in range(DIMS)] + [f"l{i}{j}" for i, j in _PAIRS] + ["spread"]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i in range(DIMS):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    total = z[0] * z[0]
    for x in z[1:]:
        total = total + x * x
    return total


def _moments() -> list[Column]:
    sums = [F.sum(x).alias(f"t_{x}") for x in _X]
    return sums + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"t_{i}{j}") for i, j in _PAIRS]


_TOTALS = [f"t_{x}" for x in _X] + [f"t_{i}{j}" for i, j in _PAIRS]


def _estimate(totals: DataFrame, factor: float) -> DataFrame:
    """Centre and scatter from n and the sums of values and products."""
    n = F.col("n")
    means = {f"m{i}": F.col(f"t_x{i}") / n for i in range(DIMS)}
    scatter = {
        f"s{i}{j}": (F.col(f"t_{i}{j}") / n - F.col(f"t_x{i}") / n * F.col(f"t_x{j}") / n)
        * F.lit(factor)
        for i, j in _PAIRS
    }
    return _factor(totals.withColumns({**means, **scatter})).select(*GROUP, "start", *_PARAMS)


def _c_step(rows: DataFrame, params: DataFrame, label: str) -> DataFrame:
    """Estimates from the nearest three quarters of each group, for each start."""
    bin_of = F.floor(F.log2(F.lit(1.0) + _distance()) * BINS_PER_OCTAVE).cast("int")
    bins = (
        _join_small(rows, params, GROUP, "inner")
        .groupBy(*GROUP, "start", bin_of.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), *_moments())
    )
    w = W.partitionBy(*GROUP, "start")
    before = F.coalesce(
        F.sum("n").over(w.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    inner = bins.withColumn("before", before).withColumn("total", F.sum("n").over(w))
    totals = (
        inner.filter(F.col("before") < F.lit(SHARE) * F.col("total"))
        .groupBy(*GROUP, "start")
        .agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in _TOTALS])
    )
    return _small(_estimate(totals, CONSISTENCY), label)


def _starts(rows: DataFrame) -> DataFrame:
    """The coordinate-wise median with the floors as scatter, and the classical estimate."""
    # exact: the values are whole numbers from a bounded range, counted before the shuffle
    medians = [F.percentile(x, 0.5).alias(f"m{i}") for i, x in enumerate(_X)]
    totals = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), *_moments(), *medians)
    totals = _small(totals, "mcd-totals")
    flat = {f"s{i}{j}": F.lit(0.0) for i, j in _PAIRS}
    robust = _factor(totals.withColumns({"start": F.lit(0), **flat})).select(
        *GROUP, "start", *_PARAMS
    )
    classical = _estimate(totals.withColumn("start", F.lit(1)), 1.0)
    return _small(robust.unionByName(classical), "mcd-start")


def fit(stats: DataFrame) -> DataFrame:
    """Centre and factor of the scatter that judge each language and source, written.

    The vectors are read once per step; hand in a written table.
    """
    places, total = _places(stats)
    rows = _grouped(stats, places, total)
    params = _starts(rows)
    for step in range(STEPS):
        params = _c_step(rows, params, f"mcd-{step}")
    first = F.row_number().over(W.partitionBy(*GROUP).orderBy("spread", "start"))
    best = params.withColumn("place", first).filter(F.col("place") == 1)
    return _small(
        _join_small(places, best.select(*GROUP, *_PARAMS), GROUP, "inner").select(*KEYS, *_PARAMS),
        "mcd",
    )


def judge(stats: DataFrame, params: DataFrame) -> DataFrame:
    """``stats`` with distance (null without an estimate) and kept."""
    far = F.coalesce(F.col("distance") > CUT, F.lit(False))
    return (
        _join_small(stats, params, KEYS, "left")
        .withColumn("distance", F.when(~F.col("base_failed"), _distance()))
        # as one condition: its first half would go below the join, with all statistics it needs
        .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~far))
        .drop(*_PARAMS)
    )


def digest(docs: DataFrame) -> DataFrame:
    stats = materialize(statistics(docs, "doc_id"), "quality-stats")
    return judge(stats, fit(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round(F.sqrt("distance"), 4).alias("distance"),
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were.

    The statistics are computed again on the way out, so no text is joined or moved.
    """
    params = fit(materialize(statistics(docs), "quality-stats"))
    rows = docs.select(F.struct("*").alias("doc"), "text", *KEYS)
    return judge(statistics(rows, "doc"), params).filter("kept").select("doc.*")
