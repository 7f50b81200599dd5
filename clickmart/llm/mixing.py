"""Mixing sources to target weights.

Words are aggregated per source; a source's target divided by its size is its
repetition rate; a document is emitted floor(rate) times, and once more when a hash
of the document, read as a number in [0, 1), is below the fraction of the rate.
The decision depends on the row and its source alone, so reruns and recomputed
tasks agree, and no document moves before the one projection that emits it.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating; they
share ``budget`` times all words by weight; a target stops at ``cap`` times its
source's size and the excess is shared again by weight.

Nulls and edges: a null text has size 0; null is a source of its own; a source
without words has target 0 and rate 0, so its documents are not taken; repeated
rows draw alike; an empty table gives an empty result; further columns are carried.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialize, positions, uniform, word_count

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2.0
SEED = 20_817


def sized(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of every row with its source, word count and uniform draw."""
    draw = uniform(F.lit(SEED), F.col("doc_id"), F.col("text"))
    return docs.select(
        *columns, "source", word_count(F.col("text")).alias("size"), draw.alias("draw")
    )


def _level(ranked: DataFrame, goal: float, cap: float) -> float:
    """Words per unit of weight once no target exceeds its cap.

    Every round caps the sources above the level and shares what is left among the
    others; the driver sees two sums a round.
    """
    level, before = 0.0, None
    ceiling = F.col("source_size") * F.lit(cap)
    while True:
        over = ceiling <= F.lit(level) * F.col("weight")
        row = ranked.agg(
            F.sum(F.when(over, F.col("source_size")).otherwise(F.lit(0))).alias("capped"),
            F.sum(F.when(over, F.lit(0)).otherwise(F.col("weight"))).alias("open"),
        ).first()
        state = (row.capped or 0, row.open or 0)
        if state == before or not state[1]:
            return level
        level, before = (goal - cap * state[0]) / state[1], state


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, cap: float = CAP
) -> DataFrame:
    """One row per source: source, source_size, target, rate; written once."""
    if not 0 < budget <= cap:
        raise ValueError("the budget must be positive and not above the cap")
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = positions(per_source, [F.col("source").asc_nulls_last()], "rank", "mix-sources")
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.get(cycle, F.pmod(F.col("rank"), F.lit(len(weights))).cast("int"))
    ranked = materialize(placed.select("source", "source_size", weight.alias("weight")), "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = _level(ranked, budget * total, cap)
    target = F.least(F.lit(level) * F.col("weight"), F.lit(cap) * F.col("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = ranked.select("source", "source_size", target.alias("target")).withColumn("rate", rate)
    return materialize(shares, "mix-targets")


def copies(rate: Column, draw: Column) -> Column:
    """floor(rate), and one more when the draw is below the fraction."""
    whole = F.floor(rate)
    return (whole + (draw < rate - whole).cast("int")).cast("int")


def _joined(rows: DataFrame, shares: DataFrame) -> DataFrame:
    # one small row per source: Spark broadcasts it below its own size limit, and
    # splits the partitions of a large source beyond
    side = shares.withColumnRenamed("source", "mix_source")
    return rows.join(side, F.col("source").eqNullSafe(F.col("mix_source"))).drop("mix_source")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    sizes = materialize(sized(docs, "doc_id"), "mix-sizes")
    taken = F.col("size") * copies(F.col("rate"), F.col("draw"))
    return _joined(sizes, targets(sizes)).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs``."""
    shares = targets(sized(docs))
    draw = uniform(F.lit(SEED), F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct("*").alias("doc"), "source", draw.alias("draw"))
    times = F.array_repeat(F.lit(0), copies(F.col("rate"), F.col("draw")))
    return (
        _joined(rows, shares)
        .select("doc", F.explode(times).alias("copy"))
        .select("doc.*")
    )
