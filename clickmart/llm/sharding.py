"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows of each partition are permuted locally (a sort by hash within the
partition) and written, which fixes partitions and local positions.  How many rows
of partition i go to shard j is drawn exactly: row i of the matrix is multivariate
hypergeometric given what the shards still have room for, so a draw of the whole
matrix is distributed as in a uniform permutation of all rows.  The first M[i][0]
rows of the permuted partition go to shard 0, the next M[i][1] to shard 1, and so
on.  After the exchange the rows of a shard are permuted again: a second hash puts
them into cells of bounded size, and the slot is the cell's offset plus the rank in
the cell.

The driver holds the matrix only, partitions x shards integers; no row passes it.
A shard is never in one task: its cells are.

Nulls and edges: rows with null id or null text are sharded like others; a null
text has size 8 and null crc; equal rows are dealt independently by their places;
empty input gives an empty result; with fewer rows than shards some shards stay
empty.  Further columns are carried, whatever their names.
"""

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.llm.common import local_order, materialize, part_of, row_of

SHARDS = 24
SEED = 5_113
CELL_ROWS = 65_536
BOUNDS_BYTES = 64 << 20


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Exact draw: inversion that starts at the mode and walks outward by ratios."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = rng.random() - at_mode
    up = down = mode
    p_up = p_down = at_mode
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows of partition i that go to shard j, for shard sizes at most one apart."""
    rng = random.Random(seed)
    total = sum(sizes)
    larger = set(rng.sample(range(shards), total % shards))
    room = [total // shards + (j in larger) for j in range(shards)]
    matrix = []
    for size in sizes:
        others, row = sum(room), []
        for j in range(shards):
            others -= room[j]
            row.append(hypergeometric(rng, room[j], others, size))
            size -= row[-1]
            room[j] -= row[-1]
        matrix.append(row)
    return matrix


def _bounds(spark, counts, shards: int, seed: int) -> DataFrame:
    """Per partition the local positions at which shards 1, 2, ... begin; written.

    Broadcast up to ``BOUNDS_BYTES``, so that the rows move once, to their shards.  Beyond that, at some
    hundred thousand partitions, Spark joins it as it sees fit.
    """
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    rows = []
    for (part, _), row in zip(counts, matrix, strict=True):
        ends = [sum(row[: j + 1]) for j in range(shards - 1)]
        rows.append((part, ends))
    bounds = materialize(spark.createDataFrame(rows, "part long, ends array<long>"), "shard-bounds")
    return F.broadcast(bounds) if len(rows) * (shards + 4) * 8 <= BOUNDS_BYTES else bounds


def shuffle(
    df: DataFrame, keys: list[str], shards: int = SHARDS, seed: int = SEED,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``df`` with shard (int, 0 to shards - 1) and slot (long, gapless from 0).

    ``keys`` and the row's place seed the local permutation: copies of a row are dealt
    independently of each other.
    """
    spark = df.sparkSession
    own = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys], F.monotonically_increasing_id())
    rows = df.select(F.struct("*").alias("doc"), own.alias("key"))
    placed = materialize(local_order(rows, ["key"], "at").drop("key"), "shard-local")
    # one row per partition
    counted = placed.groupBy(part_of(F.col("at")).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r.part, r.n) for r in counted.collect())
    total = sum(n for _, n in counts)
    cells = max(1, math.ceil(total / shards / cell_rows))
    bounds = _bounds(spark, counts, shards, seed)

    second = F.xxhash64(F.lit(seed + 1), F.col("at"))
    sent = (
        placed.withColumn("part", part_of(F.col("at")))
        .join(bounds, "part")
        .withColumn(
            "shard", F.size(F.filter("ends", lambda end: end <= row_of(F.col("at")))).cast("int")
        )
        .select("doc", "at", "shard", second.alias("second"))
        .withColumn("cell", F.pmod("second", F.lit(cells)))
    )
    in_cell = sent.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialize(
        in_cell.select(
            "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
        ),
        "shard-cells",
    )
    rank = F.row_number().over(W.partitionBy("shard", "cell").orderBy("second", "at"))
    return (
        sent.withColumn("rank", rank.cast("long"))
        .join(offsets, ["shard", "cell"])
        .select("doc.*", "shard", (F.col("before") + F.col("rank") - 1).alias("slot"))
    )


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns: sizes, checksums and places of all documents."""
    thin = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode("text", "utf-8")).cast("long").alias("text_crc32"),
    )
    return shuffle(thin, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def place(docs: DataFrame) -> DataFrame:
    """``docs`` with their shard and slot; columns of these names are replaced."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return shuffle(docs.select(*kept), ["doc_id", "text"])
