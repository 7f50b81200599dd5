"""Global ranks without a global window.

``ntile`` over an unpartitioned window moves every row into one task.  Both
operators here range-partition the keys instead and keep on the driver only a few
values per shuffle partition, never a row per key.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.storage import materialize

_VALUE = "decimal(38,6)"
_MAX_INT = 2**31 - 1


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _key_at_or_after(value: Column, tie: Column, bound) -> Column:
    return (value > bound.v) | ((value == bound.v) & (tie >= bound.id))


def _bucket_starts(n: int, k: int) -> list[int]:
    """0-based rank of the first row of buckets 2..k; the first n % k get one row more."""
    size, extra = divmod(n, k)
    starts = [b * size + min(b, extra) for b in range(1, k)]
    return [s for s in starts if s < n]


def ntile(
    df: DataFrame, k: int, tie: str, orders: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """``ntile(k)`` for several numeric orders at once.

    ``orders`` maps a new column to (column, ``asc`` or ``desc``); ``tie`` is a
    unique column that breaks ties upwards.  Only the k-1 keys that open a bucket
    are needed, so the result is a projection: one job counts the range
    partitions, one picks the opening keys out of the partitions that hold them.
    ``df`` is read three times; hand in a written table.
    """
    sides = list(orders.values())
    values = {
        m: (F.col(c) if way == "asc" else -F.col(c)).cast(_VALUE)
        for m, (c, way) in enumerate(sides)
    }
    pairs = F.array(*[F.struct(F.lit(m).alias("m"), v.alias("v")) for m, v in values.items()])
    thin = df.select(F.col(tie).alias("id"), F.inline(pairs))
    key = F.struct("v", "id")

    counted = (
        thin.repartitionByRange(_partitions(df), "m", "v", "id")
        .groupBy(F.spark_partition_id().alias("p"), "m")
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        .collect()
    )
    wanted = []  # (m, rank within the part, part)
    for m in values:
        parts = sorted((r for r in counted if r.m == m), key=lambda r: r.low)
        for start in _bucket_starts(sum(r.n for r in parts), k):
            before = 0
            for part in parts:
                if start < before + part.n:
                    wanted.append((m, start - before, part))
                    break
                before += part.n
    bounds = _rows_at(thin, key, wanted)

    scores = {}
    for m, name in enumerate(orders):
        score = F.lit(1)
        for bound in bounds.get(m, []):
            score = score + _key_at_or_after(values[m], F.col(tie), bound).cast("int")
        scores[name] = score.cast("int")
    return df.withColumns(scores)


def _rows_at(thin: DataFrame, key: Column, wanted: list) -> dict[int, list]:
    """Fetch the rows with a given rank inside a given key range, per order ``m``."""
    if not wanted:
        return {}
    ranges = {(m, part.low): part for m, _, part in wanted}
    inside = F.lit(None).cast("int")
    for i, ((m, _), part) in enumerate(ranges.items()):
        low, high = (
            F.struct(
                F.lit(b.v).cast(_VALUE).alias("v"),
                F.lit(b.id).cast(thin.schema["id"].dataType).alias("id"),
            )
            for b in (part.low, part.high)
        )
        hit = (F.col("m") == m) & (key >= low) & (key <= high)
        inside = F.when(hit, F.lit(i)).otherwise(inside)
    index = {bounds: i for i, bounds in enumerate(ranges)}
    hits = F.lit(False)
    for m, rank, part in wanted:
        hits = hits | ((F.col("g") == index[(m, part.low)]) & (F.col("r") == rank + 1))
    rows = (
        thin.withColumn("g", inside)
        .filter(F.col("g").isNotNull())
        .withColumn("r", F.row_number().over(W.partitionBy("g").orderBy("v", "id")))
        .filter(hits)
        .collect()
    )
    return {m: [r for r in rows if r.m == m] for m, _, _ in wanted}


def integer_ids(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """Distinct values of ``column`` with dense integers from 0 in ``id_column``.

    The numbering is fixed by writing the table once; the offsets per written
    partition (one row per partition) are all that is broadcast.
    """
    numbered = materialize(
        df.select(column).distinct().withColumn("_m", F.monotonically_increasing_id()),
        f"ids-{column}",
    )
    split = numbered.select(
        column,
        F.shiftright("_m", 33).alias("_p"),
        F.col("_m").bitwiseAND(F.lit(2**33 - 1)).alias("_i"),
    )
    sizes = {r._p: r.n for r in split.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(sizes.values()) > _MAX_INT:
        raise ValueError(f"more than {_MAX_INT} distinct values in {column}")
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets.append((part, total))
        total += sizes[part]
    table = df.sparkSession.createDataFrame(offsets, "_p bigint, _offset bigint")
    return split.join(F.broadcast(table), "_p").select(
        column, (F.col("_offset") + F.col("_i")).cast("int").alias(id_column)
    )
