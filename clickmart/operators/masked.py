"""Top-k items per user by inner product, without the items that a user has seen.

Item vectors are ordered by length and cut into blocks, users are dealt into blocks by hash and carry the sorted
lists of what they have seen.  A task holds one block of users and streams item blocks from the longest vectors on,
with the running k best of each user: seen items are masked in the product, so nobody ranks more than k, however
much was seen.  No score can exceed the product of two lengths, so a block of users first meets the ``FIRST``
blocks, and then only those that are long enough for one of its users' k-th best score.

The driver sees one row per block: at most ``MAX_BLOCKS`` of either kind, beyond which blocks grow.  Among equal
scores the smaller item comes first.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.operators.similarity import Best, stacked
from clickmart.storage import materialize

BLOCK = 4_096
MAX_BLOCKS = 65_536
FIRST = 2
PART_BLOCKS = 64
#: rounding of a product against that of the lengths
SLACK = 1e-6
_PAIRS = "a long, part int, place int, b int, bound double"
_KEPT = "user int, item int, rating float"


def _length():
    return F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def _size(n: int) -> int:
    return max(BLOCK, -(-n // MAX_BLOCKS))


def _item_blocks(items: DataFrame) -> DataFrame:
    """b, bound (longest vector), ids, vectors; the longest vectors in the first blocks; written."""
    n = items.count()
    ranged = items.withColumn("length", _length()).repartitionByRange(
        max(1, -(-n // _size(n))), F.desc("length"), "id"
    )
    dealt = materialize(ranged.withColumn("b", F.spark_partition_id()), "masked-items")
    rows = F.sort_array(F.collect_list(F.struct("id", "vector"))).alias("rows")
    packed = dealt.groupBy("b").agg(F.max("length").alias("bound"), rows)
    return materialize(
        packed.select("b", "bound", F.col("rows.id").alias("ids"), F.col("rows.vector").alias("vectors")), "masked-blocks"
    )


def _user_blocks(users: DataFrame, seen: DataFrame) -> DataFrame:
    """a, ids, vectors, seen (a sorted list per user); users of length zero apart from the others; written."""
    n = users.count()
    lists = seen.groupBy(F.col("user").alias("id")).agg(F.array_sort(F.collect_set("item")).alias("seen"))
    zero = (_length() == 0).cast("long")
    block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // _size(n))))) * 2 + zero
    rows = users.join(lists, "id", "left").withColumn(
        "seen", F.coalesce("seen", F.array().cast("array<int>"))
    ).withColumn("a", block)
    packed = rows.groupBy("a").agg(F.collect_list(F.struct("id", "vector", "seen")).alias("rows"))
    return materialize(
        packed.select("a", F.col("rows.id").alias("ids"), F.col("rows.vector").alias("vectors"), F.col("rows.seen").alias("seen")),
        "masked-users",
    )


def _lister(blocks: list[tuple[int, float]], limit: int | None):
    """Item blocks that a block of users meets, from the longest vectors on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b, bound = (np.array(x) for x in zip(*blocks, strict=True))
        for batch in batches:
            for a, threshold in zip(batch["a"], batch["threshold"], strict=True):
                wanted = np.arange(min(limit, len(b))) if limit else np.flatnonzero(bound >= threshold - SLACK)
                place = np.arange(len(wanted))
                yield pd.DataFrame({
                    "a": a, "part": place * 0 if limit else place // PART_BLOCKS, "place": place, "b": b[wanted], "bound": bound[wanted],
                })

    return run


class _Users(Best):
    """A block of users with what they have seen."""

    def __init__(self, ids, vectors, seen, k: int):
        super().__init__(ids, vectors, k)
        lists = [np.asarray(s, np.int64) for s in seen]
        self.seen_rows = np.repeat(np.arange(len(lists)), [len(s) for s in lists])
        self.seen_items = np.concatenate(lists) if lists else np.empty(0, np.int64)
        self.length = np.linalg.norm(self.vectors, axis=1)

    def meet(self, ids, vectors) -> None:
        others = np.asarray(list(ids))
        score = self.vectors @ stacked(vectors).T
        at = np.searchsorted(others, self.seen_items)
        here = at < len(others)
        here[here] = others[at[here]] == self.seen_items[here]
        score[self.seen_rows[here], at[here]] = -np.inf
        self.offer(others, score)

    def threshold(self) -> float:
        """Length below which no vector can reach the k-th best score of any user."""
        return float(np.min(np.divide(self.kth, self.length, out=np.full(len(self.kth), -np.inf), where=self.length > 0)))


def _meetings(k: int, thresholds: bool):
    def result(a: int, best: _Users) -> pd.DataFrame:
        if thresholds:
            return pd.DataFrame({"a": [a], "threshold": [best.threshold()]})
        others = best.ids[:0] if best.others is None else best.others
        return pd.DataFrame({"user": best.ids[best.rows], "item": others, "rating": best.score.astype(np.float32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, a = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.place < 0:
                    if best is not None:
                        yield result(a, best)
                    best, a = _Users(row.ids, row.vectors, row.seen, k), row.a
                elif row.bound >= best.threshold() - SLACK:
                    best.meet(row.ids, row.vectors)
        if best is not None:
            yield result(a, best)

    return run


def _streams(users: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    none = F.array().cast("array<array<int>>")
    heads = pairs.select("a", "part").distinct().join(users, "a").select(
        "a", "part", F.lit(-1).alias("place"), F.lit(0.0).alias("bound"), "ids", "vectors", "seen"
    )
    others = pairs.join(items.drop("bound"), "b").select(
        "a", "part", "place", "bound", "ids", "vectors", none.alias("seen")
    )
    return heads.unionByName(others).repartition("a", "part").sortWithinPartitions("a", "part", "place")


def plan_meetings(users: DataFrame, items: DataFrame, seen: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Blocks of users and items, and which of them meet (a, part, place, b, bound)."""
    spark = users.sparkSession
    item_blocks, user_blocks = _item_blocks(items), _user_blocks(users, seen)
    known = sorted((r.b, r.bound) for r in item_blocks.select("b", "bound").collect())
    tasks = user_blocks.select("a", F.lit(float("-inf")).alias("threshold"))
    if not known:
        return user_blocks, item_blocks, spark.createDataFrame([], _PAIRS)
    if len(known) > FIRST:
        first = tasks.mapInPandas(_lister(known, FIRST), _PAIRS)
        tasks = materialize(
            _streams(user_blocks, item_blocks, first).mapInPandas(_meetings(k, True), "a long, threshold double"),
            "masked-thresholds",
        )
    return user_blocks, item_blocks, materialize(tasks.mapInPandas(_lister(known, None), _PAIRS), "masked-pairs")


def masked_topk(users: DataFrame, items: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """``user, item, rating``: the k best items of every user that it has not seen.

    ``users`` and ``items`` have ``id`` (int) and ``vector``; ``seen`` has ``user`` and ``item``.
    """
    user_blocks, item_blocks, pairs = plan_meetings(users, items, seen, k)
    partial = _streams(user_blocks, item_blocks, pairs).mapInPandas(_meetings(k, False), _KEPT)
    best = W.partitionBy("user").orderBy(F.desc("rating"), "item")
    # the parts of a long list of blocks have k each
    return partial.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k).drop("_rank")
