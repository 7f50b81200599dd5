"""Exact cosine top-k between items by blocked matrix products, without the blocks that can't matter.

1. Vectors are scaled to length one and written once, with the nearest of some pivots (far apart, out of
   vectors drawn by hash) and the angle to it.  Items of a pivot are cut by angle into blocks of about ``BLOCK_ITEMS``, so a block is a
   pivot and a range of angles.
2. On a sphere angles obey the triangle inequality: two blocks' pivots and ranges bound the similarity of any
   two of their items from above.
3. Every block first meets the few blocks with the highest bounds.  The worst k-th best similarity of its items is
   then a threshold: only blocks whose bound reaches it are met at all.
4. A task holds a group of neighbouring blocks and streams the others by falling bound, with the running k best of
   each item, and passes over what can't improve any.  A streamed block serves the whole group, so with about
   ``GROUPS`` groups (of up to ``GROUP_BLOCKS``) the traffic grows with the items and not with the pairs of blocks.
   Long lists of blocks are parts for several tasks; the best k of the parts are merged.

Of equal vectors only the k + 1 with the smallest ids can be anyone's neighbours, so copies never meet copies in
full.  The driver sees the pivots and one row per block, of which there are at most ``MAX_BLOCKS``: beyond
that blocks grow.  Vectors of length zero are similar to nothing (0); among equals the smaller id comes first.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.storage import materialize

BLOCK_ITEMS = 2048
MAX_BLOCKS = 65_536
MAX_PIVOTS = 1_024
#: vectors drawn per pivot
DRAWN = 8
#: blocks that are met to find the threshold; as few blocks are not worth a plan
FIRST = 3
#: blocks that one part streams at least, and parts of a list at most if it is longer
PART_BLOCKS = 64
PARTS = 8
#: groups of blocks, and blocks that a task holds at most
GROUPS = 16
GROUP_BLOCKS = 64
ANGLE_BINS = 4_096
#: rounding of a bound and of a product
SLACK = 1e-9
_PAIRS = "a long, part int, place int, b long, bound double"


def stacked(vectors) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def _placer(pivots: np.ndarray | None):
    """Unit vectors with the nearest pivot (-1 for a zero vector) and the angle to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m = stacked(batch["vector"])
            norm = np.linalg.norm(m, axis=1)
            # scaled first: the square of a tiny or huge entry is no number
            norm[(norm == 0) | ~np.isfinite(norm)] = 0
            largest = np.abs(m).max(axis=1)
            odd = (norm == 0) & (largest > 0)
            m[odd] /= largest[odd, None]
            norm[odd] = np.linalg.norm(m[odd], axis=1)
            unit = np.divide(m, norm[:, None], out=np.zeros_like(m), where=norm[:, None] > 0)
            pivot, angle = np.zeros(len(m), np.int64), np.zeros(len(m))
            if pivots is not None:
                near = unit @ pivots.T
                pivot = near.argmax(axis=1)
                angle = np.arccos(np.clip(near.max(axis=1), -1, 1))
            pivot[norm == 0], angle[norm == 0] = -1, 0
            yield pd.DataFrame({"id": batch["id"], "vector": list(unit), "pivot": pivot, "angle": angle})

    return run


def _pivots(rows: DataFrame, count: int) -> np.ndarray:
    """``count`` unit vectors that lie far apart, each next the farthest from those before, out of some drawn by hash."""
    nonzero = rows.filter(F.exists("vector", lambda x: x != 0))
    drawn = nonzero.orderBy(F.xxhash64("id"), "id").limit(DRAWN * count).select("vector").collect()
    m = stacked([r.vector for r in drawn] or [[1.0]])
    m = m / np.abs(m).max(axis=1, keepdims=True)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    chosen, near = [0], m @ m[0]
    while len(chosen) < min(count, len(m)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, m @ m[chosen[-1]])
    return m[chosen]


def _block(pivot, piece, sub):
    return F.shiftleft(pivot, 40).bitwiseOR(F.shiftleft(piece.cast("long"), 16)).bitwiseOR(sub.cast("long"))


def _blocked(placed: DataFrame, size: int) -> DataFrame:
    """``placed`` with ``block``: items of one pivot and a range of angles, ``size`` of them or little more."""
    binned = placed.withColumn("bin", F.floor(F.col("angle") * (ANGLE_BINS / np.pi)).cast("int"))
    counts = binned.groupBy("pivot", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("pivot").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    # a bin that alone is more than a block is dealt by hash
    cuts = counts.select(
        F.col("pivot").alias("_pivot"), F.col("bin").alias("_bin"),
        F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / size).alias("piece"),
        F.least(F.ceil(F.col("n") / size), F.lit(2**15)).alias("subs"),
    )
    sub = F.pmod(F.xxhash64("id"), F.col("subs"))
    return binned.join(cuts, (F.col("pivot") == F.col("_pivot")) & (F.col("bin") == F.col("_bin"))).select(
        "id", "vector", "pivot", "angle", _block(F.col("pivot"), F.col("piece"), sub).alias("block")
    )


@dataclass(frozen=True)
class _Blocks:
    """What is known about each block: bounded in number, so it travels with the tasks."""

    ids: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    between: np.ndarray  # angles of the pivots

    def bounds(self, at: int) -> np.ndarray:
        """Highest similarity that an item of block ``at`` can have with one of each block."""
        apart = self.between[self.pivot[at]][self.pivot]
        least = np.maximum(0, apart - self.high[at] - self.high)
        least = np.maximum(least, self.low - apart - self.high[at])
        least = np.maximum(least, self.low[at] - apart - self.high)
        # nothing is similar to a zero vector
        return np.where(self.pivot < 0, 0.0, np.cos(np.minimum(least, np.pi)))


def _known(rows: DataFrame, pivots: np.ndarray | None) -> _Blocks:
    found = rows.groupBy("block", "pivot").agg(F.min("angle").alias("low"), F.max("angle").alias("high")).collect()
    found = sorted(found, key=lambda r: r.block)
    p = np.ones((1, 1)) if pivots is None else pivots
    between = np.arccos(np.clip(p @ p.T, -1, 1))
    return _Blocks(
        np.array([r.block for r in found], np.int64), np.array([r.pivot for r in found], np.int64),
        np.array([r.low for r in found]), np.array([r.high for r in found]), between,
    )


def _lister(known: _Blocks):
    """The ``FIRST`` blocks to meet, by falling bound, as a group of one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in batch["a"]:
                bound = known.bounds(int(np.searchsorted(known.ids, a)))
                order = np.lexsort((known.ids != a, -bound))[:FIRST]
                yield pd.DataFrame({"a": a, "part": 0, "place": np.arange(len(order)), "b": known.ids[order], "bound": bound[order]})

    return run


def _group_lister(known: _Blocks):
    """Blocks that a group meets: all whose bound reaches the threshold of one of its own, by falling bound."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        long = max(PART_BLOCKS, -(-len(known.ids) // PARTS))
        for batch in batches:
            for a, rows in zip(batch["a"], batch["members"], strict=True):
                bound, other = np.full(len(known.ids), -np.inf), np.ones(len(known.ids), bool)
                for row in rows:
                    at = int(np.searchsorted(known.ids, row["block"]))
                    own = known.bounds(at)
                    bound = np.maximum(bound, np.where(own >= row["threshold"] - SLACK, own, -np.inf))
                    other[at] = False
                order = np.lexsort((other, -bound))
                order = order[np.isfinite(bound[order])]
                place = np.arange(len(order))
                yield pd.DataFrame({"a": a, "part": place // long, "place": place, "b": known.ids[order], "bound": bound[order]})

    return run


class Best:
    """The running k best of the rows of one block: highest score first, smaller id among equals."""

    def __init__(self, ids, vectors, k: int):
        self.ids, self.vectors, self.k = np.asarray(list(ids)), stacked(vectors), k
        self.rows, self.score = np.empty(0, np.int64), np.empty(0)
        self.others: np.ndarray | None = None
        self.kth = np.full(len(self.ids), -np.inf)

    def offer(self, others: np.ndarray, score: np.ndarray) -> None:
        """Scores of all rows with ``others``; -inf for what must not be taken."""
        least = self.kth
        # few reach the running best of a row; else its best of these are found first
        if len(others) > self.k and np.count_nonzero(score >= least[:, None]) > self.k * len(self.ids):
            least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k])
        rows, columns = np.nonzero((score >= least[:, None]) & np.isfinite(score))
        self._take(rows, others[columns], score[rows, columns])

    def _take(self, rows, others, score) -> None:
        if self.others is not None:
            others = np.concatenate([self.others, others])
        rows = np.concatenate([self.rows, rows])
        score = np.concatenate([self.score, score])
        order = np.lexsort((others, -score, rows))
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = order[place < self.k]
        self.rows, self.others, self.score = rows[place < self.k], others[kept], score[kept]
        full = place == self.k - 1
        self.kth[rows[full]] = score[order[full]]

    def nearest(self) -> pd.DataFrame:
        if self.others is None:
            return pd.DataFrame({"item_id": self.ids[:0], "similar_id": self.ids[:0], "similarity": []})
        return pd.DataFrame(
            {"item_id": self.ids[self.rows], "similar_id": self.others, "similarity": self.score}
        )


def _meet(best: Best, others: np.ndarray, vectors: np.ndarray) -> None:
    score = best.vectors @ vectors.T
    # an item is no neighbour of itself
    score[best.ids[:, None] == others[None, :]] = -np.inf
    best.offer(others, score)


def _meetings(k: int, known: _Blocks, thresholds: bool):
    """Stream of a group of blocks followed by those it meets; the k best of its items, or their worst k-th."""

    def result(group: dict[int, Best]) -> Iterator[pd.DataFrame]:
        for block, best in group.items():
            yield pd.DataFrame({"a": [block], "threshold": [best.kth.min()]}) if thresholds else best.nearest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, group, bounds = None, {}, {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if at != (row.a, row.part):
                    yield from result(group)
                    at, group, bounds = (row.a, row.part), {}, {}
                if row.place < 0:
                    best = group[row.block] = Best(row.ids, row.vectors, k)
                    # nothing below the threshold is among the k best of any item of the block
                    best.kth[:] = row.threshold - SLACK
                    bounds[row.block] = known.bounds(int(np.searchsorted(known.ids, row.block)))
                    continue
                b = int(np.searchsorted(known.ids, row.block))
                met = [best for block, best in group.items() if bounds[block][b] >= best.kth.min() - SLACK]
                if met:
                    others, vectors = np.asarray(list(row.ids)), stacked(row.vectors)
                    for best in met:
                        _meet(best, others, vectors)
        yield from result(group)

    return run


def _streams(blocks: DataFrame, candidates: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each group (a) and part of its list: its ``members`` (a, block, threshold), then the candidates of the others in order."""
    heads = pairs.select("a", "part").distinct().join(members, "a").join(blocks, "block").select(
        "a", "part", F.lit(-1).alias("place"), "block", "threshold", "ids", "vectors"
    )
    others = pairs.join(candidates, F.col("b") == F.col("block")).select(
        "a", "part", "place", "block", F.lit(0.0).alias("threshold"), "ids", "vectors"
    )
    return heads.unionByName(others).repartition("a", "part").sortWithinPartitions("a", "part", "place")


def _packed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("block").agg(F.collect_list(F.struct("id", "vector")).alias("rows")).select(
        "block", F.col("rows.id").alias("ids"), F.col("rows.vector").alias("vectors")
    )


@dataclass(frozen=True)
class Meetings:
    """Blocks, the items of each that can be neighbours, groups of blocks, and which blocks they meet (a, part, place, b, bound)."""

    items: DataFrame
    blocks: DataFrame
    candidates: DataFrame
    members: DataFrame
    pairs: DataFrame
    block_count: int
    known: _Blocks


def plan_meetings(rows: DataFrame, k: int, block_items: int = BLOCK_ITEMS) -> Meetings:
    """Which blocks of ``rows`` (id, vector) have to meet for the k nearest of every item."""
    spark = rows.sparkSession
    n = rows.count()
    size = max(block_items, -(-n // MAX_BLOCKS))
    count = -(-n // size)
    pivots = _pivots(rows, min(count, MAX_PIVOTS)) if count > FIRST else None
    kind = f"id {rows.schema['id'].dataType.simpleString()}, vector array<double>, pivot long, angle double"
    placed = rows.mapInPandas(_placer(pivots), kind)
    if count > 1:
        placed = _blocked(materialize(placed, "unit-vectors"), size)
    else:
        placed = placed.withColumn("block", F.when(F.col("pivot") < 0, -1).otherwise(0).cast("long"))
    items = materialize(placed, "similarity-items")
    # smaller ids first: of equal vectors no others can be among anyone's k nearest
    copy = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    candidates = _packed(items.withColumn("copy", copy).filter(F.col("copy") <= k + 1))
    blocks = _packed(items.filter("pivot >= 0"))
    if count > 1:
        blocks, candidates = materialize(blocks, "similarity-blocks"), materialize(candidates, "similarity-candidates")
    known = _known(items, pivots)
    own = [int(b) for b, p in zip(known.ids, known.pivot, strict=True) if p >= 0]
    none = float("-inf")
    if len(own) > FIRST:
        alone = spark.createDataFrame([(b, b, none) for b in own], "a long, block long, threshold double")
        first = alone.select("a").repartition("a").mapInPandas(_lister(known), _PAIRS)
        met = materialize(
            _streams(blocks, candidates, alone, first).mapInPandas(_meetings(k, known, True), "a long, threshold double"),
            "similarity-thresholds",
        )
        # neighbours in id are ranges of angles of the same pivot
        many = min(GROUP_BLOCKS, -(-len(own) // GROUPS))
        groups = spark.createDataFrame([(b, i // many) for i, b in enumerate(own)], "block long, a long")
        members = met.withColumnRenamed("a", "block").join(groups, "block").select("a", "block", "threshold")
    else:
        members = spark.createDataFrame([(b, b, none) for b in own], "a long, block long, threshold double")
    grouped = members.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("block", "threshold"))).alias("members"))
    pairs = grouped.mapInPandas(_group_lister(known), _PAIRS)
    if len(own) > FIRST:
        pairs = materialize(pairs, "similarity-pairs")
    return Meetings(items, blocks, candidates, members, pairs, len(own), known)


def cosine_topk(
    items: DataFrame, k: int, id_col: str = "id", vector_col: str = "features",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item_id, rank, similar_id, similarity``: the k nearest other items of each item."""
    rows = items.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    plan = plan_meetings(rows, k, block_items)
    kind = rows.schema["id"].dataType.simpleString()
    partial = _streams(plan.blocks, plan.candidates, plan.members, plan.pairs).mapInPandas(
        _meetings(k, plan.known, False), f"item_id {kind}, similar_id {kind}, similarity double"
    )
    # zero vectors are equally far from everything: the smallest ids are their neighbours
    smallest = plan.items.select("id").orderBy("id").limit(k + 1).agg(F.collect_list("id").alias("ids"))
    zeros = (
        plan.items.filter("pivot < 0").select(F.col("id").alias("item_id")).join(smallest)
        .select("item_id", F.explode("ids").alias("similar_id")).filter("item_id != similar_id")
        .withColumn("similarity", F.lit(0.0))
    )
    nearest = W.partitionBy("item_id").orderBy(F.desc("similarity"), "similar_id")
    return (
        partial.unionByName(zeros).withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "similar_id", "similarity")
    )
