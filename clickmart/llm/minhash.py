"""Near-duplicate groups by MinHash.

Words are lower-cased (A-Z) runs of non-blank characters; a document's set is its
distinct five-word shingles, or the whole sequence if it is shorter.  Two documents
are linked when 100 * intersection >= 75 * union.

1. One pass over the texts gives a digest of the word sequence, the set size and
   128 universal hash minima.  Documents with the same words form a class; only
   classes go on, so exact copies cost nothing further.
2. 32 bands of 4 minima are hashed to buckets.  A pair at similarity 0.75 meets in
   some bucket with probability 1 - 5e-6, at 0.8 with 1 - 5e-8.
3. Candidates come in rounds, always between classes of different components, so
   copies of one text are never expanded into pairs: first each class with the
   bucket representative it shares most buckets with, then each bucket's
   representatives with the members of other components, at last all pairs across
   components that are left in a bucket, in square blocks of bounded size.
4. A candidate must agree in at least 0.56 of the minima (five standard errors below
   0.75) and is confirmed on the full sets.  In the last round pairs are many, so there
   the classes in buckets that are still open get 2,048 further minima, two bits of each (512 bytes);
   a pair must agree in as many of them as a similarity of 0.695 does (4.8 standard errors
   below), and is taken in the first band that it shares only.
5. Confirmed links are joined to components by alternating large-star and small-star.

Nulls and edges: a text that is null or has no word has set size 0 and is linked
with nothing, not even with other empty texts; a null id is carried, the component
takes the smallest id that is not null, or null if there is none; repeated rows are
one class, and all rows with the component's id count as kept; an empty table gives
an empty result; further columns are ignored by ``group`` and carried by ``dedup``.
"""

import hashlib
from collections.abc import Iterator

import clickmart.llm
import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialize, settled, words
from clickmart.llm.graph import components

# workers need not have the package on their path
cloudpickle.register_pickle_by_value(clickmart.llm)

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
MIN_AGREE = 0.56
BLOCK = 1_024
#: further minima of candidates of the last round, of which two bits are kept: minima that differ agree in
#: these by chance one time in four, so similarity s shows as s + (1 - s) / 4
FINE, MIN_FINE = 2_048, 0.695 + 0.305 / 4
_DIGEST = "doc_id long, text_hash long, digest string, n_shingles long, signature binary"
_SETS = "node long, shingles binary"
_CHUNK = 1 << 19


def _mix() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(902_117))
    return rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def _hashes(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of n universal hash functions."""
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.integers(1, 2**32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)


def text_words(text) -> list[bytes]:
    # bytes.lower touches A-Z only, bytes.split breaks at the six ASCII blanks
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def words_digest(tokens: list[bytes]) -> str:
    return hashlib.md5(b" ".join(tokens)).hexdigest()


def shingle_set(tokens: list[bytes], mix: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, n)
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += h[k : n - width + 1 + k] * mix[k]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0x9E3779B97F4A7C15)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each universal hash over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 2**32 - 1, np.uint32)
    chunk = max(1, _CHUNK // len(a))
    for at in range(0, len(x), chunk):
        part = a[:, None] * x[None, at : at + chunk] + b[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    mix, (a, b) = _mix(), _hashes(HASHES, 1)
    for batch in batches:
        digests, sizes, signatures = [], [], []
        for text in batch["text"]:
            tokens = text_words(text)
            shingles = shingle_set(tokens, mix)
            digests.append(words_digest(tokens))
            sizes.append(len(shingles))
            signatures.append(minima(shingles, a, b).tobytes() if len(shingles) else None)
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"], "digest": digests,
             "n_shingles": sizes, "signature": signatures}
        )


def _full_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shingles of the class a row stands for."""
    mix = _mix()
    for batch in batches:
        nodes, sets = [], []
        for node, digest, text in zip(batch["node"], batch["digest"], batch["text"], strict=True):
            tokens = text_words(text)
            if words_digest(tokens) == digest:
                nodes.append(node)
                sets.append(shingle_set(tokens, mix).tobytes())
        yield pd.DataFrame({"node": nodes, "shingles": sets})


def _packed(values: np.ndarray) -> bytes:
    """Two bits of each of the minima, four to a byte."""
    # low bits of a linear hash are weak, its high bits are small at a minimum
    bits = (values * np.uint32(0x9E3779B1) >> np.uint32(30)).astype(np.uint8).reshape(-1, 4)
    return (bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6).tobytes()


def _fine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a, b = _hashes(FINE, 2)
    for batch in batches:
        found = [_packed(minima(np.frombuffer(s, np.uint64), a, b)) for s in batch["shingles"]]
        yield pd.DataFrame({"node": batch["node"], "fine": found})


def _agreement(fine: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Share of the two-bit values of each row of ``fine`` that equal those of ``one``."""
    differ = fine ^ one
    differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
    return 1 - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) / FINE


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, HASHES)


def _agreeing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            same = (_matrix(batch["sig_u"]) == _matrix(batch["sig_v"])).mean(axis=1)
            batch = batch[same >= MIN_AGREE]
        yield batch[["u", "v"]]


def _confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        linked = []
        for left, right in zip(batch["set_u"], batch["set_v"], strict=True):
            a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        yield batch.loc[np.array(linked, bool), ["u", "v"]]


def _block_pairs(block: pd.DataFrame) -> pd.DataFrame:
    """Pairs across components in one block of a bucket that agree enough.

    A pair that meets in several bands is taken in the first of them.
    """
    i, j, band = int(block["i"].iloc[0]), int(block["j"].iloc[0]), int(block["band"].iloc[0])
    keys = np.frombuffer(b"".join(block["keys"]), np.int64).reshape(-1, BANDS)
    fine = np.frombuffer(b"".join(block["fine"]), np.uint64).reshape(-1, FINE // 32)
    node, comp = block["node"].to_numpy(), block["component"].to_numpy()
    size, part = block["n_shingles"].to_numpy(), block["part"].to_numpy()
    found = []
    for at in np.flatnonzero(part == i):
        other = part == j
        if i == j:
            other &= node > node[at]
        other &= comp != comp[at]
        other &= 100 * np.minimum(size, size[at]) >= PERCENT * np.maximum(size, size[at])
        others = np.flatnonzero(other)
        if len(others):
            others = others[_agreement(fine[others], fine[at]) >= MIN_FINE]
        if len(others):
            others = others[(keys[others] == keys[at]).argmax(axis=1) == band]
        found += [(min(node[at], node[o]), max(node[at], node[o])) for o in others]
    return pd.DataFrame(found, columns=["u", "v"], dtype="int64")


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, digest, n_shingles, signature of every row, written."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return materialize(rows.mapInPandas(_sketches, _DIGEST), "minhash-sketches")


def _classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct word sequence, with a node number fixed by the write."""
    # null ids last
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    grouped = (
        sketches.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min(row).alias("row"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
    )
    return materialize(
        grouped.select(
            "digest", F.col("row.doc_id").alias("first_id"), F.col("row.text_hash").alias("first_hash"),
            "n_shingles", "signature", F.monotonically_increasing_id().alias("node"),
        ),
        "minhash-classes",
    )


def _band_keys() -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("signature"), b * 4 * ROWS + 1, F.lit(4 * ROWS))),
    )


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, band, node, low) of the buckets with two classes or more, written."""
    placed = classes.select("node", F.posexplode(_band_keys()).alias("band", "key"))
    shared = (
        placed.groupBy("key")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low < high")
        .select("key", "low")
    )
    return materialize(placed.join(shared, "key"), "minhash-buckets")


class _Confirmer:
    """Signature check and exact check of candidate pairs (u, v)."""

    def __init__(self, docs: DataFrame, classes: DataFrame, buckets: DataFrame):
        self.known = classes.join(buckets.select("node").distinct(), "node", "left_semi")
        self.known = materialize(
            self.known.select("node", "digest", "first_id", "first_hash", "n_shingles", "signature"), "minhash-known"
        )
        wanted = self.known.select("node", "digest", "first_id", "first_hash")
        # the hash keeps ids that repeat, or are null, from meeting all their texts
        same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.xxhash64("text") == F.col("first_hash"))
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, same)
        sets = texts.select("node", "digest", "text").mapInPandas(_full_sets, _SETS)
        # a repeated row gives its class twice
        self.sets = materialize(
            sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "minhash-sets"
        )

    def fine(self, placed: DataFrame) -> DataFrame:
        """node, n_shingles, band keys and fine sketch of the members of ``placed``, written."""
        members = placed.select("node").distinct()
        sketched = self.sets.join(members, "node", "left_semi").mapInPandas(_fine, "node long, fine binary")
        # big-endian per key; only equality counts
        keys = F.unhex(F.array_join(F.transform(_band_keys(), lambda k: F.lpad(F.hex(k), 16, "0")), ""))
        own = self.known.select("node", "n_shingles", keys.alias("keys"))
        return materialize(own.join(sketched, "node"), "minhash-fine")

    def _with(self, pairs: DataFrame, side: DataFrame, name: str, columns: dict[str, str]) -> DataFrame:
        return pairs.join(side.select(F.col("node").alias(name), *[
            F.col(c).alias(f"{alias}_{name}") for c, alias in columns.items()
        ]), name)

    def links(self, pairs: DataFrame, agreeing: bool = False) -> DataFrame:
        if not agreeing:
            what = {"signature": "sig", "n_shingles": "size"}
            for name in ("u", "v"):
                pairs = self._with(pairs, self.known, name, what)
            # sets whose sizes differ more can't be similar enough
            near = 100 * F.least("size_u", "size_v") >= PERCENT * F.greatest("size_u", "size_v")
            pairs = pairs.filter(near).mapInPandas(_agreeing, "u long, v long")
        for name in ("u", "v"):
            pairs = self._with(pairs, self.sets, name, {"shingles": "set"})
        return pairs.mapInPandas(_confirmed, "u long, v long")


def _with_component(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """Buckets that still hold two components or more, with the component of each node."""
    placed = buckets.join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    open_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"))
        .filter("first < last")
        .select("key")
    )
    return placed.join(open_keys, "key", "left_semi")


def _representative_pairs(buckets: DataFrame) -> DataFrame:
    """Each class with the bucket minimum it shares most buckets with."""
    shared = (
        buckets.filter("node != low")
        .groupBy("node", "low")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = shared.groupBy("node").agg(F.max(F.struct("n", "low")).alias("best"))
    return best.select(F.col("best.low").alias("u"), F.col("node").alias("v"))


def _hub_pairs(placed: DataFrame) -> DataFrame:
    """Two hubs per open bucket, of different components, with the members of other components."""
    member = F.struct("component", "node")
    hubs = placed.groupBy("key").agg(F.min(member).alias("a"), F.max(member).alias("b"))
    hub = F.explode(F.array("a", "b"))
    return (
        placed.join(hubs.select("key", hub.alias("hub")), "key")
        .filter(F.col("component") != F.col("hub.component"))
        .select(
            F.least("node", F.col("hub.node")).alias("u"),
            F.greatest("node", F.col("hub.node")).alias("v"),
        )
        .distinct()
    )


def _remaining_pairs(placed: DataFrame, about: DataFrame) -> DataFrame:
    """All pairs across components in the open buckets, block by block."""
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = placed.join(sizes, "key").withColumn("blocks", blocks)
    own = own.withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "band", "node", "component", "part",
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
    )
    full = met.join(about, "node")
    return full.groupBy("key", "i", "j").applyInPandas(_block_pairs, "u long, v long").distinct()


def _component_links(links: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between components as edges between their smallest nodes."""
    for name in ("u", "v"):
        side = comps.select(F.col("node").alias(name), F.col("component").alias(f"{name}_c"))
        links = links.join(side, name, "left").withColumn(name, F.coalesce(f"{name}_c", name)).drop(
            f"{name}_c"
        )
    return links.select("u", "v")


def _class_components(docs: DataFrame, classes: DataFrame) -> DataFrame:
    buckets = _buckets(classes)
    check = _Confirmer(docs, classes, buckets)
    links = check.links(_representative_pairs(buckets))
    comps = materialize(components(links, "minhash-0"), "minhash-comps-0")
    for turn in (1, 2):
        placed = materialize(_with_component(buckets, comps), f"minhash-open-{turn}")
        if placed.isEmpty():
            break
        if turn == 1:
            links = check.links(_hub_pairs(placed))
        else:
            links = check.links(_remaining_pairs(placed, check.fine(placed)), agreeing=True)
        edges = comps.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(
            _component_links(links, comps)
        )
        comps = materialize(components(edges, f"minhash-{turn}"), f"minhash-comps-{turn}")
    return comps


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component, component_id, kept of every row."""
    sketches = _sketched(docs)
    classes = _classes(sketches)
    comps = settled(docs.sparkSession, "minhash-components", lambda: _class_components(docs, classes))
    thin = classes.select("digest", "first_id", "node").join(comps, "node", "left")
    thin = thin.withColumn("component", F.coalesce("component", "node"))
    lowest = thin.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_digest = materialize(
        thin.join(lowest, "component").select("digest", "component", "component_id"), "minhash-groups"
    )
    worded = (
        sketches.filter("n_shingles > 0")
        .join(by_digest, "digest")
        .select("doc_id", "text_hash", "n_shingles", "component", "component_id")
    )
    empty = sketches.filter("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("component"),
        F.col("doc_id").alias("component_id"),
    )
    return worded.unionByName(empty).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def group(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    return _grouped(docs).select("doc_id", "n_shingles", "component_id", "kept")


def dedup(docs: DataFrame) -> DataFrame:
    """One document of each group, and every document without a word, as they were."""

    def stays() -> DataFrame:
        row = F.min(F.struct("doc_id", "text_hash")).alias("stay")
        grouped = _grouped(docs).filter("kept and n_shingles > 0").groupBy("component").agg(row)
        return grouped.select(F.col("stay.doc_id").alias("stay_id"), F.col("stay.text_hash").alias("stay_hash"))

    kept = settled(docs.sparkSession, "minhash-stays", stays)
    rows = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash")
    )
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("hash") == F.col("stay_hash"))
    once = rows.join(kept, same, "left_semi").dropDuplicates(["id", "hash"]).select("doc.*")
    blank = F.size(words(F.col("text"))) == 0
    return once.unionByName(docs.filter(blank))
