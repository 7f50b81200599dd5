"""Removal of repeated passages with sharded phrase automata.

A window is 35 consecutive words of one document; the words of every window whose
sequence starts anywhere else too are removed.

1. Scan: one pass over all texts hashes 10-word grams and keeps those that are the
   smallest of 26 neighbours.  Every 35-word window holds 26 grams, so equal windows
   share a kept gram (an anchor), and about one gram in thirteen is kept.  Documents
   with the same words form a class that counts as often as it has members; only its
   first row goes on.
2. Confirm: windows around anchors that occur twice or more are hashed to 128 bits and
   counted.  Windows that always occur one after the other are joined to phrases: two
   neighbours belong together when the occurrences of the one, moved by a word, are
   the occurrences of the other.  Each place has a mark, and the mark of the next place
   is a linear step of it; so the xor of a window's marks, moved one step, must be the
   xor of the other's, and their counts must be equal.  So
   each recurring window is in exactly one phrase, and wherever it occurs, its whole
   phrase does.
3. Compile and stream: phrases are dealt to shards by the smallest gram of their first
   window; pyahocorasick compiles each shard, over words numbered in the shard.  All
   stretches of all classes that hold such a gram are streamed through the automata of
   its shard, which locates every occurrence word for word.  A shard with many
   stretches is repeated, so that no task gets more than a bounded part.
4. Covered words are dropped, and every member of a class takes its result.

Nulls and edges: a null or empty text has no words and the checksum of the empty
string; texts under 35 words lose nothing; repeated rows repeat each
other, so they lose all their words from 35 on; occurrences may overlap; an empty
table gives an empty result; further columns are ignored.
"""

import hashlib
import math
from collections.abc import Iterator

import clickmart.llm
import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.llm.common import materialize, numbered


# workers need not have the package on their path
cloudpickle.register_pickle_by_value(clickmart.llm)

WINDOW = 35
GRAM = 10
SPAN = WINDOW - GRAM + 1  # grams in a window: 26
#: windows of one phrase at most; longer runs are cut, neighbours overlap by a window's words
PHRASE_WINDOWS = 2_000
SHARD_WORDS = 100_000
STRETCH_WORDS = 400_000
_ROWS_OUT = 100_000
#: a place is a candidate's number and a word in it; a text may have 2**27 words
START_BITS = 27
#: fixed value: feedback of a primitive polynomial of degree 64
FEEDBACK = 0x1B

_SCAN = (
    "rid long, doc_id long, digest string, n_words long, plain_sha string, "
    "anchors array<long>, places array<int>"
)
_WINDOWS = "h1 long, h2 long, place long, mark long, copies long"
_PIECES = "kind int, shard int, number long, start int, n_words int, body string"


def text_words(text) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def _multipliers(n: int, seed: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)


def _rolling(h: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Mixed hash of every run of ``len(factors)`` words."""
    width = len(factors)
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total += h[k : len(h) - width + 1 + k] * factors[k]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0x9E3779B97F4A7C15)
    total ^= total >> np.uint64(29)
    return total


def _sliding(x: np.ndarray, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of SPAN values, by doubling."""
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        x = pick(x[:-step], x[step:])
        width += step
    return x


def _word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def anchors(grams: np.ndarray) -> np.ndarray:
    """Places of grams that are smallest among some SPAN neighbours."""
    low = _sliding(grams, np.minimum)
    edge = np.full(SPAN - 1, -1, np.int64)
    best = _sliding(np.concatenate([edge, low, edge]), np.maximum)
    return np.flatnonzero(best == grams)


def _grams(tokens: list[bytes], factors: np.ndarray) -> np.ndarray:
    """Gram hashes as longs that are not negative."""
    return (_rolling(_word_hashes(tokens), factors) >> np.uint64(1)).view(np.int64)


def marks(number: int, n: int) -> np.ndarray:
    """Marks of the places 0 to n - 1 of a candidate: steps of a shift register."""
    state = (xxhash.xxh3_64_intdigest(number.to_bytes(8, "little")) | 1) & (2**64 - 1)
    out = np.empty(n, np.uint64)
    for i in range(n):
        out[i] = state
        state = ((state << 1) & (2**64 - 1)) ^ (FEEDBACK if state >> 63 else 0)
    return out


def _next_mark(mark):
    return F.shiftleft(mark, 1).bitwiseXOR(F.when(mark < 0, F.lit(FEEDBACK)).otherwise(F.lit(0)).cast("long"))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    factors = _multipliers(GRAM, 31)
    for batch in batches:
        rows = []
        for rid, doc_id, text in zip(batch["rid"], batch["doc_id"], batch["text"], strict=True):
            tokens = text_words(text)
            body = b" ".join(tokens)
            hashes, places = [], []
            if len(tokens) >= WINDOW:
                grams = _grams(tokens, factors)
                at = anchors(grams)
                hashes, places = grams[at], at.astype(np.int32)
            rows.append((rid, doc_id, hashlib.md5(body).hexdigest(), len(tokens),
                         hashlib.sha256(body).hexdigest(), hashes, places))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in _SCAN.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes, places and marks of the windows that hold a repeated anchor."""
    one, two = _multipliers(WINDOW, 32), _multipliers(WINDOW, 33)
    names = [c.split()[0] for c in _WINDOWS.split(", ")]
    for batch in batches:
        held, size = [], 0
        for number, copies, text, places in zip(
            batch["number"], batch["copies"], batch["text"], batch["places"], strict=True
        ):
            h = _word_hashes(text_words(text))
            n = len(h) - WINDOW + 1
            if n >> START_BITS or number >> (63 - START_BITS):
                raise ValueError(f"candidate {number} with {len(h)} words exceeds the place numbers")
            mark = np.zeros(n + 1, np.int32)
            at = np.asarray(places)
            np.add.at(mark, np.maximum(at - SPAN + 1, 0), 1)
            np.add.at(mark, np.minimum(at + 1, n), -1)
            start = np.flatnonzero(np.cumsum(mark[:n]) > 0)
            held.append((
                _rolling(h, one)[start].view(np.int64), _rolling(h, two)[start].view(np.int64),
                (number << START_BITS) + start, marks(number, n)[start].view(np.int64),
                np.full(len(start), copies),
            ))
            size += len(start)
            if size >= _ROWS_OUT:
                yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*held)), strict=True)))
                held, size = [], 0
        if held:
            yield pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*held)), strict=True)))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Phrases (kind 0) and the stretches to stream (kind 1) as text, by shard."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    for batch in batches:
        rows = []
        for number, text, phrases, stretches in zip(
            batch["number"], batch["text"], batch["phrases"], batch["stretches"], strict=True
        ):
            tokens = text_words(text)
            for p in [] if phrases is None else phrases:
                part = tokens[p["start"] : p["start"] + p["n_words"]]
                rows.append((0, p["shard"], number, p["start"], len(part), b" ".join(part)))
            ranges: dict[int, list] = {}
            for s in [] if stretches is None else stretches:
                reach = (max(0, s["at"] - SPAN + 1), min(len(tokens), s["at"] + s["reach"]))
                ranges.setdefault(s["shard"], []).append(reach)
            for shard, wanted in ranges.items():
                for low, high in _merged(wanted):
                    rows.append((1, shard, number, low, high - low, b" ".join(tokens[low:high])))
            if len(rows) >= 2_000:
                yield _decoded(rows, names)
                rows = []
        if rows:
            yield _decoded(rows, names)


def _decoded(rows: list, names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    out["body"] = [b.decode("utf-8", "surrogatepass") for b in out["body"]]
    return out


def _locate(group: pd.DataFrame) -> pd.DataFrame:
    """Word ranges of the stretches of a shard that its phrases cover."""
    import ahocorasick

    numbers: dict[str, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    kinds = group["kind"].to_numpy()
    for body in group["body"][kinds == 0]:
        phrase = tuple(numbers.setdefault(w, len(numbers) + 1) for w in body.split(" "))
        automaton.add_word(phrase, len(phrase))
    found = []
    if len(automaton):
        automaton.make_automaton()
        stretches = group[kinds == 1]
        for number, start, body in zip(stretches["number"], stretches["start"], stretches["body"], strict=True):
            # 0: a word that no phrase of the shard has
            stream = tuple(numbers.get(w, 0) for w in body.split(" "))
            hits = [(start + end + 1 - n, start + end + 1) for end, n in automaton.iter(stream)]
            found += [(number, low, high) for low, high in _merged(hits)]
    return pd.DataFrame(found, columns=["number", "low", "high"])


def _without(with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rid, text, covered in zip(batch["rid"], batch["text"], batch["covered"], strict=True):
                tokens = text_words(text)
                keep = np.ones(len(tokens), bool)
                for c in covered:
                    keep[c["low"] : c["high"]] = False
                kept = [w for w, k in zip(tokens, keep, strict=True) if k]
                body = b" ".join(kept)
                rows.append((rid, len(tokens) - len(kept), hashlib.sha256(body).hexdigest(),
                             body.decode("utf-8", "surrogatepass")))
            out = pd.DataFrame(rows, columns=["rid", "n_removed", "kept_sha256", "kept_text"])
            yield out if with_text else out.drop(columns="kept_text")

    return run


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: number, word count, checksums, anchors; written."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return materialize(rows.mapInPandas(_scan, _SCAN), "phrase-scan")


def _candidates(docs: DataFrame, scanned: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes that hold an anchor which occurs twice or more, numbered, with text and anchors."""
    firsts = scanned.join(classes.select("rid", "copies"), "rid")
    held = F.inline(F.arrays_zip(F.col("anchors").alias("anchor"), F.col("places").alias("place")))
    repeated = (
        firsts.select("copies", F.explode("anchors").alias("anchor"))
        .groupBy("anchor").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor")
    )
    places = (
        firsts.select("rid", held)
        .join(repeated, "anchor", "left_semi")
        .groupBy("rid")
        .agg(F.collect_list("place").alias("places"), F.collect_list("anchor").alias("anchors"))
    )
    wanted = materialize(
        firsts.select("rid", "doc_id", "digest", "copies").join(places, "rid"), "phrase-wanted"
    )
    # one key for the join and for dropping equal rows, so the texts are moved once
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    own = F.md5(F.array_join(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""), " "))
    texts = docs.select(key.alias("key"), "text").filter(F.col("text").isNotNull())
    joined = (
        texts.join(wanted.withColumn("key", key).drop("doc_id"), "key")
        # other texts of the same id go; equal ones are equal, so any of them will do
        .filter(own == F.col("digest"))
        .dropDuplicates(["key", "rid"])
    )
    return numbered(joined.select("rid", "copies", "text", "places", "anchors"), "number", "phrase-candidates")


def _phrases(candidates: DataFrame) -> DataFrame:
    """(number, start, n_words, route): each recurring window in exactly one phrase; written."""
    windows = candidates.select("number", "copies", "text", "places").mapInPandas(_windows, _WINDOWS)
    recurring = (
        windows.groupBy("h1", "h2")
        .agg(F.sum("copies").alias("n"), F.min("place").alias("place"), F.bit_xor("mark").alias("mark"))
        .filter("n > 1")
        .select(
            F.shiftright("place", START_BITS).alias("number"),
            F.col("place").bitwiseAND(F.lit(2**START_BITS - 1)).cast("int").alias("start"),
            "n", "mark",
        )
    )
    by_row = W.partitionBy("number").orderBy("start")
    follows = (
        (F.col("start") == F.lag("start").over(by_row) + 1)
        & (F.col("n") == F.lag("n").over(by_row))
        & (F.col("mark") == _next_mark(F.lag("mark").over(by_row)))
    )
    begin = F.when(~F.coalesce(follows, F.lit(False)), F.col("start"))
    upto = by_row.rowsBetween(W.unboundedPreceding, 0)
    runs = recurring.withColumn("begin", begin).withColumn(
        "begin", F.last("begin", ignorenulls=True).over(upto)
    )
    cut = F.floor((F.col("start") - F.col("begin")) / PHRASE_WINDOWS)
    cuts = materialize(
        runs.groupBy("number", "begin", cut.alias("cut"))
        .agg(
            F.min("start").alias("start"),
            (F.count(F.lit(1)) + WINDOW - 1).cast("int").alias("n_words"),
        )
        .select("number", "start", "n_words"),
        "phrase-cuts",
    )
    # smallest gram of the first window: one of its anchors, the same wherever it occurs
    first = F.filter(
        F.arrays_zip(F.col("anchors").alias("anchor"), F.col("places").alias("place")),
        lambda x: x["place"].between(F.col("start"), F.col("start") + (SPAN - 1)),
    )
    route = F.array_min(F.transform(first, lambda x: x["anchor"]))
    return materialize(
        cuts.join(candidates.select("number", "anchors", "places"), "number").select(
            "number", "start", "n_words", route.alias("route")
        ),
        "phrase-phrases",
    )


def _streamed(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases and stretches as text, dealt to shards; written."""
    total = phrases.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_WORDS))
    shard = F.pmod("route", F.lit(shards)).cast("int")
    dealt = phrases.withColumn("shard", shard)
    own = dealt.groupBy("number").agg(
        F.collect_list(F.struct("shard", "start", "n_words")).alias("phrases")
    )
    routes = dealt.groupBy("route", "shard").agg(F.max("n_words").alias("reach"))
    held = candidates.select(
        "number", F.inline(F.arrays_zip(F.col("anchors").alias("route"), F.col("places").alias("at")))
    )
    stretches = (
        held.join(routes, "route")
        .groupBy("number")
        .agg(F.collect_list(F.struct("shard", "at", "reach")).alias("stretches"))
    )
    work = candidates.select("number", "text").join(
        stretches.join(own, "number", "full"), "number"
    )
    return materialize(
        work.select("number", "text", "phrases", "stretches").mapInPandas(_pieces, _PIECES), "phrase-pieces"
    )


def _covered(pieces: DataFrame) -> DataFrame:
    """(number, low, high): word ranges covered by located phrases; written."""
    sizes = pieces.groupBy("shard").agg(
        F.sum(F.when(F.col("kind") == 1, F.col("n_words")).otherwise(0)).alias("streamed")
    )
    repeats = sizes.select(
        "shard", F.greatest(F.lit(1), F.ceil(F.col("streamed") / STRETCH_WORDS)).cast("int").alias("repeats")
    )
    part = F.pmod(F.xxhash64("number", "start"), F.col("repeats")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("repeats") - 1)
    dealt = pieces.join(repeats, "shard").withColumn(
        "part", F.explode(F.when(F.col("kind") == 0, everywhere).otherwise(F.array(part)))
    )
    found = dealt.groupBy("shard", "part").applyInPandas(_locate, "number long, low int, high int")
    return materialize(found, "phrase-covered")


def removal(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document.

    ``with_text`` adds kept_text, null where nothing went.
    """
    scanned = scan(docs)
    classes = materialize(
        scanned.groupBy("digest").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies")),
        "phrase-classes",
    )
    candidates = _candidates(docs, scanned, classes)
    covered = _covered(_streamed(candidates, _phrases(candidates)))
    ranges = covered.groupBy("number").agg(F.collect_list(F.struct("low", "high")).alias("covered"))
    kept = "rid long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    changed = materialize(
        candidates.select("rid", "number", "text").join(ranges, "number").drop("number").mapInPandas(
            _without(with_text), kept
        ),
        "phrase-changed",
    )
    results = classes.select("digest", "rid").join(changed, "rid")
    return (
        scanned.select("doc_id", "digest", "n_words", "plain_sha")
        .join(results.drop("rid"), "digest", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("kept_sha256", "plain_sha").alias("kept_sha256"), *["kept_text"] * with_text,
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    return removal(docs, with_text=False)
