"""Address to place: a range join made into one equi-join.

Addresses of both families are 32 hexadecimal digits that compare like the number; an
IPv4 address is the IPv6 address that stands for it.  A name is the family and the digits
that count: ``4`` and eight digits, or ``6`` and 32.

The space of names is cut into blocks, the names that share a prefix.  Where many ranges
begin, a block is split into 256 of two more digits, again and again, so blocks are small
where addresses are handed out in small pieces and large elsewhere.  Which blocks are split is the
directory: a few names per length, which go into the plan as sets.  An event walks it with
plain expressions to the one block that its address lies in, so it has one key, one join
and at most one match, in batches and streams alike.

Network ranges are cut into disjoint segments that never leave a block; the narrowest range wins.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart.functions.scalar import IPV4_HEAD, ip_key, ip_number_key
from clickmart.storage import materialize

#: ranges that begin in a block, beyond which it is split
BLOCK_RANGES = 128
#: lengths of names and of the largest blocks, by family
FULL = {"4": 9, "6": 33}
ROOT = {"4": 3, "6": 5}
_SEGMENTS = "block string, lo string, hi string, country string, city string"


@dataclass(frozen=True)
class Places:
    """Disjoint segments (block, lo, hi, country, city), and the blocks that are split, by length of name."""

    segments: DataFrame
    splits: dict[int, list[str]]

    def stored(self, label: str = "places") -> "Places":
        return Places(materialize(self.segments, label), self.splits)


def ranges(table: DataFrame) -> DataFrame:
    """Bounds as keys from ``ip_from, ip_to, country, city`` (text, or IPv4 as numbers)."""
    def key(name):
        if dict(table.dtypes)[name] == "string":
            return ip_key(F.col(name))
        return ip_number_key(F.col(name))

    return table.select(key("ip_from").alias("lo"), key("ip_to").alias("hi"), "country", "city")


def _half(key: str, at: int) -> Column:
    """16 digits as an unsigned number."""
    return F.conv(F.substring(key, at, 16), 16, 10).cast("decimal(20,0)")


def _width() -> Column:
    """hi - lo as a struct that compares like the number."""
    low = _half("hi", 17) - _half("lo", 17)
    borrow = low < 0
    full = F.lit(str(2**64)).cast("decimal(20,0)")
    return F.struct(
        (_half("hi", 1) - _half("lo", 1) - borrow.cast("int")).cast("decimal(21,0)").alias("high"),
        F.when(borrow, low + full).otherwise(low).cast("decimal(21,0)").alias("low"),
    )


def _name(key: Column) -> Column:
    four = F.concat(F.lit("4"), F.substring(key, len(IPV4_HEAD) + 1, 8))
    return F.when(key.startswith(IPV4_HEAD), four).otherwise(F.concat(F.lit("6"), key))


def _by_family(name: str, values: dict[str, int]) -> Column:
    return F.when(F.col(name).startswith("4"), values["4"]).otherwise(values["6"])


def _named(network_ranges: DataFrame) -> DataFrame:
    """Ranges with the names of their bounds; one that reaches beyond the IPv4 addresses is an IPv6 range."""
    both = F.col("lo").startswith(IPV4_HEAD) & F.col("hi").startswith(IPV4_HEAD)

    def bound(key):
        return F.when(both, _name(F.col(key))).otherwise(F.concat(F.lit("6"), F.col(key)))

    return network_ranges.filter("lo <= hi").select(
        bound("lo").alias("lo"), bound("hi").alias("hi"), _width().alias("width"), "country", "city"
    )


def _directory(named: DataFrame) -> dict[int, list[str]]:
    """Blocks in which more than ``BLOCK_RANGES`` ranges begin, by length; at most a few per 128 ranges."""
    lengths = F.sequence(_by_family("lo", ROOT), _by_family("lo", FULL) - 2, F.lit(2))
    nodes = named.select(F.explode(F.transform(lengths, lambda n: F.substring(F.col("lo"), F.lit(1), n))).alias("node"))
    found = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK_RANGES).collect()
    splits: dict[int, list[str]] = {}
    for row in sorted(found):
        splits.setdefault(len(row.node), []).append(row.node)
    return splits


def _cut(pieces: DataFrame, first: Column, digits: Column) -> DataFrame:
    """One row per block of ``digits`` more digits that a piece touches; null ``digits``: the piece as it is.

    Of pieces cut to the same bounds only the narrowest range can win.
    """
    def number(bound):
        return F.conv(F.substring(F.col(bound), first, digits), 16, 10).cast("int")

    found = F.when(digits.isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(number("lo"), number("hi")))
    block = F.concat(F.substring("lo", F.lit(1), first - 1), F.lpad(F.lower(F.hex("number")), digits, "0"))
    length = _by_family("lo", FULL)
    rows = pieces.withColumn("number", F.explode(found)).withColumn(
        "block", F.when(F.col("number").isNull(), F.col("block")).otherwise(block)
    )
    return (
        rows.withColumn("lo", F.greatest("lo", F.rpad("block", length, F.lit("0"))))
        .withColumn("hi", F.least("hi", F.rpad("block", length, F.lit("f"))))
        .groupBy("block", "lo", "hi")
        .agg(F.min(F.struct("width", "country", "city")).alias("best"))
        .select("block", "lo", "hi", "best.*")
    )


def segments(network_ranges: DataFrame) -> Places:
    """Disjoint segments per block; where ranges overlap the narrowest one wins."""
    named = _named(network_ranges)
    splits = _directory(named)
    pieces = _cut(named.withColumn("block", F.lit("")), F.lit(2), _by_family("lo", ROOT) - 1)
    for length in sorted(splits):
        deeper = F.when(F.col("block").isin(splits[length]), 2)
        pieces = _cut(pieces, F.lit(length + 1), deeper)
    in_block = W.partitionBy("block")
    earlier = in_block.orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    overlaps = F.coalesce(F.max("hi").over(earlier) >= F.col("lo"), F.lit(False))
    judged = pieces.withColumn("_o", overlaps).withColumn("_any", F.max("_o").over(in_block))
    # address lists are mostly disjoint already; only overlapping blocks are swept
    columns = ["block", "lo", "hi", "country", "city"]
    disjoint = judged.filter(~F.col("_any")).select(*columns)
    swept = (
        judged.filter("_any")
        .select(
            *columns, F.col("width.high").cast("string").alias("w_high"),
            F.col("width.low").cast("string").alias("w_low"),
        )
        .groupBy("block")
        .applyInPandas(_narrowest, _SEGMENTS)
    )
    return Places(disjoint.unionByName(swept), splits)


def _narrowest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sweep one block from low to high, keeping the narrowest open range on top."""
    family, digits = pdf["lo"].iloc[0][0], len(pdf["lo"].iloc[0]) - 1
    pdf = pdf.assign(
        lo=[int(x[1:], 16) for x in pdf["lo"]], hi=[int(x[1:], 16) for x in pdf["hi"]],
        width=[(int(a) << 64) + int(b) for a, b in zip(pdf["w_high"], pdf["w_low"])],
    )
    rows = list(pdf.sort_values(["lo", "hi"]).itertuples(index=False))
    out = [
        (r.block, f"{family}{lo:0{digits}x}", f"{family}{hi:0{digits}x}", r.country, r.city)
        for r, lo, hi in _sweep(rows)
    ]
    return pd.DataFrame(out, columns=["block", "lo", "hi", "country", "city"])


def _sweep(rows: list) -> Iterator[tuple]:
    edges = sorted({r.lo for r in rows} | {r.hi + 1 for r in rows})
    open_rows: list[tuple] = []
    i = 0
    for lo, following in zip(edges, edges[1:]):
        while i < len(rows) and rows[i].lo == lo:
            heapq.heappush(open_rows, (rows[i].width, i))
            i += 1
        while open_rows and rows[open_rows[0][1]].hi < lo:
            heapq.heappop(open_rows)
        if open_rows:
            yield rows[open_rows[0][1]], lo, following - 1


def _block_of(name: str, splits: dict[int, list[str]]) -> Column:
    """The block that a name lies in: as many digits as the directory has splits on its way."""
    def walk(length: int, last: int) -> Column:
        prefix = F.substring(name, 1, length)
        if length >= last or length not in splits:
            return prefix
        return F.when(prefix.isin(splits[length]), walk(length + 2, last)).otherwise(prefix)

    four = F.col(name).startswith("4")
    return F.when(four, walk(ROOT["4"], FULL["4"])).otherwise(walk(ROOT["6"], FULL["6"]))


def locate(events: DataFrame, places: Places) -> DataFrame:
    """Add ``country`` and ``city``; both ``Unknown`` where no range matches.

    A place with a known country and no city keeps the null city.  There is no hint:
    Spark broadcasts segments below its size limit; beyond it both sides shuffle on the
    block, and the partitions of a block that holds many events are split.
    """
    unknown = F.lit(C.UNKNOWN_PLACE)
    # rows without a usable address must not meet in one partition
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(*events.columns), F.lit(4096)).cast("string"))
    side = places.segments.select(
        F.col("block").alias("_block"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
        F.struct("country", "city").alias("_at"),
    )
    keyed = events.withColumn("_ip", _name(ip_key(F.col("ip_address")))).withColumn(
        "_key", F.coalesce(_block_of("_ip", places.splits), spread)
    )
    inside = F.col("_ip").between(F.col("_lo"), F.col("_hi"))
    found = F.col("_at")
    return (
        keyed.join(side, (F.col("_key") == F.col("_block")) & inside, "left")
        .withColumns({
            c: F.when(found.isNotNull(), found.getField(c)).otherwise(unknown) for c in ("country", "city")
        })
        .drop("_ip", "_key", "_block", "_lo", "_hi", "_at")
    )
