"""URL filter: a sort-merge range join of urls with prefix rules.

Canonical key: the labels of the host in reverse order, the byte 0xFE, the path.
Neither 0xFE nor 0xFF occurs in UTF-8, so a rule is exactly the interval from its
key to its key plus 0xFF, and any two intervals are nested or disjoint.  A rule also
fits subdomains, whose own keys lie elsewhere; a url is therefore looked up under
each suffix of its host that has as many labels as some rule.

The rules alone are swept first: starts and ends in key order, the depth is a
running sum, and the top of the stack of active nested rules after an event is the
latest start at its depth.  That yields disjoint segments, each with its innermost
rule.  Urls and segment starts are then sorted together by key; the last segment
start before a url decides.  Partitions are ranges of the sorted keys (equal keys
of a busy url are split by row), and the segment that is open where a partition
begins is carried in from the partitions before, one row for each.

Among the rules found for the suffixes the longest (host and path together) wins;
at equal length the longer host, then the smaller text.

Nulls and edges: a null url or one without "://" has an empty host and path and fits
no rule; a rule listed twice counts once, as block if it is listed as both; urls
without a rule get ``default``; repeated pages are judged alike.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.llm.common import ascii_lower, local_order, materialize, part_of

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEFAULT = "allow"
_BETWEEN, _AFTER = "unhex('FE')", "unhex('FF')"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(found, F.lit("")))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def _key(reversed_labels: Column, path: Column) -> Column:
    host = F.encode(F.array_join(reversed_labels, "."), "utf-8")
    return F.concat(host, F.expr(_BETWEEN), F.encode(path, "utf-8"))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows: host, path, verdict."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def segments(rules: DataFrame) -> DataFrame:
    """Disjoint key segments: low, and the innermost rule active from there (or null)."""
    keyed = (
        rules.withColumn("host", ascii_lower(F.col("host")))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block over allow
        .select(
            _key(_labels(F.col("host")), F.col("path")).alias("low"),
            F.struct(
                F.length(F.concat("host", "path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                "verdict",
            ).alias("rule"),
        )
    )
    starts = keyed.select(F.col("low").alias("at"), F.lit(1).alias("step"), "rule")
    ends = keyed.select(
        F.concat("low", F.expr(_AFTER)).alias("at"), F.lit(-1).alias("step"),
        F.lit(None).cast(keyed.schema["rule"].dataType).alias("rule"),
    )
    return _sweep(starts.unionByName(ends))


def _sweep(events: DataFrame) -> DataFrame:
    """The rule on top of the stack after each event, over ranges of the keys.

    The depth is a running sum of steps; the top of the stack after an event is the
    latest start at its depth.  What a range begins with is carried in: the depth,
    and per depth the latest start before, one row for each range (and depth).
    """
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = events.repartitionByRange(parts, "at")
    written = materialize(local_order(ranged, ["at"], "id"), "url-rules").withColumn(
        "part", part_of(F.col("id"))
    )
    earlier = (W.unboundedPreceding, -1)
    sums = written.groupBy("part").agg(F.sum("step").alias("sum"))
    depths = sums.select(
        "part",
        F.coalesce(F.sum("sum").over(W.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("base"),
    )
    inside = W.partitionBy("part").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    deep = materialize(
        written.join(F.broadcast(depths), "part").withColumn(
            "depth", F.col("base") + F.sum("step").over(inside)
        ),
        "url-depths",
    )
    started = F.when(F.col("rule").isNotNull(), F.col("id"))
    lasts = deep.groupBy("part", "depth").agg(F.max_by("rule", started).alias("last"))
    by_depth = W.partitionBy("depth").orderBy("part").rowsBetween(*earlier)
    carried = lasts.select(
        F.col("part").alias("c_part"), F.col("depth").alias("c_depth"),
        F.last("last", ignorenulls=True).over(by_depth).alias("carried"),
    )
    level = W.partitionBy("part", "depth").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    here = deep.withColumn("here", F.last("rule", ignorenulls=True).over(level))
    same = (F.col("part") == F.col("c_part")) & (F.col("depth") == F.col("c_depth"))
    top = F.when(F.col("depth") > 0, F.coalesce("here", "carried"))
    return here.join(carried, same).select(F.col("at").alias("low"), top.alias("active"))


def judge(
    pages: DataFrame, rules: DataFrame, columns: Sequence[str], default: str = DEFAULT
) -> DataFrame:
    """``columns`` of every page with host, path, rule and verdict."""
    rules = materialize(rules.select("host", "path", "verdict"), "url-rule-list")
    cuts = segments(rules)
    labels = F.size(F.split("host", r"\."))
    # label counts of rule hosts: a handful of small numbers
    depths = sorted(r[0] for r in rules.select(labels).distinct().collect())
    depth_list = F.array(*[F.lit(d) for d in depths]).cast("array<int>")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*columns).alias("page"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    probes = (
        rows.withColumn("labels", _labels(F.col("host")))
        .withColumn(
            "depth", F.explode_outer(F.filter(depth_list, lambda d: d <= F.size("labels")))
        )
        .select(
            "row", "page", "host", "path",
            F.when(
                F.col("depth").isNotNull(),
                _key(F.slice("labels", 1, F.col("depth")), F.col("path")),
            ).alias("at"),
            F.lit(None).cast(cuts.schema["active"].dataType).alias("active"),
            F.lit(False).alias("cut"),
        )
    )
    starts = cuts.select(
        F.lit(-1).cast("long").alias("row"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in ("page", "host", "path")],
        F.col("low").alias("at"), "active", F.lit(True).alias("cut"),
    )
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = starts.unionByName(probes)
    ranged = both.repartitionByRange(parts, "at", "row")
    # a segment starts before the urls that have its very key: its row is -1
    swept = materialize(local_order(ranged, ["at", "row"], "id"), "url-sweep").withColumn(
        "part", part_of(F.col("id"))
    )
    open_cut = F.when(F.col("cut"), F.struct("active"))
    lasts = swept.groupBy("part").agg(F.max_by(open_cut, F.when(F.col("cut"), F.col("id"))).alias("cut"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = lasts.select("part", F.last("cut", ignorenulls=True).over(before).alias("carried"))
    inside = W.partitionBy("part").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    here = F.last(open_cut, ignorenulls=True).over(inside)
    found = (
        swept.withColumn("here", here)
        .filter(~F.col("cut"))
        .join(F.broadcast(carried), "part")
        .withColumn("hit", F.when(F.col("at").isNotNull(), F.coalesce("here", "carried")["active"]))
    )
    best = found.groupBy("row", "page", "host", "path").agg(
        F.max(
            F.when(
                F.col("hit").isNotNull(),
                F.struct("hit.length", "hit.host_length", "hit.rule", "hit.verdict"),
            )
        ).alias("best")
    )
    return best.select(
        "page.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def digest(pages: DataFrame) -> DataFrame:
    return judge(pages, rule_table(pages.sparkSession, RULES), ["page_id"])
