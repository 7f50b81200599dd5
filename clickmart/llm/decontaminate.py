"""Benchmark decontamination by templates.

A text becomes a template of the same number of words: numbers, units after a number
and names (capitalised words inside a sentence) turn into typed placeholders, letters
are lower-cased and punctuation goes.  Windows of 8 template words, at every place of
every text, are hashed and joined to the windows of the benchmark, so a question asked
with other numbers, units or names is still met.

Only an item's own windows are searched for: those held by at most ``HOLDERS`` different templates.  What more
of them share is an instruction ("Choose the correct answer ..."), which contaminates nothing; so
documents with a widespread phrase meet no items, and a window leads to a bounded number of templates.

A meeting counts if its slots are consistent: wherever the benchmark repeats a number,
unit or name, the document must repeat its replacement.  A document is contaminated by
an item when consistent windows make up half of the item's own windows or more; when, at one
shift with consistent slots, 13 words in a row, an own window among them, are the item's as they stand (an
excerpt); or when, at one shift, three quarters of the item's words agree with consistent slots (single words
were changed).  Items without own windows (under 8 words, hardly a word that is no placeholder, or nothing but
shared phrases) are met by their whole sequence of words as it stands.

Only the windows that meet leave their row; the texts of the few candidates are fetched
by id and checksum for the slot check.  No hint decides how the benchmark's windows are
joined: Spark broadcasts them below its size limit, else both sides shuffle.

Nulls and edges: null and empty texts meet nothing; windows with fewer than 4 words that
are no placeholder are not searched for; an item listed twice counts as one; equal items of
different ids are all reported; repeated rows are reported once per id; rows with a null
id are reported with a null id; empty tables give an empty result; further columns are
carried by ``drop``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import let, materialize, words

WINDOW = 8
MIN_LITERAL = 4
#: templates that may share a window; equal templates (the same question with other numbers) count once
HOLDERS = 5
SHARE = 0.5
#: words in a row that make an excerpt, and the share of words that makes an edited item
EXCERPT, AGREED = 13, 0.75
NUMBER, UNIT, NAME = "0", "00", "000"
PLACEHOLDERS = [NUMBER, UNIT, NAME]
#: fixed values
UNITS = (
    "kg g mg lb lbs oz ton tons tonnes km m cm mm mi mile miles ft feet foot inch inches yards yard "
    "meter meters metre metres gram grams kilogram kilograms pound pounds ounce ounces liter liters "
    "litre litres l ml gallon gallons hour hours minute minutes second seconds day days week weeks "
    "month months year years dollar dollars euro euros cent cents percent degrees mph kmh"
).split()
_NUMBERS = r"\p{Nd}+(?:[.,:/]\p{Nd}+)*"
_UNITS = rf"(?i)(?<=\b0\s)(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])"
_NAMES = r"(?<=[\p{L}\p{N},;]\s)\p{Lu}[\p{L}'’-]*"
_MARKS = r"[^\p{L}\p{N}\x20\x09-\x0D]+"


def _bare(text: Column) -> Column:
    return words(F.lower(F.regexp_replace(text, _MARKS, "")))


def template(text: Column) -> Column:
    """Template words; word i stands for word i of ``raw``."""
    shaped = F.regexp_replace(text, _NUMBERS, NUMBER)
    shaped = F.regexp_replace(shaped, _UNITS, UNIT)
    return _bare(F.regexp_replace(shaped, _NAMES, NAME))


def raw(text: Column) -> Column:
    return _bare(text)


def _window_hashes(tokens: Column) -> Column:
    """Hash of the window at each place; empty for shorter texts."""
    places = lambda w: F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    hashed = let(
        tokens, lambda w: F.transform(places(w), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    )
    return F.when(F.size(tokens) >= WINDOW, hashed)


def _literals(tokens: Column, at: Column) -> Column:
    window = F.slice(tokens, at + 1, WINDOW)
    return F.size(F.filter(window, lambda t: ~t.isin(PLACEHOLDERS)))


def items(benchmark: DataFrame) -> DataFrame:
    """item_id, item_template, item_raw of each distinct item; written."""
    distinct = benchmark.select("item_id", "text").distinct()
    shaped = distinct.select(
        "item_id", template(F.col("text")).alias("item_template"), raw(F.col("text")).alias("item_raw")
    )
    return materialize(shaped.filter(F.size("item_raw") > 0), "bench-items")


def item_windows(listed: DataFrame) -> DataFrame:
    """item_id, item_at, hash, item_windows (their number per item) of own windows; written."""
    hashes = _window_hashes(F.col("item_template"))
    literal = _literals(F.col("item_template"), F.col("item_at"))
    placed = listed.select("item_id", "item_template", F.posexplode(hashes).alias("item_at", "hash"))
    literals = placed.filter(literal >= MIN_LITERAL).select(
        "item_id", "item_at", "hash", F.xxhash64("item_template").alias("shape")
    )
    held = literals.select("hash", "shape").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("holders"))
    own = held.filter(F.col("holders") <= HOLDERS).select("hash")
    searched = literals.join(own, "hash").select("item_id", "item_at", "hash")
    counts = searched.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_windows"))
    same = F.col("item_id").eqNullSafe(F.col("counted_id"))
    return materialize(
        searched.join(counts.withColumnRenamed("item_id", "counted_id"), same).drop("counted_id"),
        "bench-windows",
    )


def _marked(listed: DataFrame, windows: DataFrame) -> DataFrame:
    """``listed`` with ``searched`` (it has own windows) and ``own_ends``: whether one ends at each word; written."""
    starts = windows.groupBy("item_id").agg(F.collect_set("item_at").alias("own_at"))
    same = F.col("item_id").eqNullSafe(F.col("own_id"))
    own = F.coalesce("own_at", F.array().cast("array<int>"))
    places = F.sequence(F.lit(0), F.size("item_raw") - 1)
    ends = F.transform(places, lambda i: F.array_contains(own, i - (WINDOW - 1)))
    return materialize(
        listed.join(starts.withColumnRenamed("item_id", "own_id"), same, "left").select(
            *listed.columns, F.col("own_at").isNotNull().alias("searched"), ends.alias("own_ends")
        ),
        "bench-marked",
    )


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.md5("text").alias("checksum"), "text")


def _meetings(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Per document, item and shift between their places: windows met, first and last place."""
    wanted = materialize(windows.select("hash").distinct(), "bench-hashes")
    met = (
        _identified(docs)
        .select("doc_id", "checksum", template(F.col("text")).alias("tokens"))
        .select("doc_id", "checksum", F.posexplode(_window_hashes(F.col("tokens"))).alias("at", "hash"))
        .join(wanted, "hash", "left_semi")
    )
    met = materialize(met.distinct(), "bench-met")
    return (
        met.join(windows, "hash")
        .groupBy("doc_id", "checksum", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.max("item_windows").alias("item_windows"),
            F.min("item_at").alias("low"), F.max("item_at").alias("high"),
        )
    )


def _slots(low: Column, high: Column, shift: Column) -> Column:
    """(benchmark word, document word) at the placeholders both templates share."""
    at = F.sequence(low, high + (WINDOW - 1))
    pair = F.transform(
        at,
        lambda i: F.struct(
            F.get("item_template", i).alias("kind"), F.get("doc_template", i + shift).alias("doc_kind"),
            F.get("item_raw", i).alias("was"), F.get("doc_raw", i + shift).alias("now"),
        ),
    )
    return F.filter(pair, lambda p: p["kind"].isin(PLACEHOLDERS) & (p["kind"] == p["doc_kind"]))


def _aligned(shift: Column) -> Column:
    """Every item word beside the document word at its place."""
    return F.transform(
        F.sequence(F.lit(0), F.size("item_raw") - 1),
        lambda i: F.struct(
            F.get("item_template", i).alias("kind"), F.get("doc_template", i + shift).alias("doc_kind"),
            F.get("item_raw", i).alias("was"), F.get("doc_raw", i + shift).alias("now"),
            F.get("own_ends", i).alias("own"),
        ),
    )


def _longest_run(pairs: Column) -> Column:
    """Most words in a row that are the same as they stand and hold an own window."""
    start = F.struct(F.lit(0).alias("run"), F.lit(False).alias("own"), F.lit(0).alias("best"))

    def step(state, p):
        run = F.when(p["was"].eqNullSafe(p["now"]), state["run"] + 1).otherwise(0)
        own = (run >= WINDOW) & (state["own"] | p["own"])
        best = F.when(own, F.greatest(state["best"], run)).otherwise(state["best"])
        return F.struct(run.alias("run"), own.alias("own"), best.alias("best"))

    return F.aggregate(pairs, start, step, lambda state: state["best"])


def _consistent(slots: Column) -> Column:
    return let(slots, lambda s: (
        F.size(F.array_distinct(F.transform(s, lambda p: F.struct(p["kind"], p["was"], p["now"]))))
        == F.size(F.array_distinct(F.transform(s, lambda p: F.struct(p["kind"], p["was"]))))
    ))


def _whole(docs: DataFrame, listed: DataFrame) -> DataFrame | None:
    """Documents that hold the whole word sequence of an item without windows."""
    short = listed.filter(~F.col("searched")).select("item_id", "item_raw").distinct()
    head = F.least(F.size("item_raw"), F.lit(WINDOW))
    keyed = materialize(
        short.select(
            F.col("item_id").alias("short_id"), F.col("item_raw").alias("short_raw"),
            head.alias("head"), F.xxhash64(F.slice("item_raw", F.lit(1), head)).alias("hash"),
        ),
        "bench-short",
    )
    # at most WINDOW different numbers
    heads = sorted(r["head"] for r in keyed.select("head").distinct().collect())
    if not heads:
        return None

    def windows(w, n):
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
        hashed = F.transform(
            places, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(w, i + 1, n)).alias("hash"))
        )
        return F.when(F.size(w) >= n, hashed).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))

    def starts(w):
        return F.flatten(F.array(*[windows(w, n) for n in heads]))

    met = (
        _identified(docs)
        .select("doc_id", "checksum", F.inline(let(raw(F.col("text")), starts)))
        .join(keyed, "hash")
        .select("doc_id", "checksum", "at", "short_id", "short_raw")
    )
    met = materialize(met, "bench-short-met")
    texts = (
        _identified(docs)
        .join(_side(met), _own("c_id", "c_sum"), "left_semi")
        .dropDuplicates(["doc_id", "checksum"])
        .select(F.col("doc_id").alias("t_id"), F.col("checksum").alias("t_sum"), raw(F.col("text")).alias("doc_raw"))
    )
    here = F.slice("doc_raw", F.col("at") + 1, F.size("short_raw")) == F.col("short_raw")
    return met.join(texts, _own("t_id", "t_sum")).filter(here).select(
        "doc_id", "checksum", F.col("short_id").alias("item_id"), F.lit(1.0).alias("share"),
        F.lit(0).cast("long").alias("slots"), F.lit(0).cast("long").alias("changed"),
    ).distinct()


def _own(other_id: str, other_sum: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col("checksum") == F.col(other_sum))


def _side(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias("c_id"), F.col("checksum").alias("c_sum")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, checksum, item_id, share, slots, changed (slots with another value)."""
    listed = items(benchmark)
    windows = item_windows(listed)
    listed = _marked(listed, windows)
    meetings = materialize(_meetings(docs, windows), "bench-meetings")
    candidates = materialize(_side(meetings), "bench-candidates")
    texts = materialize(
        _identified(docs)
        .join(candidates, _own("c_id", "c_sum"), "left_semi")
        .dropDuplicates(["doc_id", "checksum"])
        .select(
            F.col("doc_id").alias("t_id"), F.col("checksum").alias("t_sum"),
            template(F.col("text")).alias("doc_template"), raw(F.col("text")).alias("doc_raw"),
        ),
        "bench-texts",
    )
    its = listed.filter("searched").withColumnRenamed("item_id", "listed_id").drop("searched")
    is_slot = lambda p: p["kind"].isin(PLACEHOLDERS) & (p["kind"] == p["doc_kind"])
    agreed = F.size(F.filter("pairs", lambda p: F.coalesce(p["kind"] == p["doc_kind"], F.lit(False))))
    checked = (
        meetings.join(texts, _own("t_id", "t_sum"))
        .join(its, F.col("item_id").eqNullSafe(F.col("listed_id")))
        .withColumn("slots", _slots(F.col("low"), F.col("high"), F.col("shift")))
        .withColumn("pairs", _aligned(F.col("shift")))
        .select(
            "doc_id", "checksum", "item_id", "n", "item_windows",
            F.size("slots").alias("slots"),
            F.size(F.filter("slots", lambda p: p["was"] != p["now"])).alias("changed"),
            _consistent(F.col("slots")).alias("consistent"),
            (
                (_consistent(F.col("slots")) & (_longest_run(F.col("pairs")) >= EXCERPT))
                | ((agreed >= AGREED * F.size("pairs")) & _consistent(F.filter("pairs", is_slot)))
            ).alias("held"),
        )
    )
    counted = F.col("consistent") | F.col("held")
    found = checked.filter(counted).groupBy("doc_id", "checksum", "item_id").agg(
        (F.sum(F.when(F.col("consistent"), F.col("n")).otherwise(0)) / F.max("item_windows")).alias("share"),
        F.sum("slots").alias("slots"), F.sum("changed").alias("changed"), F.max("held").alias("held"),
    )
    found = found.filter(F.col("held") | (F.col("share") >= share)).drop("held")
    found = found.withColumn("share", F.least("share", F.lit(1.0)))
    whole = _whole(docs, listed)
    if whole is None:
        return found
    return found.unionByName(whole).groupBy("doc_id", "checksum", "item_id").agg(
        F.max("share").alias("share"), F.max("slots").alias("slots"), F.max("changed").alias("changed")
    )


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each contaminated document and item."""
    return leaks(docs, benchmark).select("doc_id", "item_id", "share", "slots", "changed").distinct()


def drop(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents no item contaminates, as they were."""
    bad = materialize(
        leaks(docs, benchmark).select(
            F.col("doc_id").alias("bad_id"), F.col("checksum").alias("bad_sum")
        ).distinct(),
        "bench-leaks",
    )
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", F.md5("text").alias("checksum"))
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("checksum") == F.col("bad_sum"))
    return rows.join(bad, same, "left_anti").select("doc.*")
