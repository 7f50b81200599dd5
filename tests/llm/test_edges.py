"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import corpus_pipeline
import plain
import pytest

import clickmart.llm.queries as registry
from clickmart.llm import minhash, mixing, phrases, pseudonyms, quality, sharding, tokens, toxicity, urls

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 7919} next{i % 104729}" for i in range(40_000))
ROWS = [
    (1, "one two three four five six seven", "en", "a", 3, "s"),
    (1, "one two three four five six seven", "en", "a", 3, "s"),
    (1, "another text of the same id", "en", "a", 3, "s"),
    (2, None, "en", "a", None, None),
    (3, "", None, "b", 0, None),
    (4, " \t\n\x0b\x0c\r ", "de", None, 7, None),
    (None, "a text without an id that is all its own", "en", "a", 1, None),
    (None, None, None, None, None, None),
    (5, LONG, "en", "a", 9, "t"),
    (6, LONG, "en", "a", 9, "t"),
    (7, "ünï\u00a0cödé \U0001f600 #*$%&|<> \u2028 x", "fr", "b", 2, None),
]
#: names that operators use for columns of their own
SCHEMA = (
    "doc_id long, text string, lang string, source string, size long, "
    "digest string"
)
CLASHES = ("node", "key", "rid", "at", "part", "shard", "slot", "rate", "draw", "kept", "checksum", "doc", "n")


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(1) for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None), (6, 0)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (None, "one two three four five six seven eight nine"), (3, "too short")],
        "item_id long, text string",
    )


@pytest.fixture(scope="module")
def operators(labels, bench):
    from clickmart.llm import decontaminate

    return {
        "sharding": sharding.digest, "quality": quality.digest, "minhash": minhash.group,
        "pseudonyms": lambda d: pseudonyms.digest(d, "k"), "tokens": tokens.digest, "mixing": mixing.digest,
        "toxicity": lambda d: toxicity.score(d, labels), "phrases": phrases.digest,
        "decontaminate": lambda d: decontaminate.digest(d, bench),
    }


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())


NAMES = ["sharding", "quality", "minhash", "pseudonyms", "tokens", "mixing", "toxicity", "phrases"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(odd, operators, name):
    assert ids(operators[name](odd)) == ids(odd)


@pytest.mark.parametrize("name", [*NAMES, "decontaminate"])
def test_empty_table(empty, operators, name):
    assert operators[name](empty).count() == 0


def test_no_leaks_in_odd_rows(odd, operators):
    assert operators["decontaminate"](odd).count() == 0


def test_empty_benchmark(odd, bench):
    from clickmart.llm import decontaminate

    assert decontaminate.digest(odd, bench.limit(0)).count() == 0


def test_odd_groups(odd):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.group(odd).collect()]
    words = [(r[0], r[1]) for r in ROWS]
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted((g[:3] for g in got), key=order) == sorted(plain.near_groups(words), key=order)
    assert all(kept == (doc == comp) for doc, _, comp, kept in got)


def test_odd_repeats(odd):
    got = [tuple(r) for r in phrases.digest(odd).collect()]
    order = lambda x: tuple((v is None, v or 0) for v in x[:2]) + x[2:]
    assert sorted(got, key=order) == sorted(plain.without_repeats([(r[0], r[1]) for r in ROWS]), key=order)


def test_odd_sizes(odd):
    rows = sharding.digest(odd).collect()
    nulls = [r for r in rows if r.size == 8 and r.text_crc32 is None]
    assert len(nulls) == 2
    assert sorted(r.size for r in rows) == sorted(8 + len((t or "").encode()) for _, t, *_ in ROWS)


def test_odd_mix(odd):
    for r in mixing.digest(odd).collect():
        assert 0 <= r.taken <= 2 * r.size
        assert r.target <= 2 * r.source_size


def test_null_texts_stay_null(odd):
    assert pseudonyms.digest(odd, "k").filter("text is null").count() == 2
    assert pseudonyms.replace(odd, "k").columns == odd.columns


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://M.Example.ORG/es/x?y"),
            (5, "HTTP://M.Example.ORG/es/x?y"), (None, "ftp://org#/"), (7, "x://org?/"), (8, "a://b.org/?q"),
            (9, "http://" + "a." * 3000 + "com/de/" + "p" * 50_000)]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "page_id long, url string, row int, at int")
    got = sorted(urls.digest(df).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    found = [(r.page_id, r.host[:13], r.path[:6], r.rule, r.verdict) for r in got]
    assert found == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "m.example.org", "/es/x", "example.org/es/", "block"),
        (5, "m.example.org", "/es/x", "example.org/es/", "block"), (7, "org", "", None, "allow"),
        (8, "b.org", "/", "org/", "allow"), (9, "a.a.a.a.a.a.a", "/de/pp", "com/de/", "block"),
        (None, "org", "", None, "allow"),
    ]
    assert urls.digest(df.limit(0)).count() == 0


# ------------------------------------------------------------------ pipeline


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=lambda x: x if isinstance(x, str) else "")
def test_stage_on_odd_rows(spark, odd, empty, name, stage):
    out = stage(spark, odd, SF)
    last = name == corpus_pipeline.STAGES[-1][0]
    kept = [c for c in odd.columns if not (last and c in ("shard", "slot"))]
    assert out.columns == kept + ["shard", "slot"] * last
    counts = {"quality_rules": 2, "near_dedup": 9, "benchmark_decontamination": 11, "shuffle_shards": 11}
    if name in counts:
        assert out.count() == counts[name]
    assert stage(spark, empty, SF).count() == 0


def test_pipeline_applies_every_stage(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    passed = {r.doc_id for r in registry.queries()["op2_quality"](spark, SF).filter("kept").collect()}
    first = docs.filter(F.col("doc_id").isin(list(passed)))
    rows = [(r.doc_id, r.text) for r in first.collect()]
    single = {c for _, _, c in plain.near_groups(rows)}
    leaked = {r.doc_id for r in registry.queries()["op7_decontaminate"](spark, SF).collect()}
    wanted = single - leaked
    taken = {r.doc_id for r in out}
    assert taken <= wanted and leaked & single
    mixed = mixing.mix(docs.filter(F.col("doc_id").isin(list(wanted)))).groupBy("doc_id").count().collect()
    times = {r.doc_id: r["count"] for r in mixed}
    found: dict = {}
    for r in out:
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == times
    counts = [sum(r.shard == s for r in out) for s in range(sharding.SHARDS)]
    assert max(counts) - min(counts) <= 1


def test_entry_works_without_the_text_operators(tmp_path):
    """The rest of the library imports with both folders and the pipeline gone."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/clickmart", tmp_path / "clickmart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not [x for x in q if x[:2] == 'op']"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60,
                   env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
