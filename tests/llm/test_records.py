"""Conversation repair, whitening and archives against plain versions."""

import gzip
import itertools
import os
import random

import numpy as np
import plain
import pytest
from pyspark.errors import PythonException

from clickmart.llm import conversations, warc, whitening

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))


# ------------------------------------------------------------------ 11 conversations


def odd_turns(seed=3):
    rng = random.Random(seed)
    roles = [None, "user", "assistant", "system", "tool", "", "User", "sys"]
    texts = [None, "", " \t\n\x0b", "a.", "b!", "c", "d?", "long " * 3000, "é. \n", " ", "\U0001f600"]
    rows = []
    for conv in [None, *range(40)]:
        for _ in range(rng.choice([1, 2, 5, 40, 200])):
            rows.append((conv, rng.choice([None, *range(30)]), rng.choice(roles), rng.choice(texts)))
    return rows + [(99, t, "user", "again.") for t in range(50)] + [(98, 4, "user", "tie")] * 9


@pytest.mark.parametrize("chunk", [conversations.CHUNK, 7, 1])
def test_repairs_of_odd_turns(spark, chunk):
    rows = odd_turns()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{TURNS}, at int, edit string").repartition(5)
    assert by_id(conversations.digest(df, chunk).collect()) == by_id(plain.conversations(rows))


def test_repairs_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert by_id(conversations.digest(df).collect()) == by_id(plain.conversations([tuple(r) for r in df.collect()]))


def test_repair_gives_the_rows(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "again?"), (1, 2, "assistant", "yes."), (2, 0, "bot", "x.")]
    got = conversations.repair(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "at", "step").collect()
    assert [(r.conv_id, r.edit, r.role, r.text) for r in got] == [
        (1, "D", "user", None), (1, "K", "user", "again?"), (1, "K", "assistant", "yes."), (2, "D", "bot", None),
    ]


def test_no_turns(spark):
    df = spark.createDataFrame([], TURNS)
    assert conversations.digest(df).count() == conversations.repair(df).count() == 0


def test_runs_equal_single_steps():
    """Binary powers, one run at a time, give what every row by itself gives."""
    programme = conversations.Programme()
    for symbols in ("x" * 37, "u" * 1000, "suuuaaaAAAx" * 5, "S" * 6 + "o" * 9):
        one_by_one = programme.matrix("")
        for symbol in symbols:
            one_by_one = conversations._times(one_by_one, programme.power(symbol, 0))
        assert programme.matrix(symbols) == one_by_one


def test_unrolled_cost_is_the_matrix_cost():
    programme = conversations.Programme()
    price = {"K": 0, "R": 1, "D": 2, "I": 5}
    for symbols in itertools.chain.from_iterable(itertools.product("usaoxUO", repeat=n) for n in range(1, 5)):
        edits, state = programme.unroll("".join(symbols), conversations.END, conversations.NOTHING)
        taken = "".join(edits) + conversations.closing(state)
        stays = sum(5 for s, e in zip(symbols, edits, strict=True) if s.isupper() and "D" not in e)
        best = conversations._applied(programme.matrix("".join(symbols)), conversations.END)[0]
        assert sum(price.get(c, 0) for c in taken) + stays == best


# ------------------------------------------------------------------ 12 whitening


def plain_whitening(vectors, k=16):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    away = fit - fit.mean(axis=0)
    v = away.T @ away / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    white = (x - sums / n) @ basis / np.sqrt(values)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums, strict=True)) for row in x]
    return n, white, deviation, values / np.trace(v)


def test_whitening_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = whitening.digest(df.unionByName(df.filter("vec_id % 3 = 0"))).distinct().toPandas()
    rows = df.orderBy("vec_id").collect()
    n, white, deviation, explained = plain_whitening([r.embedding for r in rows])
    mine = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * signs).max() < 1e-9
    assert set(got.n) == {n} and got.identity_error.max() < 1e-9
    assert got[got.component == 1].sort_values("vec_id").deviation.tolist() == deviation
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-10)


@pytest.mark.parametrize("values", [
    [1, 1, 1, 2, 2, 3], [1, 1 + 1e-9, 1 + 2e-9, 2, 2 + 1e-12, 5], [0, 0, 0, 0, 1, 7], [1e-8, 1, 1 + 1e-6, 1 + 1e-7, 100, 1000],
])
def test_clustered_eigenvalues(values):
    rng = np.random.default_rng(5)
    wide = np.longdouble
    q = np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(wide)
    for _ in range(4):
        q = q @ (wide(1.5) * np.eye(6) - wide(0.5) * q.T @ q)
    a = (q * np.array(values, wide)) @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.eigen(a)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-15 * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-15
    assert np.abs(a @ vectors - vectors * found).max() < 1e-15 * max(values)
    # a lone pair of the cluster of three is still told apart
    if values[1] == 1 + 1e-9:
        for value, vector in zip(found, vectors.T, strict=True):
            own = q[:, np.argmin(np.abs(np.array(values) - value))]
            assert abs(abs(float(own @ vector)) - 1) < 1e-12


def test_refinement_gains_digits_over_float32():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(40, 40))
    a = a @ a.T
    start = np.linalg.eigh(a.astype(np.float32))[1]
    values, vectors = whitening.refined(a, start)
    assert np.abs(a @ start - start * np.diag(start.T @ a @ start)).max() > 1e-7
    assert np.abs(a.astype(np.longdouble) @ vectors - vectors * values).max() < 1e-16 * np.abs(a).max() * 40


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None]), (3, [1.0, nan]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [3.0, 1.0]),
            (6, [0.0, -inf]), (7, [5.0]), (8, []), (9, [1e30, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, d int, n string")
    got = sorted((r.vec_id or 0, r.component, r.n, r.deviation, r.whitened is None, r.explained) for r in whitening.digest(df).collect())
    assert got == [
        (0, 1, 2, 20480, False, 1.0), (0, 2, 2, 20480, True, 0.0),
        *[(4, 1, 2, 20480, False, 1.0)] * 2, *[(4, 2, 2, 20480, True, 0.0)] * 2, (7, 1, 1, 0, True, None),
    ]
    assert whitening.digest(df.limit(0)).count() == 0


def test_deviation_beyond_int64_steps():
    model = whitening.Model(10**6, [10**6 * 10**6], np.array([10**6]), np.array([0.0]), np.array([1.0]), 1.0, np.eye(1))
    assert model.deviation(np.array([[10**6 + 3], [10**6 + 10**5]])) == [9 * 10**12, None]


# ------------------------------------------------------------------ 13 archives


PAGES = [(None, None, None), (7, "http://x\r\ny", ""), (8, "u", "short"), (9, None, "short"), (3, "u", "é" * 60),
         (2, "v", "é" * 60), (None, "v", "é" * 60), (2, "w", "é" * 60), (5, "u", "a" * 99), (4, "u", "a" * 99),
         (6, "u", "WARC/1.1\r\n\r\n" + "\x1f\x8b" * 100), (11, "l", "word " * 400_000), (10, "l", "word " * 400_000),
         (None, "n", "only null ids " * 9), (None, "n", "only null ids " * 9)]


def test_pages_come_back(spark):
    rows = [(*p, 1, "x") for p in PAGES]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n int, digest string").repartition(3)
    assert by_id(warc.digest(df).collect()) == by_id(plain.archived([(p, h) for p, _, h in PAGES]))
    assert warc.digest(df.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    again = df.union(df.selectExpr("page_id + 100000", "url", "html"))
    expected = plain.archived([(r.page_id, r.html) for r in again.collect()])
    assert by_id(warc.digest(again).collect()) == by_id(expected)


@pytest.fixture
def archive(spark, tmp_path):
    rows = [("response", f"urn:x:{i}", f"http://h{i % 3}/p", bytes([65 + i]) * 50_000, str(i % 2)) for i in range(12)]
    df = spark.createDataFrame(rows, "record_type string, record_id string, target_uri string, payload binary, `X-Side` string")
    extra = spark.createDataFrame([("metadata", "urn:x:m", b"k: v")], "record_type string, record_id string, payload binary")
    path = str(tmp_path / "a")
    warc.write(df.coalesce(2), path, fileBytes=200)
    warc.write(extra, path)
    return path


def test_predicates_reach_the_reader(spark, archive):
    df = warc.read(spark, archive, headers=["X-Side"])
    assert df.count() == 13
    chosen = df.filter("record_type = 'response' and target_uri like 'http://h1%' and `X-Side` in ('0') and record_id is not null")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    assert sorted(r.record_id for r in chosen.collect()) == ["urn:x:10", "urn:x:4"]
    assert {r.payload for r in chosen.collect()} == {b"E" * 50_000, b"K" * 50_000}
    for condition, n in [("target_uri is null", 1), ("not record_type = 'response'", 1), ("not target_uri = 'http://h1/p'", 8),
                         ("target_uri <=> null", 1), ("not target_uri <=> 'http://h1/p'", 9), ("content_length > 100", 12),
                         ("target_uri in ('http://h1/p', null)", 4), ("record_type = 'none'", 0), ("record_id < 'urn:x:2'", 4)]:
        assert df.filter(condition).count() == n, condition


def test_unwanted_payloads_are_not_inflated(archive):
    """A record that fails a test costs its header's inflation only."""
    file = warc._archives(archive)[0][0]
    with open(file, "rb") as raw:
        stream = warc._Gzip(raw)
        fields = warc._fields(stream)
        assert stream.given < 2 * warc._PIECE
        block = warc._Block(stream, int(fields["content-length"]))
        block.close()
        assert stream.zipped is None and raw.tell() == os.path.getsize(file)


def test_partitions_pack_files(archive):
    files = warc._archives(archive)
    assert len(files) == 13
    source = warc.WarcDataSource({"path": archive, "partitionBytes": str(3 * max(n for _, n in files))})
    parts = source.reader(source.schema()).partitions()
    assert 4 <= len(parts) <= 5 and sorted(f for p in parts for f in p.files) == [f for f, _ in files]


def test_foreign_files(spark, tmp_path):
    """Plain and wholly compressed files, folded headers, chunked and compressed payloads, bare line ends."""
    body = gzip.compress(b"hello")
    http = b"HTTP/1.1 404 Not Found\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n" + b"%x;q=1\r\n" % len(body) + body + b"\r\n0\r\n\r\n"
    head = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Target-URI: http://a\r\n b\r\nContent-Type: application/http; msgtype=response\r\n"
    record = head + b"Content-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n"
    other = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "x.warc").write_bytes(b"\r\n" + record + other)
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(record + other + record))
    (tmp_path / "_left.warc").write_bytes(b"no archive")
    got = sorted((r.record_type, r.target_uri, r.http_status, bytes(r.payload)) for r in warc.read(spark, str(tmp_path)).collect())
    assert got == sorted([("resource", None, None, b"abc")] * 2 + [("response", "http://a b", 404, b"hello")] * 3, key=str)
    thin = warc.read(spark, str(tmp_path), payload=False)
    assert "payload" not in thin.columns and thin.filter("record_type = 'resource'").count() == 2
    (tmp_path / "z.warc.gz").write_bytes(gzip.compress(record)[:-30])
    with pytest.raises(PythonException, match="z.warc.gz"):
        warc.read(spark, str(tmp_path)).collect()


def test_files_of_lost_tasks_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "a")
    df = spark.range(4).selectExpr("'resource' record_type", "if(id = 3, raise_error('lost'), cast(id as string)) record_id")
    with pytest.raises(Exception, match="lost"):
        warc.write(df, path)
    assert warc._archives(path) == []  # a task that was still running may leave its staging folder
    warc.write(spark.range(4).selectExpr("'resource' record_type", "cast(id as string) record_id"), path)
    warc.write(spark.range(2).selectExpr("'resource' record_type", "cast(id as string) record_id"), path, mode="overwrite")
    assert warc.read(spark, path).count() == 2


# ------------------------------------------------------------------ 1 sharding: one move of the texts


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_texts_move_once_to_their_shards(spark, monkeypatch, limit):
    from clickmart.llm import sharding

    df = spark.read.parquet(f"{SF}/documents.parquet")
    if not limit:
        monkeypatch.setattr(sharding, "BOUNDS_BYTES", 0)
    out = sharding.place(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "shard" in line]
    assert len(moves) >= 1 and plan.count("Exchange hashpartitioning(part") == 0
    assert out.count() == df.count()
