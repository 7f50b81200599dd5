"""Every text operator against a plain version or SQL, on given tables."""

import random
from collections import Counter

import duckdb
import numpy as np
import plain
import pytest
from check_oracle import compare, oracle_connection

import clickmart.llm.queries as registry
from clickmart.llm import (
    decontaminate, graph, minhash, phrases, pseudonyms, quality, sharding, tokens, toxicity, urls,
)

SF = "/root/testdata/sf0.001"
QUERIES, SQLS = registry.queries(), registry.statements()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def frame(spark, rows, schema="doc_id long, text string, lang string, source string"):
    width = len(schema.split(","))
    full = [tuple(r) + ("en", "a")[len(r) - width :] if len(r) < width else tuple(r) for r in rows]
    return spark.createDataFrame(full, schema)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_sql(spark, name):
    mine, theirs, diff = compare(spark, oracle_connection(SF), SF, name, QUERIES[name], SQLS[name])
    assert diff is None
    assert mine == theirs > 0


# ------------------------------------------------------------------ 1 sharding


def test_hypergeometric_mean_and_bounds():
    rng = random.Random(1)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert min(draws) >= 0 and max(draws) <= 20
    assert abs(np.mean(draws) - 6.0) < 0.15
    assert abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3


def test_matrix_has_exact_sums():
    sizes = [5, 0, 100, 17]
    m = sharding.communication_matrix(sizes, 7, 3)
    assert [sum(r) for r in m] == sizes
    shards = [sum(r[j] for r in m) for j in range(7)]
    assert max(shards) - min(shards) <= 1 and sum(shards) == sum(sizes)


def test_sharding(spark, docs):
    rows = QUERIES["op1_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == [d for d, _ in docs]
    size = {d: len(t.encode()) + 8 for d, t in docs}
    assert all(r.size == size[r.doc_id] and r.law == "rows" and r.grown_shard is None for r in rows)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_slots_are_gapless_over_cells(spark):
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    rows = sharding.shuffle(df, ["doc_id"], shards=4, cell_rows=100).collect()
    for shard in range(4):
        own = sorted((r.slot, r.doc_id) for r in rows if r.shard == shard)
        assert [s for s, _ in own] == list(range(750))
        ids = [d for _, d in own]
        assert abs(np.corrcoef(range(750), ids)[0, 1]) < 0.15


def test_copies_are_dealt_independently(spark):
    df = spark.range(0, 4800, numPartitions=2).select((pseudonyms.F.col("id") / 2).cast("long").alias("doc_id"))
    shards: dict = {}
    for r in sharding.shuffle(df, ["doc_id"]).collect():
        shards.setdefault(r.doc_id, []).append(r.shard)
    together = sum(a == b for a, b in shards.values())
    assert len(shards) == 2400 and 50 < together < 160  # 100 in a uniform shuffle


# ------------------------------------------------------------------ 2 quality


def test_base_statistics(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        expected, _ = plain.base_statistics(text)
        assert {k: got[doc_id][k] for k in expected} == expected
        assert not (got[doc_id].base_failed and got[doc_id].kept)


def test_junk_goes_and_clean_stays(spark):
    sf = "/root/testdata/sf0.01"
    quality_of = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op2_quality"](spark, sf).collect() if not r.base_failed]
    clean = [r.kept for r in rows if quality_of.get(r.doc_id) == 1]
    junk = [r.kept for r in rows if quality_of.get(r.doc_id) == 0]
    assert all(clean) and len(clean) > 100
    assert not any(junk) and len(junk) > 10


def test_verdict_is_the_plain_estimate(spark):
    rows = duckdb.sql(
        "SELECT doc_id, text, 'en' AS lang, 'a' AS source FROM '/root/testdata/sf0.01/documents.parquet'"
    ).fetchall()
    stats = quality.statistics(frame(spark, rows), "doc_id").cache()
    judged = {r.doc_id: r for r in quality.judge(stats, quality.fit(stats)).collect()}
    passed = [r for r in judged.values() if not r.base_failed]
    vectors = [[r.x0, r.x1, r.x2, r.x3] for r in passed]
    centre, inverse = plain.mcd(vectors)
    for r, v in zip(passed, vectors, strict=True):
        d = (np.array(v) - centre) @ inverse @ (np.array(v) - centre)
        assert r.distance == pytest.approx(d, rel=1e-6, abs=1e-9)
        assert r.kept == (d <= quality.CUT)


# ------------------------------------------------------------------ 3 near-duplicates


def edited(tokens, share, rng):
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else t for t in tokens]


def test_near_groups_on_the_table(spark, docs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op3_minhash"](spark, SF).collect()]
    assert sorted(got) == sorted(plain.near_groups(docs))


def test_near_groups_of_many_edits(spark):
    """A large group whose members are partly similar to the first text only."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(160)]
    rows = [(i, " ".join(edited(base, rng.choice([0.01, 0.02, 0.03, 0.04]), rng))) for i in range(150)]
    rows += [(1000 + i, " ".join(f"v{rng.randrange(900)}" for _ in range(60))) for i in range(30)]
    rows += [(2000 + i, rows[i][1]) for i in range(20)]
    rng.shuffle(rows)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in minhash.group(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(plain.near_groups(rows))


def test_remaining_pairs_are_found_without_representatives(spark, monkeypatch):
    """The last round alone finds every link, over several blocks of a bucket."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(base, 0.01, rng))) for i in range(120)]
    monkeypatch.setattr(minhash, "BLOCK", 16)
    none = lambda *_: spark.createDataFrame([], "u long, v long")
    monkeypatch.setattr(minhash, "_representative_pairs", none)
    monkeypatch.setattr(minhash, "_hub_pairs", none)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in minhash.group(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(plain.near_groups(rows))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = graph.components(spark.createDataFrame(edges, "u long, v long"), "t").collect()
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert {(r.node, r.component) for r in found} == {(x, root(x)) for x in linked}


def test_dedup_keeps_one_of_each_group(spark, docs):
    df = frame(spark, docs)
    kept = sorted(r.doc_id for r in minhash.dedup(df).collect())
    assert kept == sorted({c for _, _, c in plain.near_groups(docs)})


# ------------------------------------------------------------------ 4 pseudonyms

PRIVATE = (
    "Call +1 (743) 555-3824 or +1 743 555 3824, card 4041894974608795 or 4041 8949 7460 8795, "
    "not 4041894974608796; ip 70.123.182.155 not 300.1.1.1, ssn 123-45-6789, born 1984-02-29 "
    "or 29/02/1984 not 2023-02-30, mail bosbt.42@mail8.example.com, version 1.2.3"
)


KEY = "a test key"


def test_pseudonyms_round_trip(spark):
    df = frame(spark, [(1, PRIVATE), (2, "again 4041894974608795 and 70.123.182.155")])
    rows = {r.doc_id: r for r in pseudonyms.digest(df, KEY).collect()}
    text = rows[1].text
    for value in ("555-3824", "4041894974608795", "70.123.182.155", "123-45-6789", "1984-02-29", "bosbt"):
        assert value not in text
    for value in ("4041894974608796", "300.1.1.1", "2023-02-30", "@mail8.example.com", "version 1.2.3"):
        assert value in text
    found = text.split("card ")[1].split(" or ")
    card, spaced = found[0], found[1].split(",")[0]
    assert plain.luhn(card) and spaced == " ".join(card[i : i + 4] for i in range(0, 16, 4))
    assert f"again {card} and" in rows[2].text
    assert (rows[1].n_phone, rows[1].n_card, rows[1].n_date, rows[1].n_email) == (2, 2, 2, 1)
    back = pseudonyms._swapped(df.select("doc_id", pseudonyms.F.lit(text).alias("text")), KEY, undo=True)
    restored = back.select("fresh").first()[0]
    mail = text.split("mail ")[1].split(",")[0]
    assert restored.replace(mail, "bosbt.42@mail8.example.com") == PRIVATE


def test_cards_beside_short_numbers(spark):
    beside = [
        "card 4111111111111111 12/27", "4111111111111111 123", "7 4111111111111111", "12 4111111111111111 345",
        "4111111111111111 5500000000000004", "1234 4111 1111 1111 1111", "4111-1111-1111-1111 123",
        "4111 11111111 1111 123", "4111111111111111 12a", "4111111111111111 123-45-6789",
    ]
    df = frame(spark, [*enumerate(beside), (99, "only 4111111111111111"), (100, "no 4111111111111112 12")])
    rows = {r.doc_id: r for r in pseudonyms.digest(df, KEY).collect()}
    card = rows[99].text.removeprefix("only ")
    assert plain.luhn(card) and card != "4111111111111111"
    written = {
        0: f"card {card} 12/27", 1: f"{card} 123", 2: f"7 {card}", 3: f"12 {card} 345", 8: f"{card} 12a",
        5: "1234 " + " ".join(card[i : i + 4] for i in range(0, 16, 4)),
        6: "-".join(card[i : i + 4] for i in range(0, 16, 4)) + " 123",
        7: f"{card[:4]} {card[4:12]} {card[12:]} 123", 100: "no 4111111111111112 12",
    }
    assert {i: rows[i].text for i in written} == written
    assert rows[4].text.startswith(f"{card} ") and "5500000000000004" not in rows[4].text
    assert rows[9].text.startswith(f"{card} ") and "123-45-6789" not in rows[9].text
    assert [rows[i].n_card for i in range(10)] == [1, 1, 1, 1, 2, 1, 1, 1, 1, 1] and rows[9].n_ssn == 1


def test_values_in_other_forms(spark):
    values = [
        "667-12-3456", "899-01-0001", "665-01-0001", "(743) 555-3824", "743-555-3824", "743.555.3824", "743 555 3824",
        "+44 20 7946 0958", "+49 (0)30 1234567", "+33 1 23 45 67 89", "01 23 45 67 89", "030/1234567",
        "(020) 7946 0958", "03/25/1984", "3/25/1984", "25.03.1984", "3/5/1984", "3.5.1984", "3/10/1984",
        "25/3/1984", "29/2/1984", "02/29/1984", "10/31/1984",
    ]
    left = ["666-12-3456", "900-12-3456", "000-12-3456", "31/31/1984", "29/2/1985", "30.02.1984", "1.2.3"]
    df = frame(spark, list(enumerate(f"is {v} here" for v in values + left)))
    rows = {r.doc_id: r.text for r in pseudonyms.digest(df, KEY).collect()}
    shape = lambda text: "".join("9" if c.isdigit() else c for c in text)
    for i, v in enumerate(values):
        assert rows[i] != f"is {v} here" and shape(rows[i]) == shape(f"is {v} here"), v
    assert [rows[len(values) + i] for i in range(len(left))] == [f"is {v} here" for v in left]
    back = frame(spark, sorted(rows.items()))
    for r in pseudonyms._swapped(back, KEY, undo=True).select("doc_id", "fresh").collect():
        assert r.fresh == f"is {(values + left)[r.doc_id]} here"


def test_dates_of_one_form_are_permuted(spark):
    F = pseudonyms.F
    day = F.expr("date_add(date'1800-01-01', cast(id as int))")
    dates = spark.range(20_000).select(
        F.when(F.dayofmonth(day) > 12, F.date_format(day, "M/d/yyyy")).otherwise(F.date_format(day, "d/M/yyyy")).alias("v")
    ).distinct()
    rows = dates.select("v", pseudonyms.pseudonym(F.col("v"), KEY).alias("p"))
    found = rows.agg(F.count("v").alias("n"), F.countDistinct("p").alias("d")).first()
    assert found.n == found.d and rows.filter("v != p").count() > 0.99 * found.n


def test_feistel_is_a_permutation(spark):
    F = pseudonyms.F
    df = spark.range(30 * 7).select(
        pseudonyms.feistel(
            F.floor(F.col("id") / 7), F.col("id") % 7, F.lit(30), F.lit(7), "k", "x"
        ).alias("s")
    )
    found = {(r.s.l, r.s.r) for r in df.collect()}
    assert found == {(a, b) for a in range(30) for b in range(7)}


def test_table_keeps_no_valid_value(spark, docs):
    import re

    rows = {r.doc_id: r.text for r in QUERIES["op4_pseudonyms"](spark, SF).collect()}
    for doc_id, text in docs:
        for found in re.findall(r"(?<!\w)\d{16}(?!\w)", text):
            assert (found in rows[doc_id]) == (not plain.luhn(found))
        for found in re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+@[\w.]+\.com", text):
            assert found not in rows[doc_id]


# ------------------------------------------------------------------ 5 urls


def test_nested_rules_against_plain(spark):
    rng = random.Random(8)
    hosts = ["a", "b.a", "c.b.a", "x.a", "b"]
    paths = ["/", "/p", "/p/", "/p/q", "/p/q/r", "", "/z"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.5]
    pages = [
        (i, f"http://{rng.choice(['', 'm.', 'n.m.'])}{rng.choice([*hosts, 'q'])}{rng.choice(paths)}{rng.choice(['', 'q', '?x', '#/p'])}")
        for i in range(300)
    ]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(df, urls.rule_table(spark, rules), ["page_id"]).collect()}
    for page_id, url in pages:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:end], rest[end:].split("?")[0].split("#")[0]
        fits = [
            (len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule, verdict = max(fits)[2:] if fits else (None, "allow")
        assert (got[page_id].host, got[page_id].path) == (host, path)
        assert (got[page_id].rule, got[page_id].verdict) == (rule, verdict), url


# ------------------------------------------------------------------ 6 token counts


def test_token_counts(spark, docs):
    coder = tokens.encoding(tokens.load_ranks(tokens.TOKENIZER))
    got = {r.doc_id: r.n_tokens for r in QUERIES["op6_tokens"](spark, SF).collect()}
    assert got == {d: len(coder.encode_ordinary(t)) for d, t in docs}


@pytest.mark.parametrize("block,whole", [(1, 1 << 20), (3, 1 << 20), (64, 1 << 20), (3, 100), (64, 100), (1000, 0)])
def test_flat_files(spark, tmp_path, block, whole, monkeypatch):
    monkeypatch.setattr(tokens, "RUN", 4)
    monkeypatch.setattr(tokens, "WHOLE", whole)
    end, rng = 9, random.Random(block)
    expected = []
    for name in ("a", "b", "c"):
        ids = [rng.choice([1, 2, 3, 9]) for _ in range(200)] if name != "c" else [5, 6]
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
        parts, start = " ".join(map(str, ids)).split("9"), 0
        counts = [len(p.split()) for p in parts]
        for n, count in enumerate(counts):
            finished = n < len(counts) - 1
            if finished or count:
                expected.append((name, n, start, count, finished))
            start += count + 1
    blocks = tokens.read_flat(spark, str(tmp_path), block=block)
    found = [
        (r.file.rsplit("/")[-1], r.ordinal, r.start, r.n_tokens, r.finished)
        for r in tokens.lengths(blocks, end=end).collect()
    ]
    assert sorted(found) == sorted(expected)


# ------------------------------------------------------------------ 7 decontamination


def test_exact_leaks_are_found(spark, docs):
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    exact = {
        (d, i) for d, t in docs for i, b in bench
        if f" {' '.join(plain.words(b))} " in f" {' '.join(plain.words(t))} "
    }
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert exact and exact <= got
    # whatever else is reported shares half of an item's five-word runs
    for d, i in got - exact:
        own, its = plain.shingles(dict(docs)[d]), plain.shingles(dict(bench)[i])
        assert len(own & its) >= 0.3 * len(its)


ITEM = (
    "A train travels 120 km in 2 hours while the driver Anna Smith waits at the station, then goes "
    "120 km back to the depot. How many hours does the train need in total for both ways?"
)


def test_templates(spark):
    renumbered = ITEM.replace("120", "45").replace("2 hours", "3 hours").replace("Anna Smith", "Bob Jones")
    mixed = renumbered.replace("45 km back", "77 km back")
    docs = [
        (1, "Some prose before. " + ITEM + " And after."), (2, renumbered), (3, mixed),
        (4, "A train travels far and wide while nobody waits at the station, then it goes home to rest."),
    ]
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.digest(frame(spark, docs), bench).collect()}
    assert set(got) == {1, 2}
    assert got[1].changed == 0 and got[2].changed > 0
    kept = sorted(r.doc_id for r in decontaminate.drop(frame(spark, docs), bench).collect())
    assert kept == [3, 4]


def test_excerpts_edits_and_short_items(spark):
    long = " ".join(f"term{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59))
    words = long.split()
    edit = lambda n, *at: " ".join("other" if i in at else w for i, w in enumerate(words[:n]))
    items = [(1, long), (2, " ".join(words[:20])), (3, "what is the capital"), (4, "1 2 3 4 5 6 7 8 9 10 11 12")]
    docs = [
        (1, "before " + " ".join(words[30:45]) + " after"), (2, "so " + edit(20, 10) + " end"),
        (3, "asked: What is the capital? of nothing"), (4, "count 1 2 3 4 5 6 7 8 9 10 11 12 now"),
        (5, "what is the best capital"), (6, "count 1 2 3 4 5 6 7 8 9 10 11 13 now"),
        (7, "before " + " ".join(words[40:50]) + " after"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.digest(frame(spark, docs), bench).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4)}
    assert sorted(r.doc_id for r in decontaminate.drop(frame(spark, docs), bench).collect()) == [5, 6, 7]


def test_leaks_of_the_table_equal_a_plain_search(spark, docs):
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert got == plain.leaks(docs, bench, decontaminate.UNITS)


def test_a_shared_instruction_contaminates_nothing(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    order = "choose the correct answer from the list below and explain your choice in words"
    bench = [(i, f"{order} {' '.join(word() for _ in range(12))} with 3 apples") for i in range(200)]
    docs = [(d, f"{' '.join(word() for _ in range(20))} {order} {' '.join(word() for _ in range(20))}") for d in range(300)]
    leaked = [(1000, "so " + bench[3][1] + " end"), (1001, bench[5][1].replace("3 apples", "9 apples")),
              (1002, "see " + " ".join(bench[9][1].split()[9:24]) + " there")]
    # the same question with other numbers is one template, however many items hold it
    bench += [(900 + n, f"how many marbles has the boy when he gives {n} of his {n + 40} away") for n in range(20)]
    leaked.append((1003, "asked how many marbles has the boy when he gives 5 of his 45 away"))
    listed = spark.createDataFrame(bench, "item_id long, text string")
    windows = decontaminate.item_windows(decontaminate.items(listed))
    assert decontaminate._meetings(frame(spark, docs), windows).count() == 0
    got = {(r.doc_id, r.item_id) for r in decontaminate.digest(frame(spark, docs + leaked), listed).collect()}
    assert got == plain.leaks(docs + leaked, bench, decontaminate.UNITS)
    assert {(1000, 3), (1001, 5), (1002, 9)} <= got and {d for d, _ in got} == {1000, 1001, 1002, 1003}
    kept = decontaminate.drop(frame(spark, docs + leaked), listed)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(300))


# ------------------------------------------------------------------ 9 toxicity


def test_training_rows_keep_different_texts_and_labels(spark):
    rng, shared = random.Random(9), " ".join(f"licence{i}" for i in range(60))
    own = [f"{shared} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(30)]
    texts = [*enumerate(own), (100, own[0] + " end"), (101, own[0]), (102, own[1] + " end"), (103, own[2])]
    # own[0] and its copies are clean; a toxic near copy and a toxic exact copy of clean texts
    labels = [(i, int(i in (102, 103))) for i, _ in texts]
    # ids that are all in the training part
    ids = spark.range(5000).filter(~toxicity.held_out(toxicity.F.col("id"))).limit(200).collect()
    place = {i: ids[n].id for n, (i, _) in enumerate(texts)}
    docs = spark.createDataFrame([(place[i], t) for i, t in texts], "doc_id long, text string")
    known = spark.createDataFrame([(place[i], t) for i, t in labels], "doc_id long, toxic int")
    train = [(r.text, r.toxic) for r in toxicity.training_rows(docs, known).collect()]
    toxic = [t for t, label in train if label == 1]
    clean = [t for t, label in train if label == 0]
    assert sorted(toxic) == sorted([own[1] + " end", own[2]])
    assert len(clean) == 30 and set(own[1:]) <= set(clean)


def test_automaton_is_the_edit_distance():
    rng = random.Random(3)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randrange(5, 8))) for _ in range(60)}
    root = toxicity.trie(terms)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(3, 9)))
        found = toxicity.intersect(toxicity.LevenshteinAutomaton(word, 1), root)
        assert set(found) == {t for t in terms if plain.within_one_edit(word, t)}
        assert len(found) == len(set(found))
        match = toxicity.Matcher({t: 1.0 for t in terms}, {})
        assert match.near(word) or not found


def test_terms_behind_inner_punctuation_are_found():
    match = toxicity.Matcher({"idiot": 4.0, "moron": 5.0}, {"stup": 3.5})
    assert match("idiot...moron") == ("exact", 5.0) and match("you,idiot") == ("exact", 4.0)
    assert match("so-stupid") == ("stem", 3.5) and match("well-known") is None
    assert toxicity.features("what a you,idiot", match)[1] > 0


def test_quotation_is_told_from_abuse():
    match = toxicity.Matcher({"idiot": 5.0}, {})
    plain_hit = dict(zip(toxicity.FEATURES, toxicity.features("you are an idiot for sure", match), strict=True))
    quoted = dict(zip(toxicity.FEATURES, toxicity.features('she said “you idiot” to him', match), strict=True))
    typo = dict(zip(toxicity.FEATURES, toxicity.features("you are an idiiot", match), strict=True))
    assert plain_hit["plain"] and not plain_hit["quoted"]
    assert quoted["quoted"] and not quoted["plain"]
    assert typo["fuzzy"] and not typo["plain"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op9_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in toxic]
    hits = sum(r.predicted for r in rows if toxic[r.doc_id] == 1)
    # some of the labelled texts hold no term at all
    assert hits >= 0.9 * sum(toxic[r.doc_id] == 1 for r in rows) > 50
    assert sum(r.predicted for r in rows if toxic[r.doc_id] == 0) <= 0.01 * len(rows)


# ------------------------------------------------------------------ 10 phrases


def test_repeats_on_the_table(spark, docs):
    got = [tuple(r) for r in QUERIES["op10_phrases"](spark, SF).collect()]
    assert sorted(got) == sorted(plain.without_repeats(docs))


def test_overlapping_repeats(spark, monkeypatch):
    """Passages that share parts, repeat within a text and begin or end anywhere."""
    rng = random.Random(4)
    monkeypatch.setattr(phrases, "PHRASE_WINDOWS", 5)
    monkeypatch.setattr(phrases, "SHARD_WORDS", 300)
    monkeypatch.setattr(phrases, "STRETCH_WORDS", 500)
    source = [f"w{rng.randrange(400)}" for _ in range(400)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            low = rng.randrange(360)
            parts += source[low : low + rng.randrange(20, 90)]
            parts += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 30))]
        rows.append((i, " ".join(parts)))
    rows += [(100, "a b " * 60), (101, "a b " * 25), (102, " ".join(["z"] * 50))]
    got = [tuple(r) for r in phrases.digest(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(plain.without_repeats(rows))
