"""Value model, recommendations, similarity."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.operators import similarity
from clickmart.plans import ltv, recommend
from clickmart.sources import fixtures


@pytest.fixture(scope="module")
def recommender(spark):
    """Two tastes: even users like even products."""
    pairs = (
        spark.range(60).select(F.col("id").alias("u"))
        .join(spark.range(20).select(F.col("id").alias("i")), F.expr("(u * 7 + i * 3) % 5 < 3"))
    )
    rated = pairs.select(
        F.concat(F.lit("U"), "u").alias("user_id"),
        F.concat(F.lit("P"), "i").alias("product_id"),
        F.when(F.col("u") % 2 == F.col("i") % 2, 5.0).otherwise(1.0).alias("rating"),
    )
    return recommend.fit(rated)


def test_top_k(recommender):
    top = recommender.top(5)
    sizes = {r["count"] for r in top.groupBy("user_id").count().collect()}
    assert sizes == {5} and top.select("user_id").distinct().count() == 60
    parity = (F.substring("user_id", 2, 9).cast("int") + F.substring("recommended_product_id", 2, 9).cast("int")) % 2
    assert top.filter(parity == 0).count() > 0.9 * top.count()


def test_factors_lie_in_few_partitions(spark, recommender):
    """A thin block per shuffle partition made as many tasks as there are pairs of them."""
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        rated = recommender.ratings.select(F.col("user").alias("user_id"), F.col("item").alias("product_id"), "rating")
        model = recommend.fit(rated).model
        assert model.itemFactors.count() == 20 and model.itemFactors.rdd.getNumPartitions() <= 16
        assert model.recommendForAllUsers(5).count() == 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 3)


def test_seen_items_are_left_out(recommender):
    fresh = recommender.top(4, exclude_seen=True)
    seen = recommender.ratings.join(recommender.users, "user").join(recommender.items, "item")
    pairs = seen.select("user_id", F.col("product_id").alias("recommended_product_id"))
    assert fresh.join(pairs, ["user_id", "recommended_product_id"], "left_semi").count() == 0
    # everyone gets as many as exist: the best unseen of all items
    every = recommender.top(20).join(pairs, ["user_id", "recommended_product_id"], "left_anti")
    want = {r.user_id: min(4, r["count"]) for r in every.groupBy("user_id").count().collect()}
    got = {r.user_id: r["count"] for r in fresh.groupBy("user_id").count().collect()}
    assert got == want
    worst = {r.user_id: r.w for r in fresh.groupBy("user_id").agg(F.min("predicted_rating").alias("w")).collect()}
    rest = every.join(fresh, ["user_id", "recommended_product_id"], "left_anti")
    assert all(r.predicted_rating <= worst[r.user_id] for r in rest.collect())


def _masked_case(spark, n_users=70, n_items=300, zero=3):
    rng = np.random.default_rng(6)
    u = np.abs(rng.normal(size=(n_users, 5))).astype(np.float32)
    v = (np.abs(rng.normal(size=(n_items, 5))) * rng.exponential(size=(n_items, 1)) ** 3).astype(np.float32)
    u[:zero] = 0
    seen = {(a, int(b)) for a in range(n_users) for b in rng.choice(n_items, rng.integers(0, 200), replace=False)}
    seen |= {(5, b) for b in range(n_items)} | {(6, b) for b in range(n_items - 2)}
    def frame(m):
        return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id int, vector array<float>")
    users, items = frame(u), frame(v)
    return u, v, seen, users, items, spark.createDataFrame(sorted(seen), "user int, item int").repartition(4)


@pytest.mark.parametrize("part", [1, 64])
def test_masked_product_equals_brute_force(spark, monkeypatch, part):
    from clickmart.operators import masked

    monkeypatch.setattr(masked, "BLOCK", 16)
    monkeypatch.setattr(masked, "PART_BLOCKS", part)
    u, v, seen, users, items, pairs = _masked_case(spark)
    blocks, item_blocks, met = masked.plan_meetings(users, items, pairs, 4)
    every = blocks.filter("a % 2 = 0").count() * item_blocks.count()
    assert met.filter("a % 2 = 0").count() < every
    got = {}
    for r in masked.masked_topk(users, items, pairs, 4).collect():
        got.setdefault(r.user, []).append((r.item, r.rating))
    score = u.astype(float) @ v.astype(float).T
    for a in range(len(u)):
        order = sorted((b for b in range(len(v)) if (a, b) not in seen), key=lambda b: (-score[a, b], b))[:4]
        rows = sorted(got.get(a, []), key=lambda r: (-r[1], r[0]))
        assert [i for i, _ in rows] == order, a
        assert np.allclose([s for _, s in rows], score[a, order], rtol=1e-6)


def test_item_vectors(recommender):
    row = recommender.item_vectors().first()
    assert np.allclose(row.features, row.vec.toArray())


def _brute(ids, m, k):
    """The k nearest of every item: (similar id, similarity)."""
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    unit = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    sims = unit @ unit.T
    order = [sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(sims[i, j], 12), ids[j]))[:k]
             for i in range(len(ids))]
    return {ids[i]: [(ids[j], sims[i, j]) for j in row] for i, row in enumerate(order)}


def _found(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.item_id, []).append((r.rank, r.similar_id, r.similarity))
    return {i: [(s, v) for _, s, v in sorted(rows)] for i, rows in got.items()}


def _same_neighbours(got, want):
    assert set(got) == set(want)
    for i, rows in want.items():
        assert [j for j, _ in got[i]] == [j for j, _ in rows], i
        assert np.allclose([s for _, s in got[i]], [s for _, s in rows])


@pytest.mark.parametrize("block_items", [7, 1000])
def test_similarity_equals_brute_force(spark, block_items):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 8))
    m[[5, 17]] = 0
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>")
    _same_neighbours(_found(similarity.cosine_topk(items, 4, block_items=block_items)), _brute(list(range(60)), m, 4))


def _clustered(spark, clusters=40, each=30, noise=0.02):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(clusters, 12))
    m = np.repeat(centres, each, axis=0) + noise * rng.normal(size=(clusters * each, 12))
    # 200 copies of one vector, under ids that are not their order
    m[100:300] = m[100]
    ids = [f"p{x:05d}" for x in rng.permutation(len(m))]
    return ids, m, spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, m)], "id string, features array<double>")


def test_far_blocks_do_not_meet(spark):
    ids, m, items = _clustered(spark)
    plan = similarity.plan_meetings(items.select("id", F.col("features").alias("vector")), 5, 30)
    met = plan.pairs.count()
    assert plan.block_count >= 30 and met < 0.15 * plan.block_count**2
    _same_neighbours(_found(similarity.cosine_topk(items, 5, block_items=30)), _brute(ids, m, 5))


def test_long_lists_are_parts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PART_BLOCKS", 3)
    rng = np.random.default_rng(4)
    m = rng.normal(size=(90, 20))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>")
    _same_neighbours(_found(similarity.cosine_topk(items, 3, block_items=6)), _brute(list(range(90)), m, 3))


def test_a_streamed_block_serves_a_group(spark):
    """Shipped blocks grow with the items where all must meet, not with the pairs of blocks."""
    rng = np.random.default_rng(8)
    m = rng.normal(size=(192, 24))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<double>")
    plan = similarity.plan_meetings(items.select("id", F.col("features").alias("vector")), 3, 2)
    assert plan.block_count >= 64 and plan.pairs.count() <= similarity.GROUPS * plan.block_count
    _same_neighbours(_found(similarity.cosine_topk(items, 3, block_items=2)), _brute(list(range(192)), m, 3))


def test_bounds_hold():
    """No two items are more similar than the bound of their blocks."""
    rng = np.random.default_rng(2)
    m = rng.normal(size=(300, 4))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    pivots = m[:8]
    near = m @ pivots.T
    pivot, angle = near.argmax(axis=1), np.arccos(np.clip(near.max(axis=1), -1, 1))
    block = pivot * 2 + (angle > np.median(angle))
    ids = np.unique(block)
    known = similarity._Blocks(
        ids, np.array([b // 2 for b in ids]), np.array([angle[block == b].min() for b in ids]),
        np.array([angle[block == b].max() for b in ids]), np.arccos(np.clip(pivots @ pivots.T, -1, 1)),
    )
    for at, b in enumerate(ids):
        for bound, other in zip(known.bounds(at), ids, strict=True):
            assert (m[block == b] @ m[block == other].T).max() <= bound + 1e-9


def test_regression(spark, sf):
    result = ltv.predict_ltv(fixtures.order_session_sales(spark, sf), fixtures.SALES_AS_OF)
    assert result.predictions.count() == fixtures.fact_sales(spark, sf).select("user_id").distinct().count()
    assert np.isfinite(result.r2) and result.r2 < 0.999 and result.rmse > 0
    assert result.predictions.filter("predicted_ltv_12m IS NULL").count() == 0


def test_label_among_the_features_is_reproduced(spark, sf):
    rows = ltv.same_period_ltv(fixtures.order_session_sales(spark, sf), fixtures.SALES_AS_OF).collect()
    assert all(abs(float(r.monetary) - r.predicted_ltv_12m) < 0.01 for r in rows)


def test_moments_of_parts_add_up(spark):
    from clickmart.plans import moments

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1, 1000, 0.1] + [5, 1e6, 0]
    y = x @ [2.0, -0.003, 7.0] + 4 + rng.normal(size=400)
    rows = [(int(d), *map(float, r), float(v)) for d, r, v in zip(rng.integers(0, 5, 400), x, y)]
    rows += [(1, None, 1e6, None, None)]
    df = spark.createDataFrame(rows, "day int, a double, b double, c double, label double")
    names = ["a", "b", "c"]
    states = [moments.moments(df.filter(F.col("day") == d), names, ["day"]) for d in range(5)]
    fit = moments.solve(moments.merged(states, names), names)
    m = np.array([[v or 0 for v in r[1:]] for r in rows])
    m = np.round(m, 4)
    design = np.column_stack([np.ones(len(m)), m[:, :3] - m[:, :3].mean(axis=0)])
    beta = np.linalg.lstsq(design, m[:, 3], rcond=None)[0]
    assert np.allclose(fit.coefficients, beta[1:], rtol=1e-9) and fit.n == 401
    assert np.isclose(fit.r2, 1 - ((m[:, 3] - design @ beta) ** 2).sum() / ((m[:, 3] - m[:, 3].mean()) ** 2).sum())
    scored = moments.score(df, fit).toPandas()
    assert np.allclose(scored.prediction, design @ beta, rtol=1e-6, atol=1e-4)
    # twice the same feature: still solved; nothing at all: zeros
    twice = moments.solve(moments.moments(df.withColumn("d", F.col("a")), ["a", "d"]), ["a", "d"])
    assert np.isclose(twice.coefficients[0], twice.coefficients[1])
    assert moments.solve(moments.moments(df.limit(0), names), names).n == 0


def test_the_year_prunes_the_fact(spark, sf, tmp_path):
    from clickmart.plans import aggregates, dims
    from clickmart.sinks import tables

    orders = fixtures.table(spark, sf, "orders")
    dates = dims.dim_date(dims.date_bounds(orders, "o_orderdate"))
    dates.write.parquet(str(tmp_path / "dates"))
    tables.write_partitions(
        fixtures.fact_sales(spark, sf).select("date_key", "product_id", "user_id", "total_amount"), str(tmp_path / "fact"), ["date_key"]
    )
    out = aggregates.revenue_by_month(
        spark.read.parquet(str(tmp_path / "fact")), spark.read.parquet(str(tmp_path / "dates")),
        dims.dim_product(fixtures.product_source(spark, sf)), year=1998,
    )
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan and "dynamicpruning" in plan


def test_random_factors_are_not_optimal(spark, recommender):
    from dataclasses import replace

    assert recommender.optimality().agg(F.max("off")).first()[0] < 0.001
    noise = F.transform("features", lambda x: (x + F.rand(3) * 0.5).cast("float"))

    class Shaken:
        userFactors = recommender.model.userFactors.withColumn("features", noise)
        itemFactors = recommender.model.itemFactors

    shaken = replace(recommender, model=Shaken()).optimality()
    assert shaken.filter("off > 0.01").count() > 0.9 * shaken.count()
