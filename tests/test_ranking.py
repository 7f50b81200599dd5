"""Distributed ranks equal the window functions they stand for."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.operators import ranking
from conftest import plan


def _values(spark, n):
    # a third of all rows shares one value
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("u"), F.lpad(i.cast("string"), 6, "0")).alias("user_id"),
        F.when(i % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(50))).alias("few"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 100).cast("decimal(38,2)").alias("money"),
    )


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1003])
def test_ntile_equals_window(spark, n):
    df = _values(spark, n)
    orders = {"a": ("few", "asc"), "b": ("few", "desc"), "c": ("money", "asc"), "d": ("money", "desc")}
    mine = ranking.ntile(df, 5, "user_id", orders)
    for name, (column, way) in orders.items():
        order = F.col(column).asc() if way == "asc" else F.col(column).desc()
        mine = mine.withColumn(f"{name}_w", F.ntile(5).over(W.orderBy(order, "user_id")))
    rows = mine.collect()
    assert len(rows) == n
    assert all(r[name] == r[f"{name}_w"] for r in rows for name in orders)


def test_bucket_sizes(spark):
    df = ranking.ntile(_values(spark, 7), 5, "user_id", {"q": ("few", "asc")})
    sizes = [r["count"] for r in df.groupBy("q").count().orderBy("q").collect()]
    assert sizes == [2, 2, 1, 1, 1]


def test_ntile_result_is_a_projection(spark):
    text = plan(ranking.ntile(_values(spark, 100), 5, "user_id", {"q": ("money", "desc")}))
    assert "Exchange" not in text and "Window" not in text


def test_integer_ids(spark):
    df = spark.range(5000).select((F.col("id") % 777).cast("string").alias("name"))
    ids = ranking.integer_ids(df, "name", "n")
    assert ids.schema["n"].dataType.simpleString() == "int"
    low, high, names, numbers, rows = ids.agg(
        F.min("n"), F.max("n"), F.count_distinct("name"), F.count_distinct("n"), F.count("*")
    ).first()
    assert (low, high, names, numbers, rows) == (0, 776, 777, 777, 777)
