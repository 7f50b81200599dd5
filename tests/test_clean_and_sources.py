"""Readers, decoding and cleaning."""

import base64
import json

from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators import clean, dedup
from clickmart.sources import raw

EVENT = {
    "event_id": "e1", "user_id": "U1", "session_id": "s", "product_id": "P1",
    "event_type": "purchase", "price": 129.99, "timestamp": 1714392000123,
    "category": "Electronics", "brand": "Sony", "device_type": "mobile",
    "ip_address": "192.168.1.2",
}


def _lines(tmp_path, *rows):
    path = tmp_path / "raw"
    path.mkdir()
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows)
    (path / "a.json").write_text(text)
    return str(path)


def test_null_rows_go(spark):
    rows = [("U001", "purchase", 50.0), (None, "view", None), ("U002", "click", None)]
    df = spark.createDataFrame(rows, "user_id string, event_type string, price double")
    kept = clean.drop_incomplete(df)
    assert kept.count() == 2 and kept.filter("user_id IS NULL").count() == 0


def test_json_rows_are_typed(spark, tmp_path):
    path = _lines(
        tmp_path, EVENT, {**EVENT, "price": None}, {**EVENT, "price": "abc"},
        {k: v for k, v in EVENT.items() if k != "ip_address"},
        {**EVENT, "user_id": None}, {**EVENT, "timestamp": None}, {**EVENT, "event_type": None},
        "{not json",
    )
    everything = raw.read_raw(spark, path)
    assert raw.rejected(everything).count() == 1
    rows = clean.clean(raw.accepted(everything)).collect()
    assert len(rows) == 4
    assert sorted(str(r.price) for r in rows) == ["129.99", "129.99", "None", "None"]
    assert {r.hour for r in rows} == {12} and str(rows[0].date) == "2024-04-29"
    assert rows[0].event_ts.microsecond == 123000


def test_decode(spark):
    good = json.dumps(EVENT)
    texts = [base64.b64encode(good.encode()).decode(), "%%%", base64.b64encode(b"{oops").decode()]
    df = spark.createDataFrame([(t,) for t in texts], "data string")
    decoded = raw.decode(df, encoded=True)
    assert raw.accepted(decoded).count() == 1 and raw.rejected(decoded).count() == 2
    plain_text = raw.decode(spark.createDataFrame([(good,)], "data string"))
    assert raw.accepted(plain_text).first().product_id == "P1"


def test_mapped_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(
        "event_time,event_type,product_id,category_id,brand,price,user_id\n"
        "2019-10-01 00:00:00 UTC,view,44,21,shiseido,35.79,541\n"
        "broken,view,44,21,,35.79,541\n"
    )
    rows = raw.read_mapped_csv(spark, str(path), raw.csv_mapping()).collect()
    assert rows[0].timestamp == 1569888000000 and rows[0].category == "21"
    assert rows[1].timestamp is None and rows[0].ip_address is None
    assert list(rows[0].asDict()) == S.RAW_EVENT.names


def test_dedup_keeps_the_first(spark):
    rows = [("h", "view", "p", 2, "b"), ("h", "view", "p", 1, "a"), ("h", "view", "q", 3, "c"),
            ("h", "view", None, 5, "d"), ("h", "view", None, 5, "d")]
    df = spark.createDataFrame(
        rows, "event_id string, event_type string, product_id string, t int, note string"
    ).withColumn("event_ts", F.timestamp_seconds("t"))
    kept = {(r.product_id, r.note) for r in dedup.dedup(df).collect()}
    assert kept == {("p", "a"), ("q", "c"), (None, "d")}
