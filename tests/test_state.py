"""State that new rows are merged into: cohorts and aggregates by differences."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickmart.plans import aggregates, cohort_state, differences
from clickmart.plans.cohort_state import CohortState

SALES = "user_id string, date_key date, total_amount decimal(12,2)"


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def _sales(spark, rows):
    return spark.createDataFrame([(u, dt.date(2024, m, 5), v) for u, m, v in rows], "user_id string, date_key date, v int").select(
        "user_id", "date_key", F.col("v").cast("decimal(12,2)").alias("total_amount")
    )


def test_a_late_sale_moves_its_customer_to_an_earlier_cohort(spark, tmp_path):
    batches = [
        [("a", 3, 10), ("b", 3, 5), ("a", 5, 7), (None, 4, 2)],
        [("a", 1, 1), ("c", 4, 9), ("b", 4, 4)],
        [("c", 2, 3), ("a", 5, 2), (None, 4, 1)],
    ]
    state, every = CohortState(spark, str(tmp_path / "s")), []
    for n, rows in enumerate(batches):
        every += rows
        state.update(_sales(spark, rows), f"r{n}")
        assert _same(state.cohorts(), aggregates.cohorts(_sales(spark, every)))
        state.update(_sales(spark, rows), f"r{n}")  # a run counts once
    assert _same(state.cohorts(), aggregates.cohorts(_sales(spark, every)))


def test_an_update_that_was_cut_off_is_repeated(spark, tmp_path, monkeypatch):
    state = CohortState(spark, str(tmp_path / "s"))
    first, second = [("a", 3, 10), ("b", 4, 5)], [("a", 1, 1), ("c", 4, 9)]
    state.update(_sales(spark, first), "r0")
    with monkeypatch.context() as patch:
        patch.setattr(CohortState, "_count", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            state.update(_sales(spark, second), "r1")
    assert _same(state.cohorts(), aggregates.cohorts(_sales(spark, first)))
    state.update(_sales(spark, second), "r1")
    assert _same(state.cohorts(), aggregates.cohorts(_sales(spark, first + second)))


def test_the_numbers_of_many_customers_fill_several_buckets(spark, tmp_path):
    state = CohortState(spark, str(tmp_path / "s"))
    rows = spark.range(70_000).select(
        F.concat(F.lit("u"), "id").alias("user_id"),
        F.make_date(F.lit(2024), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("date_key"),
        F.lit(1).cast("decimal(12,2)").alias("total_amount"),
    )
    state.update(rows, "a")
    state.update(rows.filter("user_id like '%7'").withColumn("date_key", F.add_months("date_key", 2)), "b")
    every = rows.unionByName(rows.filter("user_id like '%7'").withColumn("date_key", F.add_months("date_key", 2)))
    assert _same(state.cohorts(), aggregates.cohorts(every))
    buckets = spark.read.schema(cohort_state._ACTIVE).parquet(f"{tmp_path}/s/active/run=a").select("bucket").distinct()
    assert buckets.count() >= 3


# ------------------------------------------------------------------ differences


def _events(spark, rows):
    return spark.createDataFrame(
        [(dt.date(2024, 1, d), c, u, k, p) for d, c, u, k, p in rows],
        "date date, category string, user_id string, event_type string, p int",
    ).select("date", "category", "user_id", "event_type", F.col("p").cast("decimal(10,2)").alias("price"))


FIRST = [(1, "x", "a", "purchase", 10), (1, "x", "a", "view", None), (1, "y", "b", "purchase", 5), (2, "x", "a", "view", None),
         (2, None, "c", "purchase", None)]


def test_a_withdrawn_row_keeps_its_user_while_others_are_left(spark, tmp_path):
    kept = differences.Maintained(spark, str(tmp_path / "m"), differences.CATEGORY_METRICS)
    kept.apply(differences.changes(_events(spark, FIRST)), "1")
    gone = [FIRST[0]]
    days = kept.apply(differences.changes(_events(spark, [(1, "x", "d", "purchase", 3)]), _events(spark, gone)), "2")
    now = [r for r in FIRST if r not in gone] + [(1, "x", "d", "purchase", 3)]
    want = aggregates.daily_category_metrics(_events(spark, now))
    assert days == ["2024-01-01"]
    assert _same(kept.view().select(*want.columns), want)
    # the last row of the only group of a day takes the day along
    kept.apply(differences.changes(_events(spark, []), _events(spark, now[2:4])), "3")
    want = aggregates.daily_category_metrics(_events(spark, now[:2] + now[4:]))
    assert _same(kept.view().select(*want.columns), want)


def test_only_changed_days_are_written(spark, tmp_path):
    import os

    kept = differences.Maintained(spark, str(tmp_path / "m"), differences.CATEGORY_METRICS)
    kept.apply(differences.changes(_events(spark, FIRST)), "1")
    files = lambda: {d: sorted(os.listdir(tmp_path / "m" / "view" / d)) for d in os.listdir(tmp_path / "m" / "view") if "=" in d}
    before = files()
    kept.apply(differences.changes(_events(spark, [(1, "z", "q", "view", None)])), "2")
    after = files()
    assert {d for d in after if after[d] != before.get(d)} == {"part=2024-01-01"}


def test_the_rows_of_a_plan_are_not_written_again(spark, tmp_path, monkeypatch):
    copies, done = [], differences.tables.materialize
    monkeypatch.setattr(differences.tables, "materialize", lambda df, label: copies.append(df.columns) or done(df, label))
    kept = differences.Maintained(spark, str(tmp_path / "m"), differences.CATEGORY_METRICS)
    kept.apply(differences.changes(_events(spark, FIRST)), "1")
    kept.apply(differences.changes(_events(spark, FIRST[:2])), "2")
    # only the view's
    assert len(copies) == 2 and all("_rows" not in columns for columns in copies)
    want = aggregates.daily_category_metrics(_events(spark, FIRST + FIRST[:2]))
    assert _same(kept.view().select(*want.columns), want)


def test_a_run_is_applied_once_even_if_cut_off(spark, tmp_path, monkeypatch):
    kept = differences.Maintained(spark, str(tmp_path / "m"), differences.CATEGORY_METRICS)
    kept.apply(differences.changes(_events(spark, FIRST)), "1")
    more = differences.changes(_events(spark, FIRST[:2]))
    done = differences.tables.replace_partitions
    with monkeypatch.context() as patch:
        def cut(spark_, path, *rest):
            if path.endswith("view"):
                raise OSError("gone")
            done(spark_, path, *rest)

        patch.setattr(differences.tables, "replace_partitions", cut)
        with pytest.raises(OSError):
            kept.apply(more, "2")
    for _ in range(2):
        kept.apply(more, "2")
    want = aggregates.daily_category_metrics(_events(spark, FIRST + FIRST[:2]))
    assert _same(kept.view().select(*want.columns), want)


def test_what_never_came_cannot_be_withdrawn(spark, tmp_path):
    kept = differences.Maintained(spark, str(tmp_path / "m"), differences.CATEGORY_METRICS)
    kept.apply(differences.changes(_events(spark, FIRST)), "1")
    with pytest.raises(Exception, match="withdrawn but unknown"):
        kept.apply(differences.changes(_events(spark, []), _events(spark, [(1, "x", "nobody", "view", None)])), "2")
