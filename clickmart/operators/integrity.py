"""Declared constraints as checks: primary key, foreign key, not null, default."""

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_COLUMNS = ("table_name", "check_kind", "column_name", "violations")
REPORT = "table_name string, check_kind string, column_name string, violations bigint"


@dataclass(frozen=True)
class Declared:
    """What a table's definition promises; ``parents`` maps a column to the table whose key it holds."""

    key: Sequence[str]
    not_null: Sequence[str] = ()
    parents: Mapping[str, str] | None = None


#: fixed values: the constraints of the warehouse's tables
DECLARED = {
    "dim_customer": Declared(("user_id",), ("user_id", "first_seen", "last_seen")),
    "dim_product": Declared(("product_id",), ("product_id",)),
    "dim_date": Declared(("date_key",), ("date_key",)),
    "dim_session": Declared(("session_id",), ("session_id", "user_id")),
    "fact_sales": Declared(
        ("sale_id",),
        ("sale_id", "session_id", "user_id", "product_id", "date_key", "unit_price", "total_amount"),
        {"user_id": "dim_customer", "product_id": "dim_product", "date_key": "dim_date"},
    ),
    "fact_user_events": Declared(
        ("event_id",),
        ("event_id", "session_id", "user_id", "date_key", "event_timestamp"),
        {"user_id": "dim_customer", "product_id": "dim_product", "date_key": "dim_date"},
    ),
    "aggr_daily_sales": Declared(("date_key", "category"), ("date_key",)),
    "aggr_customer_cohort": Declared(("cohort_month", "period"), ("cohort_month", "period")),
}


def _marked(df: DataFrame, declared: Declared, parents: Mapping[str, DataFrame]) -> tuple[DataFrame, dict[tuple[str, str], Column]]:
    """``df`` with a mark per known parent, and the violation of each constraint as a condition."""
    broken = {("not_null", c): F.col(c).isNull() for c in declared.not_null}
    for column, table in (declared.parents or {}).items():
        if table not in parents:
            continue
        key, mark = DECLARED[table].key[0], f"_has_{column}"
        known = parents[table].select(F.col(key).alias(f"_{column}")).distinct().withColumn(mark, F.lit(True))
        df = df.join(known, F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}")
        broken["foreign_key", column] = F.col(column).isNotNull() & F.col(mark).isNull()
    return df, broken


def write_checked(
    df: DataFrame, table: str, parents: Mapping[str, DataFrame], write: Callable[[DataFrame], None],
    quarantine: Callable[[DataFrame], None],
) -> DataFrame:
    """Write the rows that keep the declared constraints; returns the violations of each.

    They are counted by the write itself.  Only if there are any, the others are read again and go to
    ``quarantine`` with the reasons.
    """
    declared = DECLARED[table]
    marked, broken = _marked(df, declared, parents)
    any_broken = F.greatest(F.lit(False), *broken.values()) if broken else F.lit(False)
    observed = Observation(f"{table}-{uuid.uuid4().hex}")
    names = {f"{kind}|{column}": F.count_if(condition) for (kind, column), condition in broken.items()}
    counted = marked.observe(
        observed, F.count_if(any_broken).alias("refused"), *[c.alias(n) for n, c in names.items()]
    )
    write(counted.filter(~any_broken).select(*df.columns))
    found = observed.get
    if found["refused"]:
        reasons = [F.when(condition, f"{kind} {column}") for (kind, column), condition in broken.items()]
        quarantine(marked.filter(any_broken).select(*df.columns, F.concat_ws(", ", *reasons).alias("reason")))
    rows = [(table, *name.split("|"), found[name]) for name in names] + [(table, "refused", "", found["refused"])]
    return df.sparkSession.createDataFrame(rows, REPORT)


def keys_report(stored: Mapping[str, DataFrame]) -> DataFrame:
    """Primary keys of stored tables, and what must not be null in those that are not written by ``write_checked``."""
    checks = []
    for table, df in stored.items():
        checks.append(primary_key(df, table, DECLARED[table].key))
        if not DECLARED[table].parents and DECLARED[table].not_null:
            checks.append(not_null(df, table, DECLARED[table].not_null))
    return report(checks)


def _line(df: DataFrame, table: str, kind: str, column: str, violations) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("check_kind"),
        F.lit(column).alias("column_name"),
        "violations",
    )


def primary_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Number of key values held by more than one row."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _line(repeated, table, "primary_key", ",".join(keys), F.count(F.lit(1)))


def foreign_key(
    df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Number of rows whose key is missing in the parent (null keys pass).

    Rows collapse to their keys before the anti join, so a frequent key is one row.
    """
    keys = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).count()
    known = parent.select(F.col(parent_key).alias("k")).distinct()
    return _line(keys.join(known, "k", "left_anti"), table, "foreign_key", key, F.sum("count"))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null counts of all ``columns`` in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns]
    )
    return counts.select(F.inline(pairs)).select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("check_kind"),
        "column_name", "violations",
    )


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.select(*_COLUMNS) for c in checks])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill absent or null columns with their declared default."""
    have = dict(df.dtypes)
    filled = {}
    for name, value in defaults.items():
        literal = F.lit(value).cast(have[name]) if name in have else F.lit(value)
        filled[name] = F.coalesce(F.col(name), literal) if name in have else literal
    return df.withColumns(filled)
