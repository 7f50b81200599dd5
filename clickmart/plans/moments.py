"""Linear regression from mergeable moments.

The state of a fit is the number of rows, the sums and the sums of products of features and label, as decimals,
so sums of any parts of the data add up to the same numbers in any order.  New days are merged by
adding their row; the rows that were fitted before are not read again.  The small system is solved at the end, from
moments that are centred exactly.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL = "label"


@dataclass(frozen=True)
class Regression:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    r2: float | None
    n: int


def _names(features: Sequence[str]) -> list[str]:
    return [*features, LABEL]


def _pairs(features: Sequence[str]) -> list[tuple[str, str]]:
    names = _names(features)
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` (or one): n, sums ``s_x`` and sums of products ``p_x_y``; nulls count 0."""
    value = {c: F.coalesce(F.col(c).cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)")) for c in _names(features)}
    sums = [F.sum(value[c]).cast("decimal(38,4)").alias(f"s_{c}") for c in value]
    products = [F.sum(value[a] * value[b]).cast("decimal(38,8)").alias(f"p_{a}_{b}") for a, b in _pairs(features)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def merged(states: Sequence[DataFrame], features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The moments of all parts together."""
    columns = [f"s_{c}" for c in _names(features)] + [f"p_{a}_{b}" for a, b in _pairs(features)]
    both = reduce(DataFrame.unionByName, states)
    scale = {c: "decimal(38,4)" if c.startswith("s_") else "decimal(38,8)" for c in columns}
    return both.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).cast(scale[c]).alias(c) for c in columns])


def solve(state: DataFrame, features: Sequence[str]) -> Regression:
    """Least squares with intercept from one row of moments; of linearly dependent features the shortest solution."""
    row = state.first()
    n, names = row.n or 0, _names(features)
    if not n:
        return Regression(tuple(features), (0.0,) * len(features), 0.0, None, 0)
    total = {c: Fraction(row[f"s_{c}"]) for c in names}
    centred = np.zeros((len(names), len(names)))
    for a, b in _pairs(features):
        i, j = names.index(a), names.index(b)
        centred[i, j] = centred[j, i] = float(Fraction(row[f"p_{a}_{b}"]) - total[a] * total[b] / n)
    # scaled to correlations, so that large features don't hide small ones
    spread = np.sqrt(np.diag(centred))
    scale = np.divide(1, spread, out=np.zeros_like(spread), where=spread > 0)
    right = centred * scale[:, None] * scale[None, :]
    beta = np.linalg.lstsq(right[:-1, :-1], right[:-1, -1], rcond=1e-12)[0]
    coefficients = beta * scale[:-1] * spread[-1]
    mean = {c: float(total[c] / n) for c in names}
    intercept = float(mean[LABEL] - sum(c * mean[f] for c, f in zip(coefficients, features, strict=True)))
    r2 = float(beta @ right[:-1, -1]) if spread[-1] > 0 else None
    return Regression(tuple(features), tuple(map(float, coefficients)), intercept, r2, n)


def score(df: DataFrame, fit: Regression, column: str = "prediction") -> DataFrame:
    terms = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * c for f, c in zip(fit.features, fit.coefficients, strict=True)]
    return df.withColumn(column, reduce(lambda a, b: a + b, terms, F.lit(fit.intercept)))


def spending(sales: DataFrame, cut: str) -> DataFrame:
    """Per customer: orders and spend up to the day ``cut``, the label (spend after it), and the first day."""
    before = F.col("date_key") <= F.lit(cut).cast("date")
    per_order = sales.groupBy("user_id", "sale_id").agg(
        F.min("date_key").alias("first_day"), F.max(before).alias("early"),
        F.sum(F.when(before, F.col("total_amount"))).alias("spend"),
        F.sum(F.when(~before, F.col("total_amount"))).alias("later"),
    )
    return per_order.groupBy("user_id").agg(
        F.count_if("early").alias("frequency"), F.sum("spend").alias("monetary"),
        F.sum("later").alias(LABEL), F.min("first_day").alias("first_day"),
    )
