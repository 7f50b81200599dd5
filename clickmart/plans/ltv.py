"""Customer value by linear regression."""

from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.plans import rfm
from clickmart.storage import materialize

FEATURES = ("recency_days", "frequency", "monetary", "rfm_score", "aov")


@dataclass(frozen=True)
class LtvResult:
    model: LinearRegressionModel
    predictions: DataFrame
    r2: float
    rmse: float


def assemble(df: DataFrame, features=FEATURES) -> DataFrame:
    """Feature vector; nulls count 0."""
    numbers = df.withColumns(
        {f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    )
    assembler = VectorAssembler(inputCols=[f"_{c}" for c in features], outputCol="features")
    return assembler.transform(numbers).drop(*[f"_{c}" for c in features])


def training_set(session_sales: DataFrame, as_of: str, horizon_months: int) -> DataFrame:
    """Features up to the cut day, label = revenue in the horizon after it.

    Customers without a purchase in the horizon are labelled 0.
    """
    day = F.col("date")
    cut = F.add_months(F.lit(as_of).cast("date"), -horizon_months)
    before = session_sales.filter(day <= cut)
    after = session_sales.filter((day > cut) & (day <= F.lit(as_of).cast("date")))
    cut_day = str(session_sales.sparkSession.range(1).select(cut).first()[0])
    scored = rfm.scores(rfm.metrics(before, cut_day))
    label = after.groupBy("user_id").agg(F.sum("total_revenue").cast("double").alias("label"))
    return scored.join(label, "user_id", "left").withColumn(
        "label", F.coalesce("label", F.lit(0.0))
    )


def in_training() -> Column:
    """Four fifths of the customers, by hash."""
    return F.pmod(F.xxhash64("user_id"), F.lit(10)) < 8


def fit(train: DataFrame) -> tuple[LinearRegressionModel, float, float]:
    """Fit on four fifths of the customers (by hash), report on the rest."""
    vectors = materialize(assemble(train).select("user_id", "features", "label"), "ltv-train")
    in_train = in_training()
    model = LinearRegression(featuresCol="features", labelCol="label").fit(vectors.filter(in_train))
    held_out = model.transform(vectors.filter(~in_train))
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    return (
        model,
        evaluator.evaluate(held_out, {evaluator.metricName: "r2"}),
        evaluator.evaluate(held_out, {evaluator.metricName: "rmse"}),
    )


def predict(model: LinearRegressionModel, scored: DataFrame) -> DataFrame:
    predicted = model.transform(assemble(scored))
    return S.conform(
        predicted.withColumn("predicted_ltv_12m", F.col("prediction")), S.CUSTOMER_LTV
    )


def predict_ltv(
    session_sales: DataFrame, as_of: str, horizon_months: int = C.LTV_HORIZON_MONTHS
) -> LtvResult:
    """Train on the past, score all customers as of today."""
    model, r2, rmse = fit(training_set(session_sales, as_of, horizon_months))
    scored = rfm.scores(rfm.metrics(session_sales, as_of))
    return LtvResult(model, predict(model, scored), r2, rmse)


def same_period_ltv(session_sales: DataFrame, as_of: str) -> DataFrame:
    """The simple variant: label is the spend itself, 1 = best scores.

    The label is one of the features, so the fit says nothing about the future; it
    is kept for users who compare with that variant.
    """
    scored = rfm.scores(rfm.metrics(session_sales, as_of), best="low")
    features = ("recency_days", "frequency", "monetary", "rfm_score")
    labelled = assemble(scored, features).withColumn("label", F.col("monetary").cast("double"))
    model = LinearRegression(featuresCol="features", labelCol="label").fit(labelled)
    return S.conform(
        model.transform(labelled).withColumn("predicted_ltv_12m", F.col("prediction")),
        S.CUSTOMER_LTV,
    )
