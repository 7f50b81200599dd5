"""Interactions, collaborative filtering and item similarity."""

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.functions.scalar import interaction_rating
from clickmart.operators import masked, ranking, similarity
from clickmart.storage import materialize, scratch_path

INTERACTION_TYPES = (C.VIEW, C.CART_ADD, C.PURCHASE)
#: a step sends a user's factors to every block that holds one of its items, so blocks are no thinner than needed
BLOCK_RATINGS = 1_000_000
MIN_BLOCKS = 16


def interactions(events: DataFrame) -> DataFrame:
    """Mean rating per user and product over views, cart adds and purchases."""
    return (
        events.filter(F.col("event_type").isin(*INTERACTION_TYPES))
        .filter(F.col("product_id").isNotNull())
        .withColumn("rating", interaction_rating(F.col("event_type")))
        .groupBy("user_id", "product_id")
        .agg(F.avg("rating").alias("rating"))
    )


@dataclass(frozen=True)
class Recommender:
    """A fitted model with the id tables it needs."""

    model: ALSModel
    users: DataFrame  # user_id, user
    items: DataFrame  # product_id, item
    ratings: DataFrame  # user, item, rating

    def top(self, k: int = C.TOP_K, exclude_seen: bool = False) -> DataFrame:
        """``user_id, recommended_product_id, predicted_rating`` for every user."""
        recs = self._unseen(k) if exclude_seen else _flat(self.model.recommendForAllUsers(k))
        named = recs.join(self.users, "user").join(self.items, "item")
        return S.conform(
            named.select(
                "user_id",
                F.col("product_id").alias("recommended_product_id"),
                F.col("rating").alias("predicted_rating"),
            ),
            S.PRODUCT_RECOMMENDATIONS,
        )

    def _unseen(self, k: int) -> DataFrame:
        """Top k among the items a user has no rating for."""
        def factors(df: DataFrame) -> DataFrame:
            return df.select("id", F.col("features").alias("vector"))

        return masked.masked_topk(
            factors(self.model.userFactors), factors(self.model.itemFactors), self.ratings.select("user", "item"), k
        )

    def optimality(self) -> DataFrame:
        """Per user, how far its factors are from the best for the given item factors: ``user_id, ratings, off``.

        The last half step solves for the users: regularised least squares over factors that are not negative.  At
        its solution every slope is zero, or not negative where the factor is zero.  ``off`` is the largest
        breach, relative to the size of the terms that cancel; random factors are off by about one.
        """
        reg = float(C.ALS_REG_PARAM)

        def side(factors: DataFrame, key: str, column: str) -> DataFrame:
            vector = F.transform("features", lambda x: x.cast("double"))
            return factors.select(F.col("id").alias(key), vector.alias(column))

        users, items = side(self.model.userFactors, "user", "u"), side(self.model.itemFactors, "item", "v")
        dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
        terms = self.ratings.join(items, "item").join(users, "user").withColumn("dot", dot)
        slopes = terms.select("user", "rating", "dot", F.posexplode("v").alias("k", "x")).groupBy("user", "k").agg(
            F.sum(F.col("dot") * F.col("x")).alias("fitted"), F.sum(F.col("rating") * F.col("x")).alias("wanted"),
            F.count(F.lit(1)).alias("n"),
        )
        own = users.select("user", F.posexplode("u").alias("k", "factor"))
        pull = F.lit(reg) * F.col("n") * F.col("factor")
        slope = F.col("fitted") - F.col("wanted") + pull
        breach = F.when(F.col("factor") > 0, F.abs(slope)).otherwise(F.greatest(-slope, F.lit(0.0)))
        off = (
            slopes.join(own, ["user", "k"])
            .groupBy("user").agg(
                F.max("n").alias("ratings"), (F.max(breach) / F.max(F.col("fitted") + F.col("wanted") + pull)).alias("off")
            )
        )
        return off.join(self.users, "user").select("user_id", "ratings", "off")

    def item_vectors(self) -> DataFrame:
        """``product_id, features`` (array) and ``vec`` (vector) of every item."""
        return (
            self.model.itemFactors.join(self.items, F.col("id") == F.col("item"))
            .select("product_id", "features", array_to_vector("features").alias("vec"))
        )

    def similar_items(self, k: int = C.TOP_K) -> DataFrame:
        return similarity.cosine_topk(self.item_vectors(), k, "product_id", "features")


def _flat(recommendations: DataFrame) -> DataFrame:
    return recommendations.select("user", F.explode("recommendations").alias("rec")).select(
        "user", F.col("rec.item").alias("item"), F.col("rec.rating").alias("rating")
    )


def _stored(model: ALSModel, spark: SparkSession) -> ALSModel:
    """The model written and read back: few full partitions of factors in place of one per block.

    All partitions of users meet all of items, and each such meeting hands on k rows per user: thin ones
    make as many tasks as there are pairs of blocks, and hand on nearly every product.
    """
    path = scratch_path(spark, "als-model")
    model.save(path)
    return ALSModel.load(path)


def fit(
    rated: DataFrame,
    seed: int = 42,
    rank: int = 10,
    implicit_prefs: bool = False,
    blocks: int | None = None,
) -> Recommender:
    """Alternating least squares on the interactions, with text ids mapped to integers.

    Factors are kept in a block per ``BLOCK_RATINGS``, ``MIN_BLOCKS`` at least and as many as the session has
    shuffle partitions at most, unless ``blocks`` is given.
    """
    rated = materialize(rated, "interactions")
    users = ranking.integer_ids(rated, "user_id", "user")
    items = ranking.integer_ids(rated, "product_id", "item")
    numbered = materialize(
        rated.join(users, "user_id").join(items, "product_id").select("user", "item", "rating"),
        "ratings",
    )
    if blocks is None:
        wanted = max(MIN_BLOCKS, -(-numbered.count() // BLOCK_RATINGS))
        blocks = min(wanted, int(rated.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    als = ALS(
        rank=rank,
        maxIter=C.ALS_MAX_ITER,
        regParam=C.ALS_REG_PARAM,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        coldStartStrategy="drop",
        nonnegative=True,
        implicitPrefs=implicit_prefs,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        seed=seed,
    )
    return Recommender(_stored(als.fit(numbered), rated.sparkSession), users, items, numbered)
