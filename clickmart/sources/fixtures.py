"""The given benchmark tables mapped onto the event and star-schema model."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.operators import clean as cleaning
from clickmart.session import configure

EVENTS_AS_OF = "2024-01-31"
SALES_AS_OF = "2001-08-01"

# (first address, last address, country, city)
GEO_RANGES = [
    ("10.0.0.0", "10.255.255.255", "US", "A"),
    ("11.0.0.0", "11.255.255.255", "DE", "B"),
    ("12.0.0.0", "12.127.255.255", "IN", "C"),
]


_LONG, _INT, _DOUBLE, _TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TIME = T.TimestampNTZType()


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# fixed schemas: opening a table needs no job that reads file footers
TABLES = {
    "events": _schema(
        event_id=_LONG, ts=_TIME, user_id=_LONG, event_type=_TEXT, value=_DOUBLE, props=_TEXT
    ),
    "customer": _schema(
        c_custkey=_LONG, c_name=_TEXT, c_nationkey=_INT, c_acctbal=_DOUBLE, c_mktsegment=_TEXT
    ),
    "part": _schema(
        p_partkey=_LONG, p_name=_TEXT, p_brand=_TEXT, p_type=_TEXT, p_size=_INT,
        p_retailprice=_DOUBLE,
    ),
    "orders": _schema(
        o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=_TEXT, o_totalprice=_DOUBLE,
        o_orderdate=_TIME, o_orderpriority=_TEXT,
    ),
    "lineitem": _schema(
        l_orderkey=_LONG, l_partkey=_LONG, l_suppkey=_LONG, l_linenumber=_INT,
        l_quantity=_DOUBLE, l_extendedprice=_DOUBLE, l_discount=_DOUBLE, l_tax=_DOUBLE,
        l_returnflag=_TEXT, l_linestatus=_TEXT, l_shipdate=_TIME,
    ),
    "nation": _schema(n_nationkey=_INT, n_name=_TEXT, n_regionkey=_INT),
    "embeddings": _schema(vec_id=_LONG, embedding=T.ArrayType(T.FloatType()), label=_INT),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_columns():
    """Raw event columns over the columns of the events table (no join needed)."""
    user = F.col("user_id")
    octets = [
        (F.lit(10) + user % 4).cast("string"),
        (F.floor(user / 256) % 256).cast("string"),
        (user % 256).cast("string"),
        F.lit("1"),
    ]
    device = F.element_at(
        F.array(*[F.lit(d) for d in C.DEVICES]), (F.col("event_id") % 3 + 1).cast("int")
    )
    event_type = F.when(F.col("event_type") == "signup", C.CART_ADD).otherwise(F.col("event_type"))
    return {
        "event_id": F.col("event_id").cast("string"),
        "user_id": user.cast("string"),
        "session_id": F.lit(None).cast("string"),
        "product_id": F.get_json_object("props", "$.k"),
        "event_type": event_type,
        "price": F.when(F.col("event_type") == C.PURCHASE, F.col("value").cast("string")),
        "timestamp": F.unix_millis(F.col("ts").cast("timestamp")),
        "device_type": device,
        "ip_address": F.concat_ws(".", *octets),
    }


def as_raw(events: DataFrame, part: DataFrame) -> DataFrame:
    """Events table (batch or stream) as raw events; category and brand come from ``part``."""
    products = part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
    )
    named = events.select(*[e.alias(n) for n, e in event_columns().items()])
    return named.join(products, "product_id", "left").select(*S.RAW_EVENT.names)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream of raw events."""
    stream = configure(spark).readStream.schema(TABLES["events"]).parquet(
        f"{sf_dir}/events.parquet*"
    )
    return as_raw(stream, table(spark, sf_dir, "part"))


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(raw_events(spark, sf_dir))


def geo_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        GEO_RANGES, "ip_from string, ip_to string, country string, city string"
    )


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales facts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast(S.AMOUNT)
    rate = F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return S.conform(
        joined.select(
            F.col("l_orderkey").alias("sale_id"),
            F.col("l_orderkey").alias("session_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("product_id"),
            F.to_date("o_orderdate").alias("date_key"),
            F.hour("o_orderdate").alias("hour"),
            F.col("l_quantity").alias("quantity"),
            (price / F.col("l_quantity").cast("decimal(10,0)")).alias("unit_price"),
            (price * rate).alias("total_amount"),
            (price * F.col("l_discount").cast("decimal(4,2)")).alias("discount_amount"),
            (price * F.col("l_tax").cast("decimal(4,2)")).alias("tax_amount"),
        ),
        S.FACT_SALES,
    )


def product_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product attributes as the product dimension expects them."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(S.PRICE).alias("price"),
    )


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their country."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customer.join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(F.col("c_custkey").cast("string").alias("user_id"), F.col("n_name").alias("country"))


def order_session_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of session sales: one order is one session."""
    order = F.col("sale_id").cast("bigint")
    device = F.element_at(
        F.array(*[F.lit(d) for d in C.DEVICES]), (order % 3 + 1).cast("int")
    )
    return S.conform(
        fact_sales(spark, sf_dir)
        .groupBy("sale_id", "session_id", "user_id", F.col("date_key").alias("date"))
        .agg(
            F.sum("total_amount").alias("total_revenue"),
            F.count(F.lit(1)).alias("items_purchased"),
        )
        .withColumn("device_type", device)
        .withColumn("categories_purchased", F.array().cast("array<string>")),
        S.SESSION_SALES,
    )
