"""Session settings the plans rely on."""

from pyspark.sql import SparkSession

SETTINGS = {
    # all dates are UTC dates
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: coalesce small partitions, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # joins whose build side turns out small per partition hash instead of sort
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # open sessions of one key are merged before the stream shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# only at start: Python call sites are not recorded with every column expression
STARTUP = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app_name: str = "clickmart", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings above; ``extra`` holds further Spark settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STARTUP, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
