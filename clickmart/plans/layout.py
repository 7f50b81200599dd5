"""Folders of a lake."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """Folders of one lake, as the catalog registers them."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        # partition columns come last on reading; the schema's order is restored
        return spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)
