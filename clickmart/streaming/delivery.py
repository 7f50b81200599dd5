"""Raw delivery by time or size, every batch exactly once.

A batch is written to a folder of its number.  A stream that is restarted after a failure gives the
last batch again under the same number, so its folder is replaced and no row is delivered twice.  An interval bounds
how long rows wait, the source's bytes per trigger how much a batch holds.

Small batches are merged into one folder that names their range.  Readers ask ``folders``, which leaves out what a
finished merge covers, so neither a half-written merge nor the batches behind a finished one are seen twice.
"""

from collections.abc import Callable
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.sinks import tables
from clickmart.sources import raw
from clickmart.storage import list_names, path_exists, remove_path

_DAY = {"year": "yyyy", "month": "MM", "day": "dd"}


def _name(first: int, last: int | None = None) -> str:
    return f"batch={first:012d}" + (f"-{last:012d}" if last is not None else "")


def _range(folder: str) -> tuple[int, int]:
    first, _, last = folder.removeprefix("batch=").partition("-")
    return int(first), int(last or first)


def _write(rows: DataFrame, path: str) -> None:
    even = tables.balanced(rows, list(_DAY))
    even.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*_DAY).json(path)


def deliver(
    enriched: DataFrame, path: str, checkpoint: str, interval: str | None = C.DELIVERY_INTERVAL,
    after_write: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """JSON lines under batch and year/month/day of the processing time.

    One delivery per ``interval``; without one everything available is delivered, then the query ends.
    ``after_write`` is called with the number of each written batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumns({k: F.date_format("processed_ts", f) for k, f in _DAY.items()})
        _write(rows, f"{path}/{_name(number)}")
        if after_write is not None:
            after_write(number)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return enriched.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Finished batches and merges; a batch that a merge covers is left out."""
    names = [n for n in list_names(spark, path) if n.startswith("batch=") and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    widest = sorted(names, key=lambda n: (_range(n)[0], -_range(n)[1]))
    kept: list[str] = []
    for name in widest:
        if not kept or _range(name)[0] > _range(kept[-1])[1]:
            kept.append(name)
    return kept


def _lines(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], "value string")
    # several batches have no common folder structure; the days are in the paths
    return spark.read.option("recursiveFileLookup", True).text([f"{path}/{n}" for n in names])


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """Delivered events with ``batch``, the folder they lie in."""
    lines = _lines(spark, path, folders(spark, path))
    batch = F.regexp_extract(F.input_file_name(), r"/batch=([\d-]+)/", 1)
    return raw.decode(lines.select("value", batch.alias("batch")), "value", schema=S.ENRICHED_EVENT)


def merge(spark: SparkSession, path: str, keep_newest: int = 1) -> str | None:
    """Merge all but the newest batches, which a restart may write again, into one folder; returns its name."""
    old = folders(spark, path)[:-keep_newest]
    if len(old) < 2:
        return None
    name = _name(_range(old[0])[0], _range(old[-1])[1])
    # the lines as they are; the day of processing from their folders
    lines = _lines(spark, path, old)
    days = {k: F.regexp_extract(F.input_file_name(), rf"/{k}=(\d+)", 1) for k in _DAY}
    even = tables.balanced(lines.select("value").withColumns(days), list(_DAY))
    even.write.mode("overwrite").partitionBy(*_DAY).text(f"{path}/{name}")
    for covered in old:
        remove_path(spark, f"{path}/{covered}")
    return name


def batch_millis(query: StreamingQuery) -> list[int]:
    """Time of every recent batch with rows, from trigger to commit."""
    return [p["durationMs"]["triggerExecution"] for p in query.recentProgress if p["numInputRows"]]


def median_millis(query: StreamingQuery) -> float | None:
    times = batch_millis(query)
    return median(times) if times else None
