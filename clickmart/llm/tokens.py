"""Token counts of documents in flat, unindexed token files.

A flat file is a plain run of little-endian token identifiers; only the
end-of-document identifier tells where a document ends.  It is held, and read, as
blocks of bytes (file, block, tokens) that are cut without regard to documents.

1. Each block is searched on its own, vectorised, for the end identifier; what comes
   out is its length and the offsets of the ends in it.
2. A prefix scan over the blocks of a file gives, for each block, how many ends and
   tokens lie before it and where the last end before it was.  The scan runs over
   runs of ``RUN`` blocks first and then over the runs, so a file with a third of all
   blocks is not scanned by one task.
3. Inside a block a document begins after the previous end; the first one begins after
   the last end before the block, which may lie many blocks back.

``write_flat`` makes such blocks from documents with a public tokenizer;
``read_flat`` cuts binary files into blocks.

Nulls and edges: a null or empty text is a document of 0 tokens; two ends in a row
enclose a document of 0 tokens; tokens after the last end of a file are reported as an
unfinished document; an empty file gives none; an identifier is never split, as blocks
hold whole tokens; repeated rows are documents of their own; a null id is carried;
further columns are ignored.
"""

import base64
from collections.abc import Iterator

import clickmart.llm
import numpy as np
import pandas as pd
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.llm.common import materialize
from clickmart.llm.warc import filesystem


# workers need not have the package on their path
cloudpickle.register_pickle_by_value(clickmart.llm)

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: how the vocabulary cuts a text before merging
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
END = 50_256
DTYPE = "<u2"
BLOCK = 1 << 18  # tokens
RUN = 1_024  # blocks
#: files up to this size are one binary value while they are cut; bytes of larger ones per task
WHOLE, TASK_BYTES = 1 << 28, 1 << 27


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _writer(ranks, end: int, dtype: str, block: int):
    """Token blocks of a partition, and which document is the n-th of its file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoding(ranks.value)
        held, size, block_no, ordinal = [], 0, 0, 0
        for batch in batches:
            file = batch["file"].iloc[0] if len(batch) else 0
            ids = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "file": batch["file"]})
            ids["ordinal"] = np.arange(ordinal, ordinal + len(ids))
            ids["block"], ids["tokens"] = pd.NA, None
            ordinal += len(ids)
            yield ids
            for text in batch["text"]:
                found = [] if text is None else coder.encode_ordinary(text)
                held.append(np.array([*found, end], dtype))
                size += len(held[-1])
                if size >= block:
                    flat = np.concatenate(held)
                    whole = len(flat) // block
                    yield _blocks(file, block_no, flat[: whole * block].reshape(whole, block))
                    held, block_no, size = [flat[whole * block :]], block_no + whole, size - whole * block
        if size:
            yield _blocks(file, block_no, [np.concatenate(held)])

    return run


def _blocks(file: int, first: int, parts) -> pd.DataFrame:
    out = pd.DataFrame({"tokens": [p.tobytes() for p in parts]})
    out["file"], out["block"] = file, np.arange(first, first + len(out))
    out["doc_id"], out["ordinal"] = pd.NA, pd.NA
    return out


def write_flat(
    docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END, dtype: str = DTYPE, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Token blocks (file, block, tokens), and (file, ordinal, doc_id); written once.

    Every partition is a file.  The vocabulary (under a megabyte) goes to each worker once.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(tokenizer))
    rows = docs.select(
        F.spark_partition_id().cast("long").alias("file"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )
    both = rows.mapInPandas(
        _writer(ranks, end, dtype, block),
        "doc_id long, file long, ordinal long, block long, tokens binary",
    )
    written = materialize(both, "token-files", "zstd")
    blocks = written.filter("block is not null").select("file", "block", "tokens")
    return blocks, written.filter("ordinal is not null").select("file", "ordinal", "doc_id")


def _cut(block: int, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for n, at in enumerate(range(0, len(content), block * width)):
                    part = content[at : at + block * width]
                    yield pd.DataFrame({"file": [path], "block": [n], "tokens": [part]})

    return run


def _range(block: int, width: int):
    """Block ``block`` of a file, read by its offset."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, n in zip(batch["path"], batch["block"], strict=True):
                fs, at = filesystem(path)
                with fs.open_input_file(at) as file:
                    part = file.read_at(block * width, int(n) * block * width)
                yield pd.DataFrame({"file": [path], "block": [int(n)], "tokens": [part]})

    return run


def read_flat(spark: SparkSession, path: str, dtype: str = DTYPE, block: int = BLOCK) -> DataFrame:
    """Blocks of the binary files in ``path``; ``file`` is the path of each.

    Files up to ``WHOLE`` bytes are read by Spark and cut.  Of larger ones, which no binary value holds, every
    block is read by its offset, by as many tasks as their bytes ask for.
    """
    width, kind = np.dtype(dtype).itemsize, "file string, block long, tokens binary"
    files = spark.read.format("binaryFile").load(path)
    whole = files.filter(F.col("length") <= WHOLE).select("path", "content").mapInPandas(_cut(block, width), kind)
    size = F.lit(block * width)
    count = F.ceil(F.col("length") / size)
    large = files.filter(F.col("length") > WHOLE).select("path", "length")
    total = large.agg(F.sum("length")).first()[0]
    if not total:
        return whole
    places = large.select("path", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return whole.unionByName(places.repartition(tasks).mapInPandas(_range(block, width), kind))


def _searcher(end: int, dtype: str, file_type: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file, block, tokens in zip(batch["file"], batch["block"], batch["tokens"], strict=True):
                found = np.frombuffer(tokens, dtype)
                rows.append((file, block, len(found), np.flatnonzero(found == end)))
            yield pd.DataFrame(rows, columns=["file", "block", "n", "ends"])

    return run


def _scan(blocks: DataFrame) -> DataFrame:
    """``blocks`` (file, block, n, ends) with ends_before, tokens_before and last_end before."""
    length = F.size("ends").cast("long")
    # places of ends are relative to the run until the run's own start is known
    own = blocks.withColumn("run", F.floor(F.col("block") / RUN)).withColumn("k", length)
    in_run = W.partitionBy("file", "run").orderBy("block")
    upto, before = in_run.rowsBetween(W.unboundedPreceding, 0), in_run.rowsBetween(W.unboundedPreceding, -1)
    placed = own.withColumns({
        "ends_before": F.coalesce(F.sum("k").over(before), F.lit(0)),
        "tokens_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "n_upto": F.sum("n").over(upto),
    })
    last = F.when(F.col("k") > 0, F.col("tokens_before") + F.element_at("ends", -1))
    placed = placed.withColumn("last", last).withColumn("last_before", F.max("last").over(before))
    runs = placed.groupBy("file", "run").agg(
        F.sum("k").alias("k"), F.sum("n").alias("n"), F.max("last").alias("last")
    )
    by_file = W.partitionBy("file").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    starts = runs.withColumns({
        "run_ends": F.coalesce(F.sum("k").over(by_file), F.lit(0)),
        "run_tokens": F.coalesce(F.sum("n").over(by_file), F.lit(0)),
    })
    starts = starts.withColumn(
        "run_last", F.max(F.col("run_tokens") + F.col("last")).over(by_file)
    ).select("file", "run", "run_ends", "run_tokens", "run_last")
    return placed.join(starts, ["file", "run"]).select(
        "file", "block", "ends", "n",
        (F.col("run_ends") + F.col("ends_before")).alias("ends_before"),
        (F.col("run_tokens") + F.col("tokens_before")).alias("tokens_before"),
        F.coalesce(F.col("run_tokens") + F.col("last_before"), F.col("run_last"), F.lit(-1)).alias("last_end"),
    )


def lengths(blocks: DataFrame, end: int = END, dtype: str = DTYPE) -> DataFrame:
    """Per document: file, ordinal (from 0), start (token), n_tokens, finished.

    ``n_tokens`` does not count the end identifier.
    """
    kind = blocks.schema["file"].dataType.simpleString()
    searched = materialize(
        blocks.select("file", "block", "tokens").mapInPandas(
            _searcher(end, dtype, kind), f"file {kind}, block long, n long, ends array<long>"
        ),
        "token-ends",
    )
    scanned = _scan(searched)
    finished = scanned.select(
        "*", F.posexplode("ends").alias("i", "at")
    ).select(
        "file", (F.col("ends_before") + F.col("i")).alias("ordinal"),
        (F.col("tokens_before") + F.col("at")).alias("end"),
        F.when(F.col("i") > 0, F.col("tokens_before") + F.get("ends", F.col("i") - 1))
        .otherwise(F.col("last_end")).alias("previous"),
    ).select(
        "file", "ordinal", (F.col("previous") + 1).alias("start"),
        (F.col("end") - F.col("previous") - 1).alias("n_tokens"), F.lit(True).alias("finished"),
    )
    totals = searched.groupBy("file").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).alias("k"))
    reach = F.when(F.size("ends") > 0, F.col("tokens_before") + F.element_at("ends", -1))
    tails = scanned.groupBy("file").agg(F.max(reach).alias("last")).join(totals, "file").select(
        "file", F.col("k").cast("long").alias("ordinal"),
        (F.coalesce("last", F.lit(-1)) + 1).alias("start"),
        (F.col("n") - F.coalesce("last", F.lit(-1)) - 1).alias("n_tokens"), F.lit(False).alias("finished"),
    )
    return finished.unionByName(tails.filter("n_tokens > 0"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, file, ordinal, start and n_tokens of every document, from its flat token file."""
    blocks, ids = write_flat(docs)
    found = lengths(blocks)
    return ids.join(found.filter("finished"), ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens"
    )
