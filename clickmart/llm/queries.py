"""The text operators as queries over whole tables, each with its production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickmart.llm import (
    conversations, decontaminate, minhash, mixing, phrases, pseudonyms, quality, sharding, tokens, toxicity, urls,
    warc, whitening,
)
from clickmart.llm.common import table
from clickmart.llm.oracle import statements  # noqa: F401

#: the queries' own key; whoever pseudonymises real data passes another one
QUERY_KEY = "query key"

Query = Callable[[SparkSession, str], DataFrame]


def _over(operator: Callable[..., DataFrame], *names: str) -> Query:
    """``operator`` on whole tables."""
    return lambda spark, sf_dir: operator(*[table(spark, sf_dir, name) for name in names])


def queries() -> dict[str, Query]:
    return {
        "op1_sharding": _over(sharding.digest, "documents"),
        "op2_quality": _over(quality.digest, "documents"),
        "op3_minhash": _over(minhash.group, "documents"),
        "op4_pseudonyms": _over(lambda docs: pseudonyms.digest(docs, QUERY_KEY), "documents"),
        "op5_urls": _over(urls.digest, "pages"),
        "op6_tokens": _over(tokens.digest, "documents"),
        "op7_decontaminate": _over(decontaminate.digest, "documents", "benchmark"),
        "op8_mixing": _over(mixing.digest, "documents"),
        "op9_toxicity": _over(toxicity.score, "documents", "labels"),
        "op10_phrases": _over(phrases.digest, "documents"),
        "op11_conversations": _over(conversations.digest, "conversations"),
        "op12_whitening": _over(whitening.digest, "embeddings"),
        "op13_warc": _over(warc.digest, "pages"),
    }
