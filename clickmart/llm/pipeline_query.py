"""The corpus pipeline as a query; there only while ``corpus_pipeline`` is."""

import corpus_pipeline


def queries() -> dict:
    return {"pipeline": corpus_pipeline.run}


def statements() -> dict[str, str]:
    return {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
