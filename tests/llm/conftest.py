from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text[, lang[, source]]), with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    def make(rows, **extra):
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        for name in ("name", "size", "hash", "id", "key", "score", "content", "doc", "take", "rank"):
            df = df.withColumn(name, F.lit(f"own {name}"))
        return df

    return make
