from __future__ import annotations

import pytest

ALL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents from (doc_id, text[, lang[, source]]) rows, with columns whose names clash with the operators' own."""

    def build(rows, clashes=True):
        from pyspark.sql import functions as F

        full = [(*r, *([None] * (4 - len(r))), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, ALL)
        if clashes:
            for name in ("size", "part", "score", "row_id", "source_index", "shard", "key", "bucket", "digest", "length", "target", "rank", "words"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return build
