import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LLM_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def duck(small):
    connection = duckdb.connect()
    for name in LLM_TABLES:
        connection.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return connection


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators'."""

    def make(rows, extra=True):
        rows = [(i, t, "en", f"s{(i or 0) % 3}") for i, t in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        if extra:
            from pyspark.sql import functions as F

            clash = ["id", "row", "key", "score", "shard", "component", "features", "words", "n"]
            df = df.withColumns({c: F.lit(c) for c in clash})
        return df

    return make
