import sys
from pathlib import Path

import pytest
from meterlens.llm.store import ship
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark: SparkSession) -> None:
    ship(spark)


@pytest.fixture
def docs(spark: SparkSession):
    """A table of documents from (doc_id, text) or (doc_id, text, lang) rows, over a few partitions."""

    def make(*rows, parts: int = 3):
        whole = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(whole, SCHEMA).repartition(parts)

    return make
