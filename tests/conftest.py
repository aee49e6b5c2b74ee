from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession

from scriptorium.session import tune
from scriptorium.sinks.tables import create_tables


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("scriptorium-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def db(spark, tmp_path):
    """A database with all tables, empty."""
    name = f"db_{uuid.uuid4().hex[:8]}"
    create_tables(spark, str(tmp_path / "tables"), name)
    return name


BRONZE_FIELDS = (
    "arxiv_id",
    "title",
    "authors",
    "abstract",
    "primary_category",
    "all_categories",
    "pdf_url",
    "published_at",
    "updated_at",
)


def record(arxiv_id, title="A title", **changes):
    """One raw record as a dict; keyword arguments override fields."""
    base = {
        "arxiv_id": arxiv_id,
        "title": title,
        "authors": ["Ada", "Ben"],
        "abstract": f"About {arxiv_id}",
        "primary_category": "cs.LG",
        "all_categories": ["cs.LG", "cs.CL"],
        "pdf_url": f"http://host/pdf/{arxiv_id}",
        "published_at": "2026-06-01T10:00:00Z",
        "updated_at": "2026-06-02T10:00:00Z",
    }
    return {**base, **changes}


@pytest.fixture
def bronze(spark):
    """Raw records (dicts) as a frame with their order of arrival."""
    from pyspark.sql import types as T

    from scriptorium.schemas import BRONZE
    from scriptorium.sources.bronze import ORIGIN

    def build(records, ds="2026-06-02"):
        schema = T.StructType(BRONZE.fields + ORIGIN.fields)
        rows = [
            tuple(r[f] for f in BRONZE_FIELDS) + (ds, "file", i) for i, r in enumerate(records)
        ]
        return spark.createDataFrame(rows, schema)

    return build
