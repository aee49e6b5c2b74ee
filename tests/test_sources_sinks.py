from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from scriptorium.schemas import BRONZE, TABLES
from scriptorium.session import cut_lineage, scratch_path, shared_dir
from scriptorium.sinks import tables as sink
from scriptorium.sinks.bronze import write_bronze
from scriptorium.sources.bronze import read_bronze, read_landed
from scriptorium.sources.catalog import (
    all_tables,
    describe_tables,
    list_tables,
    table,
    table_buckets,
)
from scriptorium.sources.feed import read_feed
from scriptorium.sources.objects import object_inventory
from tests.conftest import record

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://host/schemas/atom">
  <title>query results</title>
  <entry>
    <id>http://host/abs/2301.12345v1</id>
    <title>  A title
  with a break </title>
    <summary>
  Some text &amp; more.
    </summary>
    <published>2026-06-01T10:00:00Z</published>
    <updated>2026-06-02T10:00:00Z</updated>
    <link href="http://host/abs/2301.12345v1" rel="alternate" type="text/html"/>
    <link title="pdf" href="http://host/pdf/first" rel="related"/>
    <link title="pdf" href="http://host/pdf/2301.12345v1" rel="related"/>
    <author><name>Zoe Last</name></author>
    <author><name>Ada First</name></author>
    <arxiv:primary_category term="cs.CL" scheme="s"/>
    <category term="cs.CL" scheme="s"/>
    <category term="cs.AI" scheme="s"/>
  </entry>
  <entry>
    <id>http://host/abs/2301.99999v2</id>
    <title>Second</title>
    <summary>Text</summary>
    <published>2026-06-01T11:00:00Z</published>
    <updated>2026-06-01T11:00:00Z</updated>
    <link href="http://host/abs/2301.99999v2" rel="alternate"/>
    <author><name>Solo</name></author>
    <category term="stat.ML"/>
  </entry>
</feed>
"""


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    df = read_feed(spark, str(tmp_path))
    assert df.columns == BRONZE.fieldNames()
    first, second = df.orderBy("arxiv_id").collect()
    assert first["arxiv_id"] == "2301.12345v1"
    assert first["title"] == "A title\n  with a break"
    assert first["abstract"] == "Some text & more."
    assert first["authors"] == ["Zoe Last", "Ada First"]
    assert first["primary_category"] == "cs.CL"
    assert first["all_categories"] == ["cs.CL", "cs.AI"]
    assert first["pdf_url"] == "http://host/pdf/2301.12345v1"
    assert first["published_at"] == "2026-06-01T10:00:00Z"
    assert second["primary_category"] is None and second["pdf_url"] is None
    assert second["authors"] == ["Solo"]


def land(folder, ds, records):
    folder.mkdir(exist_ok=True)
    (folder / f"arxiv_papers_{ds}.json").write_text(json.dumps(records))


def test_landed_files(spark, tmp_path):
    raw = tmp_path / "raw_json"
    assert read_landed(spark, str(raw), "2026-06-01", "2026-06-01").count() == 0
    land(raw, "2026-06-01", [record("1"), record("2", primary_category=None)])
    land(raw, "2026-06-02", [])
    land(raw, "2026-06-03", [record("3"), record("1", title="again")])
    assert read_landed(spark, str(raw), "2026-06-02", "2026-06-02").count() == 0
    got = read_landed(spark, str(raw), "2026-06-02", "2026-06-30").orderBy("source_row").collect()
    assert [(r["ds"], r["arxiv_id"], r["title"]) for r in got] == [
        ("2026-06-03", "3", "A title"),
        ("2026-06-03", "1", "again"),
    ]
    assert read_landed(spark, str(raw)).count() == 4


def test_bronze_replaces_only_its_dates(spark, tmp_path, bronze):
    lake = str(tmp_path / "lake")
    assert read_bronze(spark, lake).count() == 0
    write_bronze(bronze([record("1"), record("2")]), lake, "2026-06-01")
    write_bronze(bronze([record("3", abstract=None)]), lake, "2026-06-02")
    write_bronze(bronze([record("9")]), lake, "2026-06-01")
    write_bronze(bronze([]), lake, "2026-06-02")

    def stored(*dates):
        rows = read_bronze(spark, lake, *dates).collect()
        return sorted((r["ds"], r["arxiv_id"]) for r in rows)

    assert stored() == [("2026-06-01", "9"), ("2026-06-02", "3")]
    assert stored("2026-06-02", "2026-06-02") == [("2026-06-02", "3")]
    plan = read_bronze(spark, lake, "2026-06-02")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_object_inventory(spark, tmp_path):
    folder = tmp_path / "bucket" / "arxiv_pdfs"
    assert object_inventory(spark, str(folder)).count() == 0
    folder.mkdir(parents=True)
    (folder / "2301.1v1.pdf").write_bytes(b"12345")
    (folder / "note.txt").write_text("x")
    (row,) = object_inventory(spark, str(folder)).collect()
    assert (row["arxiv_id"], row["length"]) == ("2301.1v1", 5)
    plan = object_inventory(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_tables_are_listed_without_views(spark, db):
    spark.range(1).createOrReplaceTempView("a_temp_view")
    assert list_tables(spark, db) == sorted(TABLES)
    assert describe_tables(spark, db).startswith("11 tables: authors, categories")
    assert describe_tables(spark, "default") == "no tables found"


def test_append_fills_defaults_and_publish_replaces(spark, db):
    row = spark.createDataFrame(
        [(1, "x", "t", "a", "2024-01-01 00:00:00")],
        "id long, arxiv_id string, title string, abstract string, published_at string",
    )
    sink.append(row, "papers", db, as_of="2024-02-02 00:00:00")
    (stored,) = table(spark, "papers", db).collect()
    assert str(stored["ingested_at"]) == "2024-02-02 00:00:00" and stored["pdf_url"] is None
    sink.append(row.withColumn("id", F.lit(2)), "papers", db)
    papers = table(spark, "papers", db)
    sink.publish(papers.filter("id = 2"), "papers", db, cluster_by="published_at")
    assert [r["id"] for r in table(spark, "papers", db).collect()] == [2]
    sink.append(row.withColumn("id", F.lit(3)), "papers", db)
    assert sorted(r["id"] for r in table(spark, "papers", db).collect()) == [2, 3]
    sink.truncate(spark, db)
    sink.append(row.withColumn("id", F.lit(4)), "papers", db)
    assert [r["id"] for r in table(spark, "papers", db).collect()] == [4]
    sink.truncate(spark, db)
    assert {name: df.count() for name, df in all_tables(spark, db).items()} == dict.fromkeys(
        TABLES, 0
    )


def test_only_touched_id_ranges_are_rewritten(spark, db, monkeypatch):
    monkeypatch.setattr(sink, "IDS_PER_BUCKET", 10)
    rows = [(i, i % 3, 1) for i in range(35)]
    schema = "paper_id long, author_id long, position int"
    sink.append(spark.createDataFrame(rows, schema), "paper_authors", db)

    def files():
        stored = spark.table(f"{db}.paper_authors")
        return {
            r["id_bucket"]: r["file"]
            for r in stored.select("id_bucket", F.col("_metadata.file_path").alias("file")).collect()
        }

    before = files()
    assert sorted(before) == [0, 1, 2, 3]
    gone = spark.createDataFrame([(15,), (16,), *[(i,) for i in range(30, 35)]], "id long")
    sink.change_rows(
        spark, "paper_authors", gone,
        lambda df: df.join(gone.withColumnRenamed("id", "paper_id"), "paper_id", "left_anti"), db,
    )
    after = files()
    assert sorted(after) == [0, 1, 2]
    assert (after[0], after[2]) == (before[0], before[2]) and after[1] != before[1]
    left = sorted(r["paper_id"] for r in table(spark, "paper_authors", db).collect())
    assert left == [i for i in range(30) if i not in (15, 16)]
    sink.append(spark.createDataFrame([(15, 9, 1), (31, 9, 1)], schema), "paper_authors", db)
    assert table(spark, "paper_authors", db).count() == 30
    plan = table_buckets(spark, "paper_authors", [1], db)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(id_bucket" in plan


def test_create_tables_twice_keeps_rows(spark, db, tmp_path):
    sink.append(spark.createDataFrame([(1, "n")], "id long, name string"), "authors", db)
    sink.create_tables(spark, str(tmp_path / "tables"), db)
    assert table(spark, "authors", db).count() == 1


@pytest.mark.parametrize("as_table", [True, False])
def test_materialize(spark, db, as_table):
    name = f"mart_{as_table}".lower()
    sink.materialize(spark.range(3), name, as_table, db)
    sink.materialize(spark.range(4), name, as_table, db)
    assert table(spark, name, db).count() == 4
    assert (name in list_tables(spark, db)) == as_table


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert scratch_path(spark, "x").startswith(configured)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    cut = cut_lineage(spark.range(10).repartition(2))
    assert "Scan ExistingRDD" in cut._jdf.queryExecution().executedPlan().toString()
    assert cut.count() == 10


def test_a_range_of_run_dates_reads_its_files_only(spark, tmp_path):
    import json

    from tests.conftest import record
    from scriptorium.sources.bronze import read_landed

    for day in range(1, 6):
        (tmp_path / f"arxiv_papers_2026-06-0{day}.json").write_text(json.dumps([record(f"{day}v1"), record(f"{day}v2")]))
    (tmp_path / "other.json").write_text("[]")
    two = read_landed(spark, str(tmp_path), "2026-06-02", "2026-06-03")
    assert sorted((r["ds"], r["arxiv_id"]) for r in two.collect()) == [
        ("2026-06-02", "2v1"), ("2026-06-02", "2v2"), ("2026-06-03", "3v1"), ("2026-06-03", "3v2")]
    plan = two._jdf.queryExecution().executedPlan()
    plan.execute().count()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2
    assert read_landed(spark, str(tmp_path), "2026-06-05").count() == 2
    assert read_landed(spark, str(tmp_path), end_ds="2026-06-01").count() == 2
    assert read_landed(spark, str(tmp_path), "2027-01-01").count() == 0
    assert read_landed(spark, str(tmp_path)).count() == 10
