from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.plans.marts import weekly_between
from scriptorium.schemas import IDS_PER_BUCKET
from scriptorium.sinks.tables import append


def test_a_month_reads_its_rows_and_ranges(spark, db):
    papers = spark.range(1, 401).selectExpr(
        "id", "concat('p', id) AS arxiv_id", "concat('t', id) AS title",
        "timestamp'2026-01-01' + make_interval(0, 0, 0, (id * 37 % 90)) AS published_at")
    late = papers.selectExpr(
        f"id + {IDS_PER_BUCKET} AS id", "concat('q', id) AS arxiv_id", "concat('u', id) AS title",
        "published_at + make_interval(1) AS published_at")
    both = papers.unionByName(late)
    append(both, "papers", db)
    append(both.selectExpr("id AS paper_id", "1 AS category_id"), "paper_categories", db)
    append(spark.createDataFrame([(1, "cs.LG")], "id int, code string"), "categories", db)

    # Each file is in the order of the dates.
    places = spark.table(f"{db}.papers").select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"), "published_at")
    per_file = places.groupBy("f").agg(
        F.array_sort(F.collect_list(F.struct("i", "published_at"))).alias("r"))
    for row in per_file.collect():
        dates = [r["published_at"] for r in row["r"]]
        assert dates == sorted(dates)

    month = weekly_between(spark, "2026-02-01", "2026-03-01", db)
    wanted = both.filter("published_at >= '2026-02-01' AND published_at < '2026-03-01'")
    assert month.agg(F.sum("n_papers")).first()[0] == wanted.count() > 0
    plan = month._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(published_at,2026-02-01" in plan  # reaches the scan of the papers
    links = [line for line in plan.splitlines() if "FileScan" in line and "paper_id" in line]
    assert links and all("(id_bucket#" in x and " = 0)" in x for x in links)  # one of two ranges
    assert weekly_between(spark, "2030-01-01", "2030-02-01", db).count() == 0
