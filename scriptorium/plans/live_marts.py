"""Stored marts that grow with new loads, and views that outlive the session.

A mart is stored as counts in parts. A refresh counts only what loads brought
that no part holds yet, writes that as one more part per mart, and shows it by
its last write, a row in ``mart_commits``; a refresh that stops before shows
nothing. Readers use permanent views, which sum the parts of the newest
generation and look up names in the summed rows.

Once there are ``merge_after`` parts, they are summed into one, as a new
generation, without reading the base tables. Only after a deletion or a
replaced table are the marts counted anew. Rows that were appended without a
load are counted then and by the first refresh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scriptorium.functions.temporal import day_of, week_of
from scriptorium.operators.changes import ConflictError
from scriptorium.plans.marts import pair_counts
from scriptorium.schemas import BUCKET, LOAD
from scriptorium.session import scratch_path
from scriptorium.sinks.logs import new_attempt
from scriptorium.sinks.tables import change_marks, touched_buckets
from scriptorium.sources.catalog import committed_loads, table, table_buckets

# Per mart its keys; beside them every part has a count.
PARTS = {
    "mart_author_parts": "author_id bigint",
    "mart_pair_parts": "a bigint, b bigint",
    "mart_week_parts": "week date, category_id bigint",
    "mart_day_parts": "day date",
}
COUNTED = ("papers", "paper_authors", "paper_categories")


def create_marts(spark: SparkSession, root: str, db: str = "default") -> None:
    """The tables of the parts and of their commits, and the permanent views.
    Idempotent."""
    for name, keys in PARTS.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {db}.{name} ({keys}, n bigint, part bigint) "
            f"USING parquet PARTITIONED BY (part) LOCATION '{root.rstrip('/')}/{name}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.mart_loads ({LOAD} bigint, part bigint) "
        f"USING parquet PARTITIONED BY (part) LOCATION '{root.rstrip('/')}/mart_loads'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.mart_commits "
        "(part bigint, generation bigint, removals string) "
        f"USING parquet LOCATION '{root.rstrip('/')}/mart_commits'")
    create_views(spark, db)


def create_views(spark: SparkSession, db: str = "default") -> list[str]:
    """Staging models and marts as views of the catalog. They see every later
    load, and each only what is committed."""
    views = _staging_sql(db) | _mart_sql(db)
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {text}")
    return list(views)


def refresh(spark: SparkSession, db: str = "default", merge_after: int = 16) -> str:
    """Bring the marts up to date; returns ``none``, ``added`` or ``rebuilt``.

    A second refresh that commits meanwhile makes this one stop, as both would
    count the same loads (a check before the last write, not a lock).
    """
    commits = _table(spark, "mart_commits", db)
    n_commits, generation = commits.agg(F.count(F.lit(1)), F.max("generation")).first()
    live = commits.filter(F.col("generation") == F.lit(generation)).select("part", "removals")
    marks = {name: change_marks(spark, name, db) for name in COUNTED}
    removals = ",".join(marks[name][0] for name in COUNTED)

    # The set of loads is fixed here; one that is committed later waits.
    known = written(committed_loads(spark, db), "loads")
    counted = _table(spark, "mart_loads", db).join(live, "part", "left_semi").select(LOAD)
    fresh = written(known.join(counted, LOAD, "left_anti"), "new-loads")
    n_counted = counted.count()
    changed = generation is None or live.filter(F.col("removals") != removals).count() > 0
    # Rewritten rows have lost their load: all of these must have been counted.
    lost = any(folded > n_counted for _, folded in marks.values())
    if changed or lost:
        part, loads, deltas = new_attempt(), known, whole_counts(spark, db, known)
        outcome, generation = "rebuilt", (generation or 0) + 1
    elif fresh.isEmpty():
        outcome = "none"
    else:
        part, loads, deltas = new_attempt(), fresh, new_counts(spark, db, known, fresh)
        outcome = "added"
    if outcome != "none":
        _commit(spark, db, part, generation, removals, loads, deltas, n_commits)
    if outcome == "added":
        parts = _table(spark, "mart_commits", db).filter(F.col("generation") == generation).count()
        if parts > merge_after:
            _merge(spark, db, generation, removals, n_commits + 1)
    return outcome


def whole_counts(spark: SparkSession, db: str, known: DataFrame) -> dict[str, DataFrame]:
    """The counts of all rows of the known loads and of those without one."""
    rows = {name: _loaded(spark.table(f"{db}.{name}"), known) for name in COUNTED}
    papers, authors, codes = (rows[name] for name in COUNTED)
    return _counts(papers, authors, papers, codes, pair_counts(authors))


def new_counts(
    spark: SparkSession, db: str, known: DataFrame, fresh: DataFrame
) -> dict[str, DataFrame]:
    """What the rows of the fresh loads add to each count.

    Old rows are read only in the id ranges of papers that got new links:
    dates, and the older authors with whom new ones of a paper make pairs.
    """
    new = {
        name: spark.table(f"{db}.{name}").join(fresh, LOAD, "left_semi") for name in COUNTED
    }
    papers, authors, codes = (new[name] for name in COUNTED)
    touched = written(authors.select("paper_id").distinct(), "touched")
    # A range without stored rows prunes to nothing; -1 keeps the list from being empty.
    ranges = [-1, *touched_buckets(touched)]
    nearby = spark.table(f"{db}.paper_authors").filter(F.col(BUCKET).isin(ranges)).join(
        touched, "paper_id", "left_semi")
    mark = fresh.withColumn("new", F.lit(True))
    now = _loaded(nearby, known).join(mark, LOAD, "left").select("paper_id", "author_id", "new")
    # What a paper's new links add: the pairs in which one of the two is new.
    pairs = pair_counts(now, new="new")
    dated = _loaded(
        spark.table(f"{db}.papers").filter(
            F.col(BUCKET).isin([-1, *touched_buckets(codes.select("paper_id"))])), known)
    return _counts(papers, authors, dated, codes, pairs)


def _counts(
    papers: DataFrame, authors: DataFrame, dated: DataFrame, codes: DataFrame, pairs: DataFrame
) -> dict[str, DataFrame]:
    n = F.count(F.lit(1)).alias("n")
    weeks = dated.select(F.col("id").alias("paper_id"), week_of(F.col("published_at")).alias("week"))
    return {
        "mart_author_parts": authors.groupBy("author_id").agg(n),
        "mart_pair_parts": pairs,
        "mart_week_parts": codes.select("paper_id", "category_id").join(weeks, "paper_id")
        .groupBy("week", "category_id").agg(n),
        "mart_day_parts": papers.groupBy(day_of(F.col("ingested_at")).alias("day")).agg(n),
    }


def _commit(
    spark: SparkSession, db: str, part: int, generation: int, removals: str, loads: DataFrame,
    counts: dict[str, DataFrame], n_commits: int,
) -> None:
    """Write all counts and loads of a part, then the row that shows them."""
    for name, rows in {**counts, "mart_loads": loads}.items():
        columns = [c for c in spark.table(f"{db}.{name}").columns if c != "part"]
        rows.select(*columns, F.lit(part).alias("part")).write.insertInto(f"{db}.{name}")
    if _table(spark, "mart_commits", db).count() != n_commits:
        raise ConflictError("another refresh was committed meanwhile; run this one again")
    row = spark.range(1).select(
        F.lit(part).alias("part"), F.lit(generation).cast("bigint").alias("generation"),
        F.lit(removals).alias("removals"))
    row.write.insertInto(f"{db}.mart_commits")


def _merge(spark: SparkSession, db: str, generation: int, removals: str, n_commits: int) -> None:
    live = _table(spark, "mart_commits", db).filter(F.col("generation") == generation).select("part")

    def parts(name: str) -> DataFrame:
        return _table(spark, name, db).join(live, "part", "left_semi")

    sums = {}
    for name in PARTS:
        keys = [c for c in spark.table(f"{db}.{name}").columns if c not in ("n", "part")]
        sums[name] = parts(name).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")
    loads = parts("mart_loads").select(LOAD)
    _commit(spark, db, new_attempt(), generation + 1, removals, loads, sums, n_commits)


def _loaded(rows: DataFrame, loads: DataFrame) -> DataFrame:
    """Rows without a load or of one of the given."""
    mark = loads.withColumn("known", F.lit(True))
    return rows.join(mark, LOAD, "left").filter(F.col(LOAD).isNull() | F.col("known")).drop("known")


def _table(spark: SparkSession, name: str, db: str) -> DataFrame:
    spark.catalog.refreshTable(f"{db}.{name}")
    return spark.table(f"{db}.{name}")


def written(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _seen(db: str, name: str) -> str:
    """A base table's visible rows, as SQL."""
    return (
        f"(SELECT * FROM {db}.{name} t WHERE t.{LOAD} IS NULL OR EXISTS "
        f"(SELECT 1 FROM {db}.ingestion_runs r WHERE r.id = t.{LOAD} AND r.status = 'success'))")


def _staging_sql(db: str) -> dict[str, str]:
    return {
        "stg_papers":
            "SELECT id AS paper_id, arxiv_id, title, abstract, published_at, ingested_at "
            f"FROM {_seen(db, 'papers')}",
        "stg_authors": f"SELECT id AS author_id, name FROM {_seen(db, 'authors')}",
        "stg_paper_authors":
            f"SELECT paper_id, author_id, position FROM {_seen(db, 'paper_authors')}",
        "stg_categories":
            f"SELECT id AS category_id, code, name FROM {_seen(db, 'categories')}",
        "stg_paper_categories":
            f"SELECT paper_id, category_id, is_primary FROM {_seen(db, 'paper_categories')}",
    }


def _summed(db: str, name: str, keys: str) -> str:
    return (
        f"(SELECT {keys}, SUM(n) AS n FROM {db}.{name} WHERE part IN "
        f"(SELECT part FROM {db}.mart_commits WHERE generation = "
        f"(SELECT MAX(generation) FROM {db}.mart_commits)) GROUP BY {keys} HAVING SUM(n) <> 0)")


def _mart_sql(db: str) -> dict[str, str]:
    def daily(ts: str, name: str) -> str:
        return f"SELECT CAST({ts} AS DATE) AS day, COUNT(*) AS n FROM {db}.{name} GROUP BY 1"

    return {
        "authors_paper_counts":
            "SELECT s.name, SUM(c.n) AS n_papers "
            f"FROM {_summed(db, 'mart_author_parts', 'author_id')} c "
            f"JOIN {db}.stg_authors s ON s.author_id = c.author_id GROUP BY s.name",
        "fct_coauthor_pairs":
            "SELECT x.name AS author_1, y.name AS author_2, c.n AS n_collabs "
            f"FROM {_summed(db, 'mart_pair_parts', 'a, b')} c "
            f"JOIN {db}.stg_authors x ON x.author_id = c.a "
            f"JOIN {db}.stg_authors y ON y.author_id = c.b",
        "fct_weekly_papers_by_category":
            "SELECT c.week, s.code AS category, SUM(c.n) AS n_papers "
            f"FROM {_summed(db, 'mart_week_parts', 'week, category_id')} c "
            f"JOIN {db}.stg_categories s ON s.category_id = c.category_id GROUP BY c.week, s.code",
        # Vectors and enrichments carry no load: one column of theirs is counted at each read.
        "fct_ingestion_health":
            "SELECT day, SUM(p) AS papers_ingested, SUM(e) AS papers_embedded, "
            "SUM(r) AS papers_enriched FROM ("
            f"SELECT day, n AS p, 0 AS e, 0 AS r FROM {_summed(db, 'mart_day_parts', 'day')} "
            f"UNION ALL SELECT day, 0, n, 0 FROM ({daily('created_at', 'paper_embeddings')}) "
            f"UNION ALL SELECT day, 0, 0, n FROM ({daily('enriched_at', 'paper_enrichments')})"
            ") GROUP BY day",
    }
