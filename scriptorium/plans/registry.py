"""Every operator as a named query over the given tables.

Faults that a check should find are planted here, by a rule on a column's
meaning, and again, independently, in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scriptorium.functions import text as X, vector as V
from scriptorium.operators import changes, duplicates, links, quality, search, skew, suite, topics
from scriptorium.operators.clean import clean
from scriptorium.operators.embed import HashingEmbedder, embed
from scriptorium.operators.ids import assign_ids
from scriptorium.operators.inverted import Inverted, write_inverted
from scriptorium.plans import adapters as A, embeddings as E, ingest, live_marts, marts, views
from scriptorium.plans.adapters import Warehouse
from scriptorium.session import scratch_path
from scriptorium.sinks.bronze import write_bronze
from scriptorium.sinks.logs import new_attempt, run_record
from scriptorium.sinks.tables import append, create_tables, upsert_rows
from scriptorium.sources.bronze import read_bronze
from scriptorium.sources.catalog import all_tables
from scriptorium.sources.feed import read_feed
from scriptorium.streaming.ingest_stream import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Topic groups over part types, for the group queries.
GROUPS = {
    "cheap": ["ECONOMY", "PROMO"],
    "sized": ["SMALL", "MEDIUM"],
    "plain": ["STANDARD"],
    "large": ["LARGE", "MEDIUM"],
}


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Warehouse(spark, folder))
    return build


def _listed(array: str) -> Column:
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


def _text_date(df: DataFrame, column: str) -> DataFrame:
    """Dates as text, which every SQL client shows alike."""
    return df.withColumn(column, F.col(column).cast("string"))


def _stg_authors(w: Warehouse) -> DataFrame:
    return views.stg_authors(A.authors(w))


# Staging views


@query
def stg_papers(w):
    return views.stg_papers(A.papers(w))


@query
def stg_authors(w):
    return _stg_authors(w)


@query
def stg_paper_authors(w):
    return views.stg_paper_authors(A.paper_authors(w))


@query
def stg_categories(w):
    return views.stg_categories(A.categories(w))


@query
def stg_paper_categories(w):
    keyed = A.paper_codes(w).withColumnRenamed("category_id", "code")
    ids = A.categories(w).select("code", F.col("id").alias("category_id"))
    return views.stg_paper_categories(keyed.join(ids, "code"))


# Marts


@query
def author_counts(w):
    return marts.author_counts(_stg_authors(w), A.paper_authors(w))


@query
def prolific_authors(w):
    return marts.author_counts(_stg_authors(w), A.paper_authors(w), min_papers=590)


@query
def coauthor_pairs(w):
    return marts.coauthor_pairs(A.paper_authors(w), _stg_authors(w))


@query
def top_coauthors(w):
    return marts.coauthor_pairs(A.paper_authors(w), _stg_authors(w), top=20)


@query
def weekly_by_category(w):
    mart = marts.weekly_by_category(
        views.stg_papers(A.papers(w)), A.paper_codes(w), A.coded_categories(w)
    )
    return _text_date(mart, "week")


@query
def weekly_primary(w):
    mart = marts.weekly_by_category(
        views.stg_papers(A.papers(w)), A.paper_codes(w), A.coded_categories(w), primary_only=True
    )
    return _text_date(mart, "week")


@query
def ingestion_health(w):
    shipped = w.lineitem.select(F.col("l_shipdate").alias("created_at"))
    return _text_date(marts.ingestion_health(A.papers(w), shipped, A.enrichments(w)), "day")


@query
def json_topics(w):
    return marts.json_topics(A.enrichments(w))


@query
def trending_topics(w):
    ranked = marts.trending_topics(A.event_papers(w), A.enrichments(w), "day")
    return _text_date(ranked, "period")


@query
def trending_weekly(w):
    ranked = marts.trending_topics(A.event_papers(w), A.enrichments(w), "week")
    return _text_date(ranked, "period")


# Text and cleaning


@query
def normalize_ws(w):
    return w.documents.select("doc_id", X.normalize_ws(F.col("text")).alias("text"))


@query
def path_tail(w):
    return w.pages.select("page_id", X.path_tail(F.col("url")).alias("tail"))


@query
def clean_docs(w):
    cleaned = clean(A.raw_documents(w), order=[F.col("doc_id")])
    return cleaned.select(
        "arxiv_id",
        "title",
        "abstract",
        X.joined(F.col("authors")).alias("authors"),
        "primary_category",
        "pdf_url",
    )


@query
def dedup_first(w):
    raw = A.raw_documents(w).select("arxiv_id", "doc_id", "primary_category")
    return skew.first_per_key(raw, ["arxiv_id"], [F.col("doc_id")])


@query
def dedup_keep_latest(w):
    docs = w.documents.select(
        F.col("doc_id").alias("id"), F.sha2(F.col("text").cast("binary"), 256).alias("title"),
        "source",
    )
    return changes.keep_latest(docs, "title").select("id", "title", "source")


@query
def dup_docs(w):
    """Two copies in a part at most, so that groups have several."""
    found = duplicates.duplicate_docs(w.documents, ["lang", "text"], "doc_id", "source", 2)
    return found.select(
        "lang", "text", "part", "n", _listed("ids").alias("ids"), _listed("others").alias("sources")
    )


@query
def dup_members(w):
    return duplicates.duplicate_members(w.documents, ["lang", "text"], "doc_id", "source")


# Links and inserts


@query
def unnest_authors(w):
    rows = A.staging(w).select("arxiv_id", "authors")
    return links.unnest_ordinal(rows, "authors", "author", "position")


@query
def distinct_authors(w):
    return links.unnest(A.staging(w).select("authors"), "authors", "name").distinct()


@query
def distinct_categories(w):
    rows = A.staging(w).select("all_categories")
    return links.unnest(rows, "all_categories", "code").distinct()


@query
def link_authors(w):
    return links.author_links(A.staging(w), A.papers(w), A.authors(w))


@query
def link_categories(w):
    linked = links.category_links(A.staging(w), A.papers(w), _code_dimension(w))
    return linked.select("paper_id", F.col("category_id").alias("category"), "is_primary")


def _code_dimension(w: Warehouse) -> DataFrame:
    return A.category_codes(w).select(F.col("code").alias("id"), "code")


def _stored(papers: DataFrame) -> DataFrame:
    """Papers that an earlier batch is taken to have brought."""
    return papers.filter(F.col("status") == "F")


@query
def insert_absent_papers(w):
    papers = A.papers(w)
    stored = _stored(papers)
    fresh = changes.insert_absent(stored, papers.drop("id"), ["arxiv_id"], [F.col("title")])
    start = stored.agg(F.max("id")).first()[0] or 0
    return assign_ids(fresh, "arxiv_id", start).select("id", "arxiv_id", "title", "abstract")


@query
def insert_absent_authors(w):
    """Suppliers in credit are known; the names on all papers arrive."""
    known = w.supplier.filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    arriving = w.lineitem.join(
        w.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    ).select(F.col("s_name").alias("name"))
    absent = changes.insert_absent(known, arriving, ["name"])
    return assign_ids(absent, "name", w.supplier.agg(F.max("s_suppkey")).first()[0] or 0)


@query
def insert_absent_categories(w):
    codes = A.category_codes(w)
    known = codes.filter(F.col("code") < "M")
    arriving = w.part.select(F.col("p_type").alias("code"))
    return assign_ids(changes.insert_absent(known, arriving, ["code"]), "code")


@query
def insert_absent_author_links(w):
    """Links of stored papers exist; the links of all papers arrive, the same
    pair possibly on several lines."""
    stored = _stored(A.papers(w)).select(F.col("id").alias("paper_id"))
    existing = A.paper_authors(w).join(stored, "paper_id", "left_semi")
    arriving = w.lineitem.select(
        F.col("l_orderkey").alias("paper_id"),
        F.col("l_suppkey").alias("author_id"),
        F.col("l_linenumber").alias("position"),
    )
    return changes.insert_absent_links(existing, arriving, ["paper_id", "author_id"], "position")


@query
def surrogate_ids(w):
    return assign_ids(w.customer.select(F.col("c_name").alias("name"), "c_custkey"), "name", 100)


@query
def title_conflicts(w):
    """Titles repeat when they name customer and priority only."""
    title = F.concat_ws(" of ", "o_orderpriority", F.col("o_custkey").cast("string"))
    papers = w.orders.select(
        "o_orderkey", A._arxiv_id(F.col("o_orderkey")).alias("arxiv_id"), title.alias("title"),
        F.col("o_orderstatus").alias("status"),
    )
    accepted, rejected = changes.split_conflicts(
        _stored(papers),
        papers.filter(F.col("status") != "F"),
        "title",
        "arxiv_id",
        [F.col("o_orderkey")],
    )
    return accepted.select("arxiv_id", F.lit("accepted").alias("outcome")).unionByName(
        rejected.select("arxiv_id", F.lit("rejected").alias("outcome"))
    )


# Updates and deletes


@query
def pending_objects(w):
    return ingest.pending_objects(A.papers(w))


@query
def update_object_path(w):
    """The objects of papers with a finished line have landed."""
    landed = w.lineitem.filter(F.col("l_linestatus") == "F").select(
        A._arxiv_id(F.col("l_orderkey")).alias("arxiv_id")
    )
    updated = ingest.with_object_paths(A.papers(w), landed.distinct())
    return updated.select("arxiv_id", F.coalesce("pdf_object_path", F.lit("")).alias("path"))


@query
def upsert_embeddings(w):
    """Vectors of low labels exist; negated vectors of high labels arrive."""
    vectors = A.embeddings(w)
    existing = vectors.join(w.embeddings.filter("label <= 5").select(
        F.col("vec_id").alias("paper_id")), "paper_id", "left_semi")
    arriving = (
        w.embeddings.filter("label >= 4")
        .select(
            F.col("vec_id").alias("paper_id"),
            F.transform("embedding", lambda x: -x).alias("embedding"),
            F.lit("model-new").alias("model_used"),
        )
    )
    return changes.upsert(existing, arriving, "paper_id").select(
        "paper_id", "model_used", _checksum().alias("checksum")
    )


@query
def upsert_stored(w):
    """The same arrivals, into the stored table: only id ranges in which a
    vector is replaced are rewritten."""
    db, vectors = _new_tables(w), A.embeddings(w)
    label = w.embeddings.select(F.col("vec_id").alias("paper_id"), "label")
    labelled = vectors.join(label, "paper_id")
    append(labelled.filter("label <= 5").drop("label"), "paper_embeddings", db, "2024-01-01")
    arriving = labelled.filter("label >= 4").select(
        "paper_id", F.transform("embedding", lambda x: -x).alias("embedding"),
        F.lit("model-new").alias("model_used"))
    upsert_rows(arriving, "paper_embeddings", db, "2024-01-02")
    return all_tables(w.spark, db)["paper_embeddings"].select(
        "paper_id", "model_used", _checksum().alias("checksum"))


@query
def update_stored_paths(w):
    """Object paths recorded in the stored papers, by their feed id."""
    db = _new_tables(w)
    append(A.papers(w), "papers", db)
    landed = w.lineitem.filter("l_linestatus = 'F'").select(
        A._arxiv_id(F.col("l_orderkey")).alias("arxiv_id"))
    ingest.record_objects(w.spark, landed, db)
    return all_tables(w.spark, db)["papers"].select(
        "arxiv_id", F.coalesce("pdf_object_path", F.lit("")).alias("path"))


def _checksum() -> Column:
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return F.round(total, 4) + F.lit(0.0)


@query
def cascade_delete(w):
    """Children left after papers of status P are deleted."""
    gone = A.papers(w).filter(F.col("status") == "P")
    by_author = changes.cascade(A.paper_authors(w), gone, "paper_id")
    vectors = changes.cascade(A.embeddings(w), gone, "paper_id")
    return by_author.select(
        F.lit("paper_authors").alias("child"), "paper_id", F.col("author_id").alias("ref")
    ).unionByName(
        vectors.select(
            F.lit("paper_embeddings").alias("child"), "paper_id", F.col("paper_id").alias("ref")
        )
    )


@query
def cascade_delete_any(w):
    """What is left in every table that a deletion reaches, for three roots:
    papers of status P, authors of nation 3, categories of the promo kind."""
    tables = {
        "papers": A.papers(w).select("id"),
        "authors": w.supplier.select(F.col("s_suppkey").alias("id"), "s_nationkey"),
        "categories": A.category_codes(w).select(F.col("code").alias("id")),
        "paper_authors": A.paper_authors(w),
        "paper_categories": A.paper_codes(w),
        "paper_enrichments": A.enrichments(w).select("id", "paper_id"),
        "paper_embeddings": A.embeddings(w).select("paper_id"),
    }
    gone = {
        "papers": A.papers(w).filter("status = 'P'"),
        "authors": tables["authors"].filter("s_nationkey = 3"),
        "categories": tables["categories"].filter("id like 'PROMO%'"),
    }
    refs = {"paper_authors": "author_id", "paper_categories": "category_id"}
    left = []
    for root, rows in gone.items():
        for name, kept in changes.surviving_rows(tables, root, rows.select("id")).items():
            paper = F.col("paper_id") if "paper_id" in kept.columns else F.lit(None)
            ref = refs.get(name, "id" if "id" in kept.columns else "paper_id")
            left.append(kept.select(
                F.lit(root).alias("root"), F.lit(name).alias("name"),
                paper.cast("bigint").alias("paper_id"), F.col(ref).cast("string").alias("ref")))
    return reduce(DataFrame.unionByName, left)


@query
def new_today(w):
    return ingest.new_on_day(A.papers(w), "1998-08-02").select("arxiv_id", "title")


@query
def run_log(w):
    papers = A.papers(w)
    inserted = papers.filter(F.col("status") != "F")
    record = run_record(papers, inserted, "run-1", "2024-01-01", started_at="2024-01-01 08:00:00",
                        finished_at="2024-01-01 08:05:00")
    return _text_date(record, "run_date").select(
        "run_id", "run_date", "category_code", "papers_fetched", "papers_new", "status"
    )


# Topic groups


@query
def group_union(w):
    union = topics.group_union(A.staging(w), GROUPS, "urgent", ["title"])
    return union.select("group_name", "arxiv_id")


@query
def group_topk(w):
    newest = topics.select_topics(A.staging(w), GROUPS, "urgent", 100, "arxiv_id", ["title"])
    return newest.select("group_name", "arxiv_id", "published_at")


# Embeddings and search


@query
def author_list(w):
    return E.author_list(A.paper_authors(w), A.authors(w))


@query
def embedding_inputs(w):
    return E.embedding_inputs(A.papers(w), A.paper_authors(w), A.authors(w))


@query
def pending_embeddings(w):
    due = E.pending_papers(A.papers(w), A.embeddings(w))
    return E.embedding_inputs(due, A.paper_authors(w), A.authors(w))


@query
def embed_docs(w):
    """Size, length and norm of the vector of every whole document."""
    texts = w.documents.select(F.col("doc_id").alias("paper_id"), "text")
    return embed(texts, HashingEmbedder()).select(
        "paper_id",
        "model_used",
        F.size("embedding").cast("bigint").alias("dim"),
        F.round(V.norm(F.col("embedding")), 4).alias("norm"),
    )


@query
def knn_cosine(w):
    corpus = A.embeddings(w)
    nearest = search.knn(corpus, search.vector_of(corpus, 0), 100)
    return search.with_titles(nearest, A.papers(w)).select(
        "paper_id", "title", (F.round("distance", 6) + F.lit(0.0)).alias("distance")
    )


def _inverted(w: Warehouse) -> Inverted:
    path = scratch_path(w.spark, "inverted")
    write_inverted(A.embeddings(w), path, 64)
    return Inverted(w.spark, path)


@query
def knn_buckets(w):
    """The exact search through an inverted file."""
    nearest = _inverted(w).search(search.vector_of(A.embeddings(w), 0), 100)
    return search.with_titles(nearest, A.papers(w)).select(
        "paper_id", "title", (F.round("distance", 6) + F.lit(0.0)).alias("distance")
    )


@query
def knn_approx(w):
    """At most about three quarters of the vectors are read."""
    nearest = _inverted(w).search_some(search.vector_of(A.embeddings(w), 0), 100, share=0.75)
    return search.with_titles(nearest, A.papers(w)).select(
        "paper_id", "title", F.round("distance", 6).alias("distance")
    )


@query
def knn_many(w):
    """Every tenth vector as a query against all."""
    corpus = A.embeddings(w)
    asked = corpus.filter("paper_id % 10 = 0").select("paper_id", "embedding")
    found = search.knn_many(asked, corpus, 100)
    return found.select(
        "query_id", "rank", "paper_id", (F.round("distance", 6) + F.lit(0.0)).alias("distance"))


_SHIFT = 1_000_000_000  # ids of planted copies


def _with_copies(w: Warehouse) -> DataFrame:
    """All vectors, and those of label 3 once more under shifted ids."""
    copies = w.embeddings.filter("label = 3").select(
        (F.col("vec_id") + _SHIFT).alias("paper_id"),
        "embedding",
        F.lit("model-3").alias("model_used"),
    )
    return A.embeddings(w).unionByName(copies)


@query
def dup_embeddings(w):
    papers = A.papers(w).select("id", "title")
    shifted = papers.select(
        (F.col("id") + _SHIFT).alias("id"), F.concat(F.lit("copy of "), "title").alias("title")
    )
    found = duplicates.duplicate_vectors(_with_copies(w), papers.unionByName(shifted))
    return found.select("paper_id", "title", "n", _checksum().alias("checksum"))


@query
def vector_dim_check(w):
    """Vectors of label 7 lose their last element."""
    cut = F.when(F.col("label") == 7, F.slice("embedding", 1, F.size("embedding") - 1))
    vectors = w.embeddings.select(F.coalesce(cut, "embedding").alias("embedding"))
    return quality.wrong_dim(vectors, 64)


@query
def vector_text_form(w):
    """Vectors to text and back."""
    text = V.text_form(F.col("embedding"))
    return w.embeddings.select("vec_id", V.parse(text, 64).alias("embedding")).select(
        "vec_id", _checksum().alias("checksum")
    )


# Quality


def _repeated_papers(w: Warehouse) -> DataFrame:
    papers = A.papers(w)
    return papers.unionByName(papers.filter(F.col("status") == "P"))


def _unnamed_papers(w: Warehouse) -> DataFrame:
    return A.papers(w).withColumn(
        "arxiv_id", F.when(F.col("status") != "P", F.col("arxiv_id"))
    )


def _fewer_papers(w: Warehouse) -> DataFrame:
    return A.papers(w).filter(F.col("status") != "P")


def _vectors_with_nulls(w: Warehouse) -> DataFrame:
    lost = w.embeddings.filter("label = 5").select(
        (F.col("vec_id") + 2 * _SHIFT).alias("paper_id"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.lit("model-5").alias("model_used"),
    )
    return _with_copies(w).unionByName(lost)


@query
def qc_duplicate_ids(w):
    return quality.duplicate_ids(_repeated_papers(w))


@query
def qc_null_keys(w):
    return quality.null_keys(_unnamed_papers(w))


@query
def qc_orphans(w):
    return quality.orphans(A.paper_authors(w), _fewer_papers(w))


@query
def qc_duplicate_vectors(w):
    return quality.duplicate_vectors(_vectors_with_nulls(w))


@query
def qc_embeddings_excess(w):
    return quality.embeddings_excess(w.lineitem, A.papers(w))


@query
def qc_enrichment_empty(w):
    return quality.enrichment_empty(A.enrichments(w))


@query
def qc_enrichment_broken(w):
    return quality.enrichment_empty(A.enrichments(w), parse=True)


@query
def qc_report(w):
    """The daily checks in one pass. Faults are planted in what the rules read:
    papers of status P come twice, lack their name, or are missing."""
    repeated = F.when(F.col("status") == "P", 2).otherwise(1)
    planted = {
        "duplicate_papers": (suite.Read("papers", F.col("id"), times=repeated),),
        "no_null_arxiv_ids": (suite.Read("papers", when=F.col("status") == "P"),),
        "no_orphaned_paper_authors": (
            suite.Read("paper_authors", F.col("paper_id")),
            suite.Read("papers", F.col("id"), F.col("status") != "P", parent=True)),
        "embeddings_not_exceed_papers": (suite.Read("lines"), suite.Read("papers", parent=True)),
    }
    rules = [replace(r, reads=planted.get(r.name, r.reads)) for r in suite.standard_rules()]
    return suite.evaluate(rules, {
        "papers": A.papers(w), "paper_authors": A.paper_authors(w), "lines": w.lineitem,
        "paper_embeddings": _vectors_with_nulls(w), "paper_enrichments": A.enrichments(w)})


@query
def dq_unique(w):
    return quality.unique(_repeated_papers(w), ["arxiv_id"], "unique_arxiv_id")


@query
def dq_not_null(w):
    return quality.not_null(_unnamed_papers(w), "arxiv_id", "not_null_arxiv_id")


@query
def dq_relationships(w):
    """Links to papers of status P have no parent; links whose author is in
    debt have no key and pass."""
    debtors = w.supplier.filter("s_acctbal < 0").select(F.col("s_suppkey").alias("author_id"))
    flagged = A.paper_authors(w).join(
        debtors.withColumn("debt", F.lit(True)), "author_id", "left"
    )
    faulty = flagged.withColumn("paper_id", F.when(F.col("debt").isNull(), F.col("paper_id")))
    return quality.relationships(
        faulty, _fewer_papers(w), "paper_id", "id", "relationships_paper_id"
    )


@query
def dq_freshness(w):
    return quality.freshness(A.papers(w), "ingested_at", "2001-08-02 20:00:00").select(
        F.round("age_hours", 4).alias("age_hours"), "status"
    )


@query
def dq_model_tests(w):
    """The declared tests on whole tables with planted faults: papers of
    status O are missing, those of status P come twice and without a name."""
    papers = _repeated_papers(w).filter(F.col("status") != "O")
    unnamed = papers.withColumn("arxiv_id", F.when(F.col("status") != "P", F.col("arxiv_id")))
    categories = A.coded_categories(w).withColumnRenamed("category_id", "id")
    return suite.evaluate(suite.model_rules(), {
        "papers": unnamed, "authors": A.authors(w), "paper_authors": A.paper_authors(w),
        "categories": categories})


# Sources and sinks, by a round trip through files derived from the tables


@query
def bronze_round_trip(w):
    """Raw records archived per run date (one for each source) and read back."""
    folder = scratch_path(w.spark, "bronze")
    day = F.regexp_extract(F.element_at("authors", 1), r"(\d+)$", 1).cast("int")
    raw = A.raw_documents(w).withColumn(
        "ds", F.date_add(F.lit("2023-12-31").cast("date"), day).cast("string"))
    write_bronze(raw, folder)
    back = read_bronze(w.spark, folder, "2023-12-31")
    return back.select(
        "ds", "arxiv_id", F.coalesce("title", F.lit("(none)")).alias("title"), "abstract",
        X.joined(F.col("authors")).alias("authors"), "pdf_url",
    )


@query
def feed_round_trip(w):
    """Orders written as Atom entries, then read by the feed source. Only
    papers of status F have a link titled ``pdf``."""
    folder = scratch_path(w.spark, "feed")
    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    title = F.when(F.col("status") == "F", "pdf").otherwise("other")
    entries = A.staging(w).select(
        F.concat(F.lit("http://feed/abs/"), "arxiv_id").alias("id"),
        F.concat(F.lit("\n  "), "title", F.lit(" \n")).alias("title"),
        F.col("abstract").alias("summary"),
        stamp.alias("published"),
        stamp.alias("updated"),
        F.array(
            F.struct(F.lit("page").alias("_href"), F.lit("page").alias("_title")),
            F.struct(F.col("pdf_url").alias("_href"), title.alias("_title")),
        ).alias("link"),
        F.transform("authors", lambda a: F.struct(a.alias("name"))).alias("author"),
        F.struct(F.col("primary_category").alias("_term")).alias("arxiv:primary_category"),
        F.transform("all_categories", lambda c: F.struct(c.alias("_term"))).alias("category"),
    )
    (
        entries.write.format("xml")
        .option("rootTag", "feed")
        .option("rowTag", "entry")
        .option("validateName", "false")
        .save(folder)
    )
    back = read_feed(w.spark, folder)
    return back.select(
        "arxiv_id", "title", "abstract", "primary_category", "published_at",
        F.coalesce("pdf_url", F.lit("(none)")).alias("pdf_url"),
        X.joined(F.col("authors")).alias("authors"),
        X.joined(F.col("all_categories")).alias("all_categories"),
    )


def _new_tables(w: Warehouse) -> str:
    """A database of its own with all tables, empty."""
    path = scratch_path(w.spark, "tables")
    db = path.rsplit("/", 1)[1].replace("-", "_")
    create_tables(w.spark, path, db)
    return db


@query
def ingest_job(w):
    """Two run dates from the archive through staging to the tables: every
    staged paper is stored with its links, or rejected with a reason."""
    spark, archive, db = w.spark, scratch_path(w.spark, "archive"), _new_tables(w)
    write_bronze(A.dated_documents(w), archive)
    for day in ("2024-01-01", "2024-01-02"):
        ingest.ingest(read_bronze(spark, archive, day, day), f"daily-{day}", day, db, f"{day} 12:00:00")
    t = all_tables(spark, db)
    stored = t["papers"].select(
        "id", "arxiv_id", "title", F.lit("").alias("reason"), F.to_date("ingested_at").cast("string").alias("day"))
    by_author = t["paper_authors"].groupBy(F.col("paper_id").alias("id")).agg(F.count(F.lit(1)).alias("n_authors"))
    codes = t["categories"].select(F.col("id").alias("category_id"), "code")
    by_code = t["paper_categories"].join(codes, "category_id").groupBy(F.col("paper_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n_categories"), F.max(F.when(F.col("is_primary"), F.col("code"))).alias("code"))
    stored = stored.join(by_author, "id").join(by_code, "id").drop("id")
    rejected = t["rejected_papers"].select(
        "arxiv_id", "title", "reason", F.substring("run_id", 7, 10).alias("day"),
        F.size("authors").cast("long").alias("n_authors"),
        F.size(F.array_distinct("all_categories")).cast("long").alias("n_categories"),
        F.col("primary_category").alias("code"))
    return stored.unionByName(rejected)


@query
def marts_by_load(w):
    """The stored marts after three loads, refreshed after each. Papers come by
    key in turn; links behind a paper's first line come with the last load, so
    that old papers gain authors."""
    spark, db = w.spark, _new_tables(w)
    live_marts.create_marts(spark, scratch_path(spark, "marts"), db)
    papers, codes = A.papers(w), A.categories(w)
    # Derived once, as each load takes a part of them.
    links, ids = live_marts.written(A.paper_authors(w), "links"), codes.select("code", F.col("id").alias("category_id"))
    coded = live_marts.written(
        A.paper_codes(w).withColumnRenamed("category_id", "code").join(ids, "code").drop("code"), "coded")
    for turn in range(3):
        load, first = new_attempt(), F.pmod("paper_id", F.lit(3))
        now = papers.filter(F.pmod("id", F.lit(3)) == turn)
        by_turn = F.when(F.col("position") > 1, 2).otherwise(first)
        append(now, "papers", db, load=load)
        append(links.filter(by_turn == turn), "paper_authors", db, load=load)
        append(coded.filter(F.when(F.col("is_primary"), first).otherwise(2) == turn),
               "paper_categories", db, load=load)
        if turn == 0:
            append(A.authors(w), "authors", db, load=load)
            append(codes, "categories", db, load=load)
        append(run_record(now, now, f"turn-{turn}", "2024-01-01", attempt=load), "ingestion_runs", db)
        live_marts.refresh(spark, db, merge_after=2)

    def shown(name: str, first: str, second: Column, n: str) -> DataFrame:
        return spark.table(f"{db}.{name}").select(
            F.lit(name).alias("mart"), F.col(first).cast("string").alias("key_1"),
            second.alias("key_2"), F.col(n).cast("bigint").alias("n"))

    none = F.lit("")
    return reduce(DataFrame.unionByName, [
        shown("authors_paper_counts", "name", none, "n_papers"),
        shown("fct_coauthor_pairs", "author_1", F.col("author_2"), "n_collabs"),
        shown("fct_weekly_papers_by_category", "week", F.col("category"), "n_papers"),
        shown("fct_ingestion_health", "day", none, "papers_ingested"),
    ])


@query
def weekly_between(w):
    """Weekly counts of the stored papers of one year."""
    db, codes = _new_tables(w), A.categories(w)
    ids = codes.select("code", F.col("id").alias("category_id"))
    append(A.papers(w), "papers", db)
    append(codes, "categories", db)
    append(A.paper_codes(w).withColumnRenamed("category_id", "code").join(ids, "code").drop("code"),
           "paper_categories", db)
    return _text_date(marts.weekly_between(w.spark, "1995-01-01", "1996-01-01", db), "week")


@query
def stream_ingest(w):
    """The archive of raw records as a stream into the tables: each micro-batch
    is a run, and each staged paper is stored or rejected."""
    archive, db = scratch_path(w.spark, "archive"), _new_tables(w)
    write_bronze(A.raw_documents(w), archive, "2024-01-01")
    ingest_stream(
        w.spark, archive, scratch_path(w.spark, "progress"), db=db,
        array_files=False, files_per_batch=4,
    ).awaitTermination()
    t = all_tables(w.spark, db)
    rejected = t["rejected_papers"].select("arxiv_id", "abstract")
    return t["papers"].select("arxiv_id", "abstract").unionByName(rejected).distinct()
