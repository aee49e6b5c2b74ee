"""The same results in plain SQL over the given tables, written independently
of the Spark side. Checked by a SQL engine, never used by the library."""

from __future__ import annotations

_PAPERS = """
papers AS (
  SELECT o_orderkey AS id, 'o' || o_orderkey AS arxiv_id,
         o_orderpriority || ' #' || o_orderkey AS title,
         'order of customer ' || o_custkey AS abstract,
         o_orderdate AS published_at, 'pdf/o' || o_orderkey AS pdf_url,
         CASE WHEN o_orderstatus = 'F' THEN 'arxiv_pdfs/o' || o_orderkey || '.pdf' END
           AS pdf_object_path,
         o_orderdate AS ingested_at, o_orderstatus AS status
  FROM orders)"""

_LINKS = """
links AS (
  SELECT l_orderkey AS paper_id, l_suppkey AS author_id, min(l_linenumber) AS position
  FROM lineitem GROUP BY ALL)"""

_CODES = """
codes AS (SELECT DISTINCT p_type AS code FROM part)"""

_TYPED = """
typed AS (
  SELECT l_orderkey AS paper_id, l_linenumber, l_partkey, p_type
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""

_PAPER_CODES = (
    _TYPED
    + """,
paper_codes AS (
  SELECT DISTINCT paper_id, p_type AS code,
         p_type = first_value(p_type) OVER (
           PARTITION BY paper_id ORDER BY l_linenumber, l_partkey, p_type) AS is_primary
  FROM typed)"""
)

_ENRICHMENTS = """
enrichments AS (
  SELECT event_id AS paper_id, ts,
         CASE WHEN value >= 10 THEN event_type END AS summary,
         CASE WHEN value >= 5 THEN 'json' WHEN value >= 2.5 THEN 'broken' END AS methods,
         CASE WHEN event_type <> 'error' THEN 'json' END AS datasets,
         CASE WHEN value >= 6 THEN [event_type, 'k' || json_extract_string(props, '$.k')]
           ELSE [] END AS topic_list
  FROM events)"""

_TOPICS = (
    _ENRICHMENTS
    + """,
topics AS (SELECT paper_id, ts, unnest(topic_list) AS topic FROM enrichments)"""
)

_LINES = """
lines AS (
  SELECT l_orderkey AS paper_id, l_linenumber, l_suppkey, l_partkey, s_name, p_type
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey)"""

_NAMED = (
    _LINKS
    + """,
named AS (
  SELECT paper_id, string_agg(s_name, ', ' ORDER BY position, author_id) AS authors
  FROM links JOIN supplier ON s_suppkey = author_id GROUP BY paper_id)"""
)

_INPUTS = (
    _PAPERS
    + ","
    + _NAMED
    + """,
inputs AS (
  SELECT id AS paper_id, title || chr(10) || authors || chr(10) || abstract AS text
  FROM papers JOIN named ON paper_id = id WHERE pdf_object_path IS NOT NULL)"""
)

_COPIES = """
copies AS (
  SELECT vec_id AS paper_id, embedding FROM embeddings
  UNION ALL
  SELECT vec_id + 1000000000, embedding FROM embeddings WHERE label = 3)"""

_GROUPS = """
wanted AS (
  SELECT * FROM (VALUES
    ('cheap', 'ECONOMY'), ('cheap', 'PROMO'), ('sized', 'SMALL'), ('sized', 'MEDIUM'),
    ('plain', 'STANDARD'), ('large', 'LARGE'), ('large', 'MEDIUM')) AS v(group_name, code)),
grouped AS (
  SELECT DISTINCT group_name, arxiv_id, published_at
  FROM papers JOIN typed ON paper_id = id JOIN wanted ON code = p_type
  WHERE regexp_matches(lower(title), '(^|[^a-z0-9_])urgents?($|[^a-z0-9_])'))"""

_RAW = """
raw AS (
  SELECT doc_id, md5(text) AS arxiv_id, lang, source, text,
         CASE WHEN lang <> 'es' THEN lang || ' ' || source END AS title
  FROM documents)"""

_SQUEEZED = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"

_CHECKSUM = "round(list_sum(embedding::DOUBLE[]), 4) + 0.0"

_KNN = """
WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0),
scored AS (
  SELECT vec_id AS paper_id,
         greatest(1 - list_dot_product(embedding::DOUBLE[], v::DOUBLE[])
           / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])
                  * list_dot_product(v::DOUBLE[], v::DOUBLE[])), 0) AS distance
  FROM embeddings, q ORDER BY distance, paper_id LIMIT 100)
SELECT paper_id, o_orderpriority || ' #' || o_orderkey AS title,
       round(distance, 6) + 0.0 AS distance
FROM scored LEFT JOIN orders ON o_orderkey = paper_id"""

_DUPLICATE_IDS = """
SELECT 'duplicate_papers' AS check_name, count(*) AS violations
FROM orders WHERE o_orderstatus = 'P'"""

_NULL_KEYS = """
SELECT 'no_null_arxiv_ids' AS check_name, count(*) AS violations
FROM orders WHERE o_orderstatus = 'P'"""

_ORPHANS = """
SELECT 'no_orphaned_paper_authors' AS check_name, count(*) AS violations
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey
WHERE o_orderkey IS NULL"""

_DUPLICATE_VECTORS = """
SELECT 'no_duplicate_embeddings' AS check_name,
       (SELECT count(*) - count(DISTINCT embedding::VARCHAR) FROM embeddings)
       + (SELECT count(*) FROM embeddings WHERE label IN (3, 5)) AS violations"""

_EXCESS = """
SELECT 'embeddings_not_exceed_papers' AS check_name,
       greatest((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders), 0) AS violations"""

_EMPTY = """
SELECT 'enrichment_json_parseable' AS check_name, count(*) AS violations
FROM events WHERE value < 2.5 AND event_type = 'error'"""


def _count_as(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS check_name, ({sql})::BIGINT AS violations"


_MODEL_TESTS = [
    _count_as(
        "unique_stg_papers_paper_id", "SELECT count(*) FROM orders WHERE o_orderstatus = 'P'"
    ),
    _count_as("not_null_stg_papers_paper_id", "SELECT 0"),
    _count_as("unique_stg_papers_arxiv_id", "SELECT 0"),
    _count_as(
        "not_null_stg_papers_arxiv_id", "SELECT 2 * count(*) FROM orders WHERE o_orderstatus = 'P'"
    ),
    _count_as(
        "unique_stg_authors_author_id",
        "SELECT count(*) FROM (SELECT 1 FROM supplier GROUP BY s_suppkey HAVING count(*) > 1)",
    ),
    _count_as(
        "not_null_stg_authors_author_id", "SELECT count(*) FROM supplier WHERE s_suppkey IS NULL"
    ),
    _count_as(
        "not_null_stg_paper_authors_paper_id",
        "SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_orderkey IS NULL",
    ),
    _count_as(
        "relationships_stg_paper_authors_paper_id",
        "SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) "
        "WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O')",
    ),
    _count_as(
        "not_null_stg_paper_authors_author_id",
        "SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_suppkey IS NULL",
    ),
    _count_as(
        "relationships_stg_paper_authors_author_id",
        "SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) "
        "WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)",
    ),
    _count_as("unique_stg_categories_category_id", "SELECT 0"),
    _count_as(
        "not_null_stg_categories_category_id", "SELECT count(*) FROM part WHERE p_type IS NULL"
    ),
]


def _trending(unit: str) -> str:
    return f"""
WITH {_TOPICS},
counted AS (
  SELECT date_trunc('{unit}', ts)::DATE AS period, topic, count(*) AS n_papers
  FROM topics GROUP BY ALL)
SELECT period::VARCHAR AS period, topic, n_papers,
       rank() OVER (PARTITION BY period ORDER BY n_papers DESC) AS topic_rank
FROM counted"""


def _weekly(condition: str) -> str:
    return f"""
WITH {_PAPERS}, {_PAPER_CODES}
SELECT date_trunc('week', published_at)::DATE::VARCHAR AS week, code AS category, count(*) AS n_papers
FROM papers JOIN paper_codes ON paper_id = id WHERE {condition} GROUP BY ALL"""


# All pairs of one paper out of its sorted list of authors, without a self-join.
_PAIR_COUNTS = (
    _LINKS
    + """,
teams AS (
  SELECT list(author_id ORDER BY author_id) AS team FROM links GROUP BY paper_id),
firsts AS (SELECT team, unnest(team) AS a FROM teams),
pairs AS (SELECT a, unnest(team[list_position(team, a) + 1:]) AS b FROM firsts),
pair_counts AS (SELECT a, b, count(*) AS n_collabs FROM pairs GROUP BY ALL)"""
)

_NAMED_PAIRS = """
SELECT x.s_name AS author_1, y.s_name AS author_2, n_collabs
FROM {0} JOIN supplier x ON x.s_suppkey = a JOIN supplier y ON y.s_suppkey = b"""

ORACLE: dict[str, str] = {
    "stg_papers": f"""
WITH {_PAPERS}
SELECT id AS paper_id, arxiv_id, title, abstract, published_at, ingested_at FROM papers""",
    "stg_authors": "SELECT s_suppkey AS author_id, s_name AS name FROM supplier",
    "stg_paper_authors": f"WITH {_LINKS} SELECT paper_id, author_id, position FROM links",
    "stg_categories": f"""
WITH {_CODES}
SELECT row_number() OVER (ORDER BY code) AS category_id, code, lower(code) AS name FROM codes""",
    "stg_paper_categories": f"""
WITH {_PAPER_CODES}, {_CODES},
ids AS (SELECT code, row_number() OVER (ORDER BY code) AS category_id FROM codes)
SELECT paper_id, category_id, is_primary FROM paper_codes JOIN ids USING (code)""",
    "author_counts": f"""
WITH {_LINKS}
SELECT s_name AS name, count(*) AS n_papers
FROM links JOIN supplier ON s_suppkey = author_id GROUP BY s_name""",
    "prolific_authors": f"""
WITH {_LINKS}
SELECT s_name AS name, count(*) AS n_papers
FROM links JOIN supplier ON s_suppkey = author_id GROUP BY s_name HAVING count(*) > 590""",
    "coauthor_pairs": f"WITH {_PAIR_COUNTS} {_NAMED_PAIRS.format('pair_counts')}",
    "top_coauthors": f"""
WITH {_PAIR_COUNTS},
leaders AS (SELECT * FROM pair_counts ORDER BY n_collabs DESC, a, b LIMIT 20)
{_NAMED_PAIRS.format('leaders')}""",
    "weekly_by_category": _weekly("true"),
    "weekly_primary": _weekly("is_primary"),
    "weekly_between": _weekly(
        "published_at >= TIMESTAMP '1995-01-01' AND published_at < TIMESTAMP '1996-01-01'"),
    "ingestion_health": """
SELECT day::VARCHAR AS day,
       count(*) FILTER (WHERE kind = 'order') AS papers_ingested,
       count(*) FILTER (WHERE kind = 'line') AS papers_embedded,
       count(*) FILTER (WHERE kind = 'event') AS papers_enriched
FROM (SELECT o_orderdate::DATE AS day, 'order' AS kind FROM orders
      UNION ALL SELECT l_shipdate::DATE, 'line' FROM lineitem
      UNION ALL SELECT ts::DATE, 'event' FROM events)
GROUP BY day""",
    "json_topics": f"WITH {_TOPICS} SELECT paper_id, topic FROM topics",
    "trending_topics": _trending("day"),
    "trending_weekly": _trending("week"),
    "normalize_ws": f"SELECT doc_id, {_SQUEEZED.format('text')} AS text FROM documents",
    "path_tail": "SELECT page_id, split_part(url, '/', -1) AS tail FROM pages",
    "clean_docs": f"""
WITH {_RAW},
kept AS (
  SELECT *, row_number() OVER (PARTITION BY arxiv_id ORDER BY doc_id) AS rn
  FROM raw WHERE title IS NOT NULL)
SELECT arxiv_id, title, {_SQUEEZED.format('text')} AS abstract, source || ', ' || lang AS authors,
       lang AS primary_category, 'pdf/' || doc_id AS pdf_url
FROM kept WHERE rn = 1""",
    "dedup_first": """
SELECT md5(text) AS arxiv_id, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS primary_category
FROM documents GROUP BY text""",
    "dedup_keep_latest": """
SELECT max(doc_id) AS id, sha256(text) AS title, arg_max(source, doc_id) AS source
FROM documents GROUP BY text""",
    "dup_docs": """
WITH placed AS (
  SELECT *, count(*) OVER (PARTITION BY lang, text) AS n,
         row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS ordinal
  FROM documents)
SELECT lang, text, ((ordinal - 1) // 2)::BIGINT AS part, n,
       string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids,
       string_agg(source, ',' ORDER BY doc_id) AS sources
FROM placed WHERE n > 1 GROUP BY ALL""",
    "dup_members": """
SELECT min(doc_id) OVER same AS first_id, count(*) OVER same AS n,
       row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) AS ordinal,
       doc_id AS id, source AS other
FROM documents WINDOW same AS (PARTITION BY lang, text)
QUALIFY count(*) OVER same > 1""",
    "unnest_authors": f"""
WITH {_LINES}
SELECT 'o' || o_orderkey AS arxiv_id, s_name AS author,
       row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey)::INTEGER
         AS position
FROM lines JOIN orders ON o_orderkey = paper_id""",
    "distinct_authors": f"""
WITH {_LINES}
SELECT DISTINCT s_name AS name FROM lines JOIN orders ON o_orderkey = paper_id""",
    "distinct_categories": f"""
WITH {_LINES}
SELECT DISTINCT p_type AS code FROM lines JOIN orders ON o_orderkey = paper_id""",
    "link_authors": f"""
WITH {_LINES},
placed AS (
  SELECT paper_id, l_suppkey AS author_id,
         row_number() OVER (PARTITION BY paper_id ORDER BY l_linenumber, l_suppkey) AS place
  FROM lines JOIN orders ON o_orderkey = paper_id)
SELECT paper_id, author_id, min(place)::INTEGER AS position FROM placed GROUP BY ALL""",
    "link_categories": f"""
WITH {_PAPER_CODES}
SELECT paper_id, code AS category, is_primary
FROM paper_codes JOIN orders ON o_orderkey = paper_id""",
    "insert_absent_papers": f"""
WITH {_PAPERS}
SELECT (SELECT max(id) FROM papers WHERE status = 'F') + row_number() OVER (ORDER BY arxiv_id)
         AS id, arxiv_id, title, abstract
FROM papers WHERE status <> 'F'""",
    "insert_absent_authors": """
SELECT s_name AS name,
       (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY s_name) AS id
FROM supplier
WHERE s_acctbal < 0 AND s_suppkey IN (SELECT l_suppkey FROM lineitem)""",
    "insert_absent_categories": """
SELECT p_type AS code, row_number() OVER (ORDER BY p_type) AS id
FROM part WHERE p_type >= 'M' GROUP BY p_type""",
    "insert_absent_author_links": f"""
WITH {_LINKS}
SELECT paper_id, author_id, position FROM links
WHERE paper_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "surrogate_ids": """
SELECT c_name AS name, c_custkey, 100 + row_number() OVER (ORDER BY c_name) AS id
FROM customer""",
    "title_conflicts": """
WITH titled AS (
  SELECT *, o_orderpriority || ' of ' || o_custkey AS title FROM orders),
fresh AS (
  SELECT o_orderkey, title, row_number() OVER (PARTITION BY title ORDER BY o_orderkey) AS rn
  FROM titled WHERE o_orderstatus <> 'F')
SELECT 'o' || o_orderkey AS arxiv_id,
       CASE WHEN rn = 1 AND title NOT IN (SELECT title FROM titled WHERE o_orderstatus = 'F')
         THEN 'accepted' ELSE 'rejected' END AS outcome
FROM fresh""",
    "pending_objects": f"""
WITH {_PAPERS} SELECT arxiv_id, pdf_url FROM papers WHERE pdf_object_path IS NULL""",
    "update_object_path": f"""
WITH {_PAPERS}
SELECT arxiv_id,
       CASE WHEN status = 'F' OR id IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
         THEN 'arxiv_pdfs/' || arxiv_id || '.pdf' ELSE '' END AS path
FROM papers""",
    "upsert_embeddings": f"""
SELECT vec_id AS paper_id,
       CASE WHEN label >= 4 THEN 'model-new' ELSE 'model-' || label END AS model_used,
       CASE WHEN label >= 4
         THEN round(-list_sum(embedding::DOUBLE[]), 4) + 0.0
         ELSE {_CHECKSUM} END AS checksum
FROM embeddings""",
    "cascade_delete": f"""
WITH {_LINKS}, gone AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
SELECT 'paper_authors' AS child, paper_id, author_id AS ref
FROM links WHERE paper_id NOT IN (SELECT o_orderkey FROM gone)
UNION ALL
SELECT 'paper_embeddings', vec_id, vec_id
FROM embeddings WHERE vec_id NOT IN (SELECT o_orderkey FROM gone)""",
    "cascade_delete_any": f"""
WITH {_LINKS}, {_PAPER_CODES}, {_CODES},
gone AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P'),
nation_3 AS (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)
SELECT 'papers' AS root, 'papers' AS name, NULL::BIGINT AS paper_id, o_orderkey::VARCHAR AS ref
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'papers', 'paper_authors', paper_id, author_id::VARCHAR FROM links
WHERE paper_id NOT IN (SELECT id FROM gone)
UNION ALL
SELECT 'papers', 'paper_categories', paper_id, code FROM paper_codes
WHERE paper_id NOT IN (SELECT id FROM gone)
UNION ALL
SELECT 'papers', 'paper_enrichments', event_id, event_id::VARCHAR FROM events
WHERE event_id NOT IN (SELECT id FROM gone)
UNION ALL
SELECT 'papers', 'paper_embeddings', vec_id, vec_id::VARCHAR FROM embeddings
WHERE vec_id NOT IN (SELECT id FROM gone)
UNION ALL
SELECT 'authors', 'authors', NULL, s_suppkey::VARCHAR FROM supplier WHERE s_nationkey <> 3
UNION ALL
SELECT 'authors', 'paper_authors', paper_id, author_id::VARCHAR FROM links
WHERE author_id NOT IN (SELECT s_suppkey FROM nation_3)
UNION ALL
SELECT 'categories', 'categories', NULL, code FROM codes WHERE NOT starts_with(code, 'PROMO')
UNION ALL
SELECT 'categories', 'paper_categories', paper_id, code FROM paper_codes
WHERE NOT starts_with(code, 'PROMO')""",
    "new_today": f"""
WITH {_PAPERS} SELECT arxiv_id, title FROM papers WHERE ingested_at::DATE = DATE '1998-08-02'""",
    "run_log": """
SELECT 'run-1' AS run_id, '2024-01-01' AS run_date, 'arxiv_batch' AS category_code,
       count(*)::INTEGER AS papers_fetched,
       count(*) FILTER (WHERE o_orderstatus <> 'F')::INTEGER AS papers_new, 'success' AS status
FROM orders""",
    "group_union": f"""
WITH {_PAPERS}, {_TYPED}, {_GROUPS} SELECT group_name, arxiv_id FROM grouped""",
    "group_topk": f"""
WITH {_PAPERS}, {_TYPED}, {_GROUPS}
SELECT group_name, arxiv_id, published_at FROM grouped
QUALIFY row_number() OVER (PARTITION BY group_name ORDER BY published_at DESC, arxiv_id) <= 100""",
    "author_list": f"WITH {_NAMED} SELECT paper_id, authors FROM named",
    "embedding_inputs": f"WITH {_INPUTS} SELECT paper_id, text FROM inputs",
    "pending_embeddings": f"""
WITH {_INPUTS}
SELECT paper_id, text FROM inputs WHERE paper_id NOT IN (SELECT vec_id FROM embeddings)""",
    "embed_docs": """
SELECT doc_id AS paper_id, 'embeddinggemma' AS model_used, 768::BIGINT AS dim,
       1.0::DOUBLE AS norm
FROM documents""",
    "knn_cosine": _KNN,
    "knn_buckets": _KNN,
    "knn_many": """
WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 10 = 0),
scored AS (
  SELECT query_id, vec_id AS paper_id,
         greatest(1 - list_dot_product(embedding::DOUBLE[], v)
           / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(v, v)),
           0) AS distance
  FROM embeddings, q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, paper_id)::INTEGER AS rank
  FROM scored)
SELECT query_id, rank, paper_id, round(distance, 6) + 0.0 AS distance FROM ranked WHERE rank <= 100""",
    "dup_embeddings": f"""
WITH {_COPIES}, {_PAPERS},
titled AS (
  SELECT id, title FROM papers
  UNION ALL SELECT id + 1000000000, 'copy of ' || title FROM papers),
repeated AS (SELECT embedding, count(*) AS n FROM copies GROUP BY embedding HAVING count(*) > 1)
SELECT paper_id, title, n, {_CHECKSUM.replace('embedding', 'c.embedding')} AS checksum
FROM copies c JOIN repeated r ON r.embedding = c.embedding JOIN titled ON id = paper_id""",
    "vector_text_form": f"SELECT vec_id, {_CHECKSUM} AS checksum FROM embeddings",
    "ingest_job": """
WITH staged AS (
  SELECT DISTINCT md5(text) AS arxiv_id, substr(md5(text), 1, 3) AS title,
    CASE WHEN substr(md5(text), 5, 1) < '8' THEN '2024-01-01' ELSE '2024-01-02' END AS day,
    substr(md5(text), 7, 1) <> '0' AS dated
  FROM documents WHERE text IS NOT NULL AND substr(md5(text), 32, 1) <> 'f'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY title, dated ORDER BY day, arxiv_id) AS place FROM staged)
SELECT arxiv_id, title, day,
  CASE WHEN NOT dated THEN 'no value in published_at'
    WHEN place > 1 THEN 'title of another paper' ELSE '' END AS reason,
  2::BIGINT AS n_authors,
  (CASE WHEN substr(arxiv_id, 4, 1) = substr(arxiv_id, 6, 1) THEN 1 ELSE 2 END)::BIGINT AS n_categories,
  'c' || substr(arxiv_id, 4, 1) AS code
FROM ranked""",
    "marts_by_load": f"""
SELECT 'authors_paper_counts' AS mart, name AS key_1, '' AS key_2, n_papers AS n FROM (
  WITH {_LINKS}
  SELECT s_name AS name, count(*) AS n_papers
  FROM links JOIN supplier ON s_suppkey = author_id GROUP BY s_name)
UNION ALL
SELECT 'fct_coauthor_pairs', author_1, author_2, n_collabs
FROM (WITH {_PAIR_COUNTS} {_NAMED_PAIRS.format('pair_counts')})
UNION ALL
SELECT 'fct_weekly_papers_by_category', week, category, n_papers FROM ({_weekly("true")})
UNION ALL
SELECT 'fct_ingestion_health', o_orderdate::DATE::VARCHAR, '', count(*) FROM orders GROUP BY ALL""",
    "stream_ingest": f"""
WITH {_RAW}
SELECT DISTINCT arxiv_id, {_SQUEEZED.format('text')} AS abstract
FROM raw WHERE title IS NOT NULL""",
    "vector_dim_check": """
SELECT 'vector_dim' AS check_name, count(*) AS violations FROM embeddings WHERE label = 7""",
    "qc_duplicate_ids": _DUPLICATE_IDS,
    "qc_null_keys": _NULL_KEYS,
    "qc_orphans": _ORPHANS,
    "qc_duplicate_vectors": _DUPLICATE_VECTORS,
    "qc_embeddings_excess": _EXCESS,
    "qc_enrichment_empty": _EMPTY,
    "qc_enrichment_broken": f"""
WITH {_ENRICHMENTS}
SELECT 'enrichment_json_parseable' AS check_name, count(*) AS violations
FROM enrichments
WHERE (methods IS NULL AND datasets IS NULL AND summary IS NULL)
   OR coalesce(methods = 'broken', false)""",
    "qc_report": " UNION ALL ".join(
        [_DUPLICATE_IDS, _NULL_KEYS, _ORPHANS, _DUPLICATE_VECTORS, _EXCESS, _EMPTY]
    ),
    "dq_unique": """
SELECT 'unique_arxiv_id' AS check_name, count(*) AS violations
FROM orders WHERE o_orderstatus = 'P'""",
    "dq_not_null": """
SELECT 'not_null_arxiv_id' AS check_name, count(*) AS violations
FROM orders WHERE o_orderstatus = 'P'""",
    "dq_relationships": """
SELECT 'relationships_paper_id' AS check_name, count(*) AS violations
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
JOIN supplier ON s_suppkey = l_suppkey
WHERE s_acctbal >= 0
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
    "dq_freshness": """
SELECT round(date_diff('second', max(o_orderdate), TIMESTAMP '2001-08-02 20:00:00') / 3600.0, 4)
         ::DOUBLE AS age_hours,
       CASE WHEN max(o_orderdate) >= TIMESTAMP '2001-08-02 20:00:00' - INTERVAL 36 HOUR THEN 'pass'
            WHEN max(o_orderdate) >= TIMESTAMP '2001-08-02 20:00:00' - INTERVAL 72 HOUR THEN 'warn'
            ELSE 'error' END AS status
FROM orders""",
    "dq_model_tests": " UNION ALL ".join(_MODEL_TESTS),
    "bronze_round_trip": f"""
WITH {_RAW}
SELECT strftime(DATE '2023-12-31' + source[4:]::INTEGER, '%Y-%m-%d') AS ds, arxiv_id,
       CASE WHEN lang = 'es' THEN '(none)' ELSE lang || ' ' || chr(9) || chr(10) || ' ' || source
         || ' ' END AS title,
       text AS abstract, source || ', ' || lang AS authors, 'pdf/' || doc_id AS pdf_url
FROM raw""",
    "feed_round_trip": f"""
WITH {_PAPERS}, {_LINES}
SELECT arxiv_id, title, abstract, first(p_type ORDER BY l_linenumber, l_partkey, p_type)
         AS primary_category,
       strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
       CASE WHEN status = 'F' THEN pdf_url ELSE '(none)' END AS pdf_url,
       string_agg(s_name, ', ' ORDER BY l_linenumber, l_suppkey) AS authors,
       string_agg(p_type, ', ' ORDER BY l_linenumber, l_partkey, p_type) AS all_categories
FROM papers JOIN lines ON paper_id = id
GROUP BY arxiv_id, title, abstract, published_at, status, pdf_url""",
}

# Through stored tables, with the same rows.
ORACLE["upsert_stored"] = ORACLE["upsert_embeddings"]
ORACLE["update_stored_paths"] = ORACLE["update_object_path"]
