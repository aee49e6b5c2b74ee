"""Many data checks in one pass: one scan per table, one shuffle of narrow keys.

A rule says which keys it reads from which tables and what is wrong about a
key, given how often it was read on each side. Every row gives the keys of all
rules on its table at once; keys are counted in the map tasks, so that a hot
one, or a rule that only counts rows, moves one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.functions.vector import text_form

ROWS, KEYS, COPIES, ORPHANS, EXCESS = "rows", "keys", "copies", "orphans", "excess"


@dataclass(frozen=True)
class Read:
    """What a rule reads from a table: a key per row that fulfils ``when``,
    ``times`` over. Without a key rows are only counted."""

    table: str
    key: Column | None = None
    when: Column | None = None
    times: Column | int = 1
    parent: bool = False


@dataclass(frozen=True)
class Rule:
    """``kind`` is what counts as a violation: all ``rows`` read; ``keys`` read
    more than once; ``copies``, rows beyond the first of each key, a null key's
    all; ``orphans``, rows whose key no parent has; the ``excess`` of rows over
    those of the parent."""

    name: str
    kind: str
    reads: tuple[Read, ...]


def _items(number: int, read: Read) -> Column:
    key = F.lit("") if read.key is None else read.key.cast("string")
    times = F.lit(read.times) if isinstance(read.times, int) else read.times
    counted = F.struct(
        F.lit(number).alias("rule"), key.alias("key"),
        F.when(F.lit(not read.parent), times).otherwise(0).cast("long").alias("n"),
        F.when(F.lit(read.parent), times).otherwise(0).cast("long").alias("parents"))
    return counted if read.when is None else F.when(read.when, counted)


def evaluate(rules: Sequence[Rule], tables: dict[str, DataFrame]) -> DataFrame:
    """``(check_name, violations)``, one row per rule."""
    spark = next(iter(tables.values())).sparkSession
    per_table: dict[str, list[Column]] = {}
    for number, rule in enumerate(rules):
        for read in rule.reads:
            per_table.setdefault(read.table, []).append(_items(number, read))
    read_ = None
    for name, items in per_table.items():
        given = tables[name].select(F.explode(F.array(*items)).alias("item"))
        keys = given.filter(F.col("item").isNotNull()).select("item.*")
        read_ = keys if read_ is None else read_.unionByName(keys)
    counted = read_.groupBy("rule", "key").agg(F.sum("n").alias("n"), F.sum("parents").alias("parents"))
    n, null_key = F.col("n"), F.col("key").isNull()
    by_kind = {
        ROWS: n,
        KEYS: ((n > 1) & ~null_key).cast("long"),
        COPIES: F.when(null_key, n).otherwise(n - 1),
        ORPHANS: F.when((F.col("parents") > 0) & ~null_key, 0).otherwise(n),
        EXCESS: F.greatest(n - F.col("parents"), F.lit(0)),
    }
    wrong = F.lit(0).cast("long")
    for kind, violations in by_kind.items():
        numbers = [i for i, rule in enumerate(rules) if rule.kind == kind]
        if numbers:
            wrong = F.when(F.col("rule").isin(numbers), violations).otherwise(wrong)
    sums = counted.groupBy("rule").agg(F.sum(wrong).alias("found"))
    names = spark.createDataFrame([(i, rule.name) for i, rule in enumerate(rules)], "rule int, check_name string")
    return names.join(sums, "rule", "left").select(
        "check_name", F.coalesce("found", F.lit(0)).cast("long").alias("violations"))


def unique(table: str, column: str, name: str) -> Rule:
    return Rule(name, KEYS, (Read(table, F.col(column)),))


def not_null(table: str, column: str, name: str) -> Rule:
    return Rule(name, ROWS, (Read(table, when=F.col(column).isNull()),))


def relationships(table: str, column: str, parent: str, key: str, name: str) -> Rule:
    child = Read(table, F.col(column), F.col(column).isNotNull())
    return Rule(name, ORPHANS, (child, Read(parent, F.col(key), parent=True)))


def standard_rules() -> list[Rule]:
    """The six checks of the daily quality run. Their names."""
    digest = F.sha2(text_form(F.col("embedding")).cast("binary"), 256)
    empty = F.col("methods").isNull() & F.col("datasets").isNull() & F.col("summary").isNull()
    return [
        Rule("duplicate_papers", COPIES, (Read("papers", F.col("id")),)),
        not_null("papers", "arxiv_id", "no_null_arxiv_ids"),
        Rule("no_orphaned_paper_authors", ORPHANS, (
            Read("paper_authors", F.col("paper_id")), Read("papers", F.col("id"), parent=True))),
        Rule("no_duplicate_embeddings", COPIES, (Read("paper_embeddings", digest),)),
        Rule("embeddings_not_exceed_papers", EXCESS, (
            Read("paper_embeddings"), Read("papers", parent=True))),
        Rule("enrichment_json_parseable", ROWS, (Read("paper_enrichments", when=empty),)),
    ]


def model_rules() -> list[Rule]:
    """The twelve declared tests of the staging views, on the tables that the
    views show. Fixed values: their names."""
    return [
        unique("papers", "id", "unique_stg_papers_paper_id"),
        not_null("papers", "id", "not_null_stg_papers_paper_id"),
        unique("papers", "arxiv_id", "unique_stg_papers_arxiv_id"),
        not_null("papers", "arxiv_id", "not_null_stg_papers_arxiv_id"),
        unique("authors", "id", "unique_stg_authors_author_id"),
        not_null("authors", "id", "not_null_stg_authors_author_id"),
        not_null("paper_authors", "paper_id", "not_null_stg_paper_authors_paper_id"),
        relationships("paper_authors", "paper_id", "papers", "id",
                      "relationships_stg_paper_authors_paper_id"),
        not_null("paper_authors", "author_id", "not_null_stg_paper_authors_author_id"),
        relationships("paper_authors", "author_id", "authors", "id",
                      "relationships_stg_paper_authors_author_id"),
        unique("categories", "id", "unique_stg_categories_category_id"),
        not_null("categories", "id", "not_null_stg_categories_category_id"),
    ]
