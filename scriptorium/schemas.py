"""Declared schemas, keys and defaults of every table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


_STR = T.StringType()
_LONG = T.LongType()
_INT = T.IntegerType()
_TS = T.TimestampType()
_STRINGS = T.ArrayType(T.StringType())

BRONZE = _struct(
    ("arxiv_id", _STR, True),
    ("title", _STR, True),
    ("authors", _STRINGS, True),
    ("abstract", _STR, True),
    ("primary_category", _STR, True),
    ("all_categories", _STRINGS, True),
    ("pdf_url", _STR, True),
    ("published_at", _STR, True),
    ("updated_at", _STR, True),
)

# Column order of the staging table; timestamps carry no zone there.
STAGING = _struct(
    ("arxiv_id", _STR, False),
    ("title", _STR, True),
    ("authors", _STRINGS, True),
    ("abstract", _STR, True),
    ("primary_category", _STR, True),
    ("all_categories", _STRINGS, True),
    ("pdf_url", _STR, True),
    ("published_at", T.TimestampNTZType(), True),
    ("updated_at", T.TimestampNTZType(), True),
)

FEED_ENTRY = _struct(
    ("id", _STR, True),
    ("title", _STR, True),
    ("summary", _STR, True),
    ("published", _STR, True),
    ("updated", _STR, True),
    (
        "link",
        T.ArrayType(_struct(("_href", _STR, True), ("_rel", _STR, True), ("_title", _STR, True))),
        True,
    ),
    ("author", T.ArrayType(_struct(("name", _STR, True))), True),
    ("arxiv:primary_category", _struct(("_term", _STR, True)), True),
    ("category", T.ArrayType(_struct(("_term", _STR, True))), True),
)


@dataclass(frozen=True)
class TableSpec:
    """Schema plus the rules that Parquet itself does not enforce."""

    schema: T.StructType
    unique: tuple[tuple[str, ...], ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    id_col: str | None = None  # partitioned by ranges of this id
    loaded: bool = False  # rows carry the load that wrote them
    cluster_by: str | None = None  # order of the rows in each file

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


NOW = "now"  # default marker: the run's clock value

# Tables that change are partitioned by ranges of so many paper ids. Ids grow
# with time, so a change of recent papers touches few partitions.
BUCKET = "id_bucket"
IDS_PER_BUCKET = 1_000_000
# The load a row came with. A row is visible once the run log holds that load
# as a success, which is a load's last write; without a load it is at once.
LOAD = "load_id"

TABLES: dict[str, TableSpec] = {
    "staging_papers": TableSpec(STAGING, unique=(("arxiv_id",),)),
    "papers": TableSpec(
        _struct(
            ("id", _LONG, False),
            ("arxiv_id", _STR, False),
            ("title", _STR, False),
            ("abstract", _STR, False),
            ("published_at", _TS, False),
            ("updated_at", _TS, True),
            ("pdf_url", _STR, True),
            ("pdf_object_path", _STR, True),
            ("ingested_at", _TS, False),
        ),
        unique=(("id",), ("arxiv_id",), ("title",)),
        defaults={"ingested_at": NOW},
        id_col="id",
        loaded=True,
        cluster_by="published_at",
    ),
    "authors": TableSpec(
        _struct(("id", _LONG, False), ("name", _STR, False)),
        unique=(("id",), ("name",)),
        loaded=True,
    ),
    "paper_authors": TableSpec(
        _struct(("paper_id", _LONG, False), ("author_id", _LONG, False), ("position", _INT, False)),
        unique=(("paper_id", "author_id"),),
        parents={"paper_id": ("papers", "id"), "author_id": ("authors", "id")},
        id_col="paper_id",
        loaded=True,
    ),
    "categories": TableSpec(
        _struct(("id", _LONG, False), ("code", _STR, False), ("name", _STR, True)),
        unique=(("id",), ("code",)),
        loaded=True,
    ),
    "paper_categories": TableSpec(
        _struct(
            ("paper_id", _LONG, False),
            ("category_id", _LONG, False),
            ("is_primary", T.BooleanType(), False),
        ),
        unique=(("paper_id", "category_id"),),
        parents={"paper_id": ("papers", "id"), "category_id": ("categories", "id")},
        defaults={"is_primary": False},
        id_col="paper_id",
        loaded=True,
    ),
    "paper_enrichments": TableSpec(
        _struct(
            ("id", _LONG, False),
            ("paper_id", _LONG, True),
            ("summary", _STR, True),
            ("methods", _STR, True),
            ("datasets", _STR, True),
            ("custom_topics", _STR, True),
            ("model_used", _STR, False),
            ("prompt_version", _STR, False),
            ("enriched_at", _TS, False),
        ),
        unique=(("id",), ("paper_id",)),
        parents={"paper_id": ("papers", "id")},
        defaults={"enriched_at": NOW},
        id_col="paper_id",
    ),
    "paper_embeddings": TableSpec(
        _struct(
            ("paper_id", _LONG, False),
            ("embedding", T.ArrayType(T.FloatType()), True),
            ("model_used", _STR, False),
            ("created_at", _TS, False),
        ),
        unique=(("paper_id",),),
        parents={"paper_id": ("papers", "id")},
        defaults={"created_at": NOW},
        id_col="paper_id",
    ),
    "ingestion_runs": TableSpec(
        _struct(
            ("id", _LONG, False),
            ("run_id", _STR, False),
            ("run_date", T.DateType(), False),
            ("category_code", _STR, False),
            ("papers_fetched", _INT, False),
            ("papers_new", _INT, False),
            ("status", _STR, False),
            ("error_message", _STR, True),
            ("started_at", _TS, False),
            ("finished_at", _TS, True),
        ),
        unique=(("id",),),  # a run has one row per attempt
        defaults={"papers_fetched": 0, "papers_new": 0},
    ),
    "rejected_papers": TableSpec(
        T.StructType([
            *_struct(("run_id", _STR, False), ("reason", _STR, False), ("rejected_at", _TS, False)).fields,
            *STAGING.fields,
        ]),
        defaults={"rejected_at": NOW},
        loaded=True,
    ),
    "quality_checks": TableSpec(
        _struct(("check_name", _STR, False), ("violations", _LONG, False), ("run_at", _TS, False)),
        defaults={"violations": 0, "run_at": NOW},
    ),
}


def referrers(root: str) -> list[str]:
    """``root`` and all tables that refer to it, directly or through others;
    each table comes after all of its parents among them."""
    order: list[str] = []

    def visit(name: str) -> None:
        for child, spec in TABLES.items():
            if child not in order and any(parent == name for parent, _ in spec.parents.values()):
                visit(child)
        order.append(name)

    visit(root)
    return order[::-1]


def referred_keys(name: str) -> list[str]:
    """The columns of a table that others refer to."""
    return sorted({
        key for spec in TABLES.values() for parent, key in spec.parents.values() if parent == name})


EMBEDDING_DIM = 768  # fixed value
EMBEDDING_MODEL = "embeddinggemma"  # fixed value
