"""Topic groups: which papers belong to them, and the newest of each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from scriptorium.functions.text import mentions
from scriptorium.operators.skew import top_per_group

# Topic group -> category codes, the search term, the group size.
TOPIC_GROUPS: dict[str, list[str]] = {
    "nlp_and_core_ai": ["cs.CL", "cs.AI"],
    "ml_and_foundations": ["cs.LG", "stat.ML"],
    "multimodal_and_vision": ["cs.CV"],
    "safety_and_agents": ["cs.CR", "cs.RO"],
}
TOPIC_TERM = "LLM"
PER_GROUP = 100


def group_union(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]] = TOPIC_GROUPS,
    term: str = TOPIC_TERM,
    text_cols: Sequence[str] = ("title", "abstract"),
) -> DataFrame:
    """One row per paper and group it belongs to: the bag union of all groups,
    in one pass. A paper belongs to a group when it has one of the group's
    categories and mentions the term."""
    names = F.array_compact(
        F.array(
            *[
                F.when(
                    F.arrays_overlap("all_categories", F.lit(list(codes))), F.lit(name)
                )
                for name, codes in groups.items()
            ]
        )
    )
    matching = df.filter(mentions(term, *[F.col(c) for c in text_cols]))
    return matching.withColumn("group_name", F.explode(names))


def select_topics(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]] = TOPIC_GROUPS,
    term: str = TOPIC_TERM,
    per_group: int = PER_GROUP,
    id_col: str = "arxiv_id",
    text_cols: Sequence[str] = ("title", "abstract"),
) -> DataFrame:
    """The newest ``per_group`` papers of every group."""
    newest_first = [F.col("published_at").desc_nulls_last(), F.col(id_col)]
    return top_per_group(
        group_union(df, groups, term, text_cols), ["group_name"], newest_first, per_group
    )
