"""Text expressions. All are built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode-aware whitespace; the separators U+001C..U+001F count as whitespace
# too, which Java's own class leaves out.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def normalize_ws(text: Column) -> Column:
    """Every whitespace run becomes one space; none at either end."""
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def strip(text: Column) -> Column:
    """Drop whitespace at both ends, keep it inside."""
    return F.regexp_replace(text, rf"^{_SPACE_RUN}|{_SPACE_RUN}$", "")


def path_tail(path: Column) -> Column:
    """What follows the last ``/`` (the whole value when there is none)."""
    return F.substring_index(path, "/", -1)


def joined(values: Column, separator: str = ", ") -> Column:
    return F.array_join(values, separator)


def embedding_text(title: Column, authors: Column, abstract: Column) -> Column:
    return F.concat_ws("\n", title, authors, abstract)


def object_path(arxiv_id: Column, prefix: str = "arxiv_pdfs/", suffix: str = ".pdf") -> Column:
    return F.concat(F.lit(prefix), arxiv_id, F.lit(suffix))


def mentions(term: str, *texts: Column) -> Column:
    """True when any text has the term as a word or a plural, whatever its
    case: ``LLM`` is in "LLMs" and "LLM-based", not in "Hellman"."""
    edge = r"[\p{L}\p{N}_]"
    pattern = rf"(?iu)(?<!{edge})\Q{term}\E(?:s|es)?(?!{edge})"
    hit = F.lit(False)
    for text in texts:
        hit = hit | F.coalesce(text.rlike(pattern), F.lit(False))
    return hit
