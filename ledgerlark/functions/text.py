"""Text normalisation and token functions (E1-E3), native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(c: Column) -> Column:
    """NULL -> ''; lower-case; every run of non ``[a-z0-9]`` becomes one space;
    trimmed."""
    s = F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "[^a-z0-9]+", " ")
    return F.regexp_replace(s, "^ +| +$", "")


def token_set(norm: Column) -> Column:
    """Distinct whitespace tokens of an already normalised string."""
    return F.array_distinct(F.filter(F.split(norm, " "), lambda t: t != ""))


def overlap_count(a_norm: Column, b_norm: Column) -> Column:
    return F.size(F.array_intersect(token_set(a_norm), token_set(b_norm)))


def token_overlap_similarity(a_norm: Column, b_norm: Column) -> Column:
    """Shared tokens / max(token-set sizes, 1)."""
    denom = F.greatest(F.size(token_set(a_norm)), F.size(token_set(b_norm)), F.lit(1))
    return overlap_count(a_norm, b_norm).cast("double") / denom


def date_from_filename(name: Column) -> Column:
    """A4: first ``YYYY-MM-DD`` in the name, else first 8 digits as
    ``YYYY-MM-DD``, else NULL. No calendar validation."""
    dashed = F.regexp_extract(name, r"(\d{4})-(\d{2})-(\d{2})", 0)
    compact = F.regexp_extract(name, r"(\d{4})(\d{2})(\d{2})", 0)
    compact_fmt = F.concat_ws("-", F.substring(compact, 1, 4), F.substring(compact, 5, 2),
                              F.substring(compact, 7, 2))
    return F.coalesce(F.nullif(dashed, F.lit("")),
                      F.when(compact != "", compact_fmt))


def calendar_day(c: Column) -> Column:
    """The day that a ``yyyy-mm-dd`` text names; NULL for any other text and for
    dates that no calendar has (``12/07/2026``, ``2026-13-45``). Rows of such
    texts belong to no day; they stop nothing."""
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c.try_cast("date"))
