"""Identifiers that must be equal to the bit everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_id(book: Column, locator: Column, text: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *[F.coalesce(c.cast("string"), F.lit("")) for c in (book, locator, text)]), 256)


def narration_id(book: Column, marker: Column, locator: Column, text: Column) -> Column:
    return chunk_id(book, F.concat_ws("|", marker, locator), text)


def pair_id(a: Column, b: Column) -> Column:
    """The same for (a, b) and (b, a)."""
    a, b = a.cast("string"), b.cast("string")
    return F.sha2(F.concat_ws("|", F.least(a, b), F.greatest(a, b)), 256)


def proposal_source(marker: Column, locator: Column) -> Column:
    return F.concat_ws("|", marker, locator)
