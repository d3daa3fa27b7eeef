"""The split of documents into those labels may be learned from and those held out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """True for a quarter of the documents, by CRC-32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def order_key(doc_id: str = "doc_id") -> Column:
    """A fixed random order for samples."""
    return F.md5(F.concat(F.lit("sample "), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
