"""Small text and byte helpers used across the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.config import DRIVER_PREFIX, PREVIEW_CHARS, TEXT_CONTENT_TYPES


def preview(value: Column, chars: int = PREVIEW_CHARS) -> Column:
    """The first characters of a message, always followed by '...'."""
    return F.concat(F.substring(value, 1, chars), F.lit("..."))


def is_text_content(content_type: Column) -> Column:
    """True when payload bytes of this content type hold text."""
    found = F.lit(False)
    for part in TEXT_CONTENT_TYPES:
        found = found | content_type.contains(part)
    return found


def strip_driver_prefix(value: Column) -> Column:
    prefix = F.lit(DRIVER_PREFIX)
    return F.when(
        F.startswith(value, prefix), F.substring(value, len(DRIVER_PREFIX) + 1, 2147483647)
    ).otherwise(value)


def megabytes(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)


def writer_label(index: Column) -> Column:
    """0, 1, 2 … as writer-A, writer-B, writer-C …"""
    return F.concat(F.lit("writer-"), F.chr(index.cast("bigint") + F.lit(65)))
