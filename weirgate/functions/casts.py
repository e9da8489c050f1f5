"""Typed readings of delivered text: null where the text is no value of the type.

The ``try_`` forms give the same results whether ANSI mode is on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import ColumnType


def typed(text: Column, kind: ColumnType) -> Column:
    if kind.kind == "string":
        return text
    if kind.kind == "date":
        return F.try_to_date(text, kind.fmt)
    if kind.kind == "timestamp":
        return F.try_to_timestamp(text, F.lit(kind.fmt))
    if kind.kind in ("int", "long"):  # a failed cast costs an exception; texts that are surely no number are spared it
        return F.when(text.rlike(r"\A[^A-Za-z]*[0-9][^A-Za-z]*\z"), text.try_cast(kind.spark))
    return text.try_cast(kind.spark)


def full_match(text: Column, pattern: str) -> Column:
    """Whether the whole text matches; a closing line end is part of the text."""
    return text.rlike(rf"\A(?:{pattern})\z")
