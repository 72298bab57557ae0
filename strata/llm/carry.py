"""Columns that go through an operator untouched, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rest(docs: DataFrame, text_col: str) -> Column:
    """All columns but the text as one struct ``rest``, so that none can clash with the operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("rest")


def unpack(out: DataFrame, docs: DataFrame, text_col: str, text: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The columns of ``docs`` from ``rest`` and the new text; ``size_col``, if there, is counted anew."""

    def column(c: str) -> Column:
        if c == text_col:
            return F.col(text).alias(c)
        if c == size_col:
            return F.length(text).cast(docs.schema[c].dataType).alias(c)
        return F.col(f"rest.`{c}`")

    return out.select(*(column(c) for c in docs.columns))
