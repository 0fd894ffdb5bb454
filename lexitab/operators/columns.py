"""Helper columns beside columns of any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``data``, so that no helper column can meet one of them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("data")
