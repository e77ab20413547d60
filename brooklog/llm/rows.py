"""Rows that pass through an operator with columns of any names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and, in one struct ``_all``, every column.

    Whatever an operator adds beside these can't clash with a column of ``docs``.
    """
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all")
    return docs.select(every, "doc_id", "text")


def unpacked(rows: DataFrame, docs: DataFrame, **replaced) -> DataFrame:
    """The columns of ``docs`` again, some of them replaced."""
    return rows.select(
        *[
            replaced.get(c, F.col("_all").getField(c)).alias(c)
            for c in docs.columns
        ]
    )


def only(rows: DataFrame, condition: Column) -> DataFrame:
    """``rows`` where ``condition`` holds, tested where its columns have been worked out.

    Catalyst moves a filter below the projections it looks at, and so works out
    their expressions once for the filter and again for the rows, even inside
    lambdas, once per element. A generator stays in its place.
    """
    one = F.explode(F.when(condition, F.array(F.lit(True)))).alias("_only")
    return rows.select("*", one).drop("_only")
