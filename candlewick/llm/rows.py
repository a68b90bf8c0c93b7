"""Whole rows beside working columns, and Python functions over rows."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def packed(docs: DataFrame, **cols: Column) -> DataFrame:
    """``row`` (all columns of ``docs`` as one struct) and the named columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("row"), *[c.alias(n) for n, c in cols.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


SLICE = 128  # rows of a slice of results


def row_function(make: Callable[[], Callable], returns: str) -> Callable[[str | Column], Column]:
    """A column function that calls ``make()`` once a task and its result on
    every row, over Arrow batches.

    Values are taken from the batch one at a time and results go back in
    slices, so a task holds a batch's texts once, not also as Python strings
    and as a frame of results.  ``returns`` is a DDL type; several arguments
    go in as one struct and arrive as a dict."""
    kind = to_arrow_type(T._parse_datatype_string(returns))

    @F.arrow_udf(returns)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                yield pa.array([one(x.as_py()) for x in batch.slice(at, SLICE)], type=kind)

    return apply
