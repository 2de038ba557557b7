"""Small helpers that several operators of this subpackage share."""
from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagwise.sources.layers import scope

#: White space that separates words, as a character class for Java, RE2 and Python patterns.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(doc_id, text, ...): only what an operator reads, so that other columns cannot clash.

    NULL text becomes the empty text.
    """
    return docs.select(column(id_col).alias("doc_id"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"),
                       *(column(c).alias(c) for c in more))


def id_type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, to carry them past an operator's own names."""
    return F.struct(*(column(c) for c in docs.columns))


def tidy(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``step``, whose result is a staged table, without the other tables that it stages: these are
    deleted once the result is written."""
    @wraps(step)
    def run(first: DataFrame, *more: DataFrame) -> DataFrame:
        with scope(first.sparkSession) as steps:
            result = step(first, *more)
            steps.keep(result)
        return result

    return run


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches cut to ``rows`` rows: bounds what Python objects one step holds."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_steps(batch: pa.RecordBatch, most: int, at: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut where texts would hold more than ``most`` characters together; a longer text is alone."""
    ends = np.cumsum(pc.utf8_length(batch.column(at)).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The maximal runs without white space, in order; empty for an empty text."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
