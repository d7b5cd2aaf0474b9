"""What the operators share: reading tables, whole-text Arrow passes, white space."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the six characters that separate words.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null and for white space alone."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def map_texts(
    docs: DataFrame,
    columns: list[str],
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch]],
) -> DataFrame:
    """Run a batch function over ``columns`` of ``docs`` in Arrow batches.

    ``make`` is called once a task and returns the batch function, so that vocabularies and
    models are loaded once and not sent with each batch.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            out = step(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return docs.select(*columns).mapInArrow(work, schema)
