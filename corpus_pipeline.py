"""A corpus pipeline of five operators; each stage works on all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import mixing, ngram_join, packing, pii, quality_rules, tokens
from linkloom.llm.common import table
from linkloom.scratch import remove, scratch_path, scratch_scope


def _written(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written once, read back; the tables it wrote for itself are deleted then.

    The copy goes to the scratch folder in use (a stage's own folder inside ``run``), so only the
    result outlives the stage's intermediate tables.
    """
    out = scratch_path(spark, label)
    with scratch_scope(spark, f"{label}-work"):
        result = build()
        result.write.parquet(out)
    return spark.read.schema(result.schema).parquet(out)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return _written(spark, "near-copies", lambda: ngram_join.keep_first(docs))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.mask(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares of the tokens.

    Documents of cells that are too small for their share are repeated.
    """
    return _written(
        spark, "mixture", lambda: mixing.mix(docs, tolerance=mixing.TOLERANCE, repeat=True).select(*docs.columns)
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' token pieces in sequences."""
    return _written(
        spark,
        "packed",
        lambda: packing.pack(
            docs, tokens.path_of("byte_bpe_50k.json"), ranks=tokens.path_of("byte_bpe_50k.tiktoken")
        ),
    )


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("PII", private_data),
    ("mixing", mixture),
    ("best-fit packing", packed),
]

# Byte-pair encoding and masking by context have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written to the shared scratch folder and read as the next one's
    docs. What a stage writes for itself is deleted when its result is written, and a result
    when the stage after the one that read it has written its own."""
    docs = table(spark, sf_dir, "documents")
    written: list[str] = []
    for name, step in STAGES[:-1]:
        label = name.replace(" ", "-")
        out = scratch_path(spark, label)
        with scratch_scope(spark, f"{label}-work"):
            result = step(spark, docs, sf_dir)
            result.write.parquet(out)
        docs = spark.read.schema(result.schema).parquet(out)
        written.append(out)
        if len(written) > 1:
            remove(spark, written.pop(0))
    return STAGES[-1][1](spark, docs, sf_dir)
