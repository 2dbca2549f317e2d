"""A training corpus from ``documents``: quality, toxicity, near duplicates, source mix, tokens.

Each stage works on all rows that the one before it kept; its result is written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siftline.llm import byte_bpe, importance_resampling, near_copies, source_mixing, toxicity
from siftline.llm.queries import RANKS
from siftline.llm.shared_storage import written
from siftline.sources.tables import read_parquet


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that importance resampling selects, with all their columns; the others go.

    Rows of the same id and text stay or go together. Null texts count as empty. Without labels of both classes all
    rows stay.
    """
    return importance_resampling.keep_selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the model, trained on the labelled ones among ``docs``, doesn't predict toxic, with all their columns.

    Null, empty and wordless texts score 0 and stay; repeated rows have one score and stay or go together.
    """
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8 or more): the smallest id, nulls last.

    Null, empty and wordless texts are one group; of rows of the same id and text one stays.
    """
    return near_copies.one_per_group(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows as often as the mix takes them: none to three times each, with all their columns.

    A null source is a source of its own; texts without words have no size and so no part in the mix.
    """
    return source_mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per row: its columns but the text, with counts and hashes of its tokens, decoded bytes and offsets.

    Null texts are empty and have no tokens; columns that bear a result's name give way to it.
    """
    return byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", clean),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", tokens),
]

#: SQL can express neither the models, XXH64 nor the tokenizer: tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
