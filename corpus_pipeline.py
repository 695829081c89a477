"""Five stages from raw documents to a mixed training corpus.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of documents; the last adds `mix_copies`, how often the mix takes a document.

Odd rows: null and empty texts fail the quality rules. A null doc_id is no copy of anything and has none, so such rows pass
the two stages that look for earlier documents; decontamination and the mix treat them like others. Repeated rows count as
often as they stand there in the quality rules; near-duplicates keep all rows of an id that is kept. Null languages and
sources are values of their own. An empty table gives an empty table with the same columns. Extra columns come out as they
went in, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import decontamination, hyperminhash, mixing, outliers, seed_extend
from broadsheet.llm.tables import documents, keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers among their language and source."""
    return outliers.keep_good(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return hyperminhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words or more that stand in a document with a smaller id."""
    return seed_extend.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix by target weights takes."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_quality),
    ("near-duplicates", without_near_duplicates),
    ("substring dedup", without_repeated_passages),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: Covariance estimates and hash mixing have no equivalent in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
