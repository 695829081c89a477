"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset and Spark is
    on one machine, as in tests. On a cluster it must be set: a folder of one machine isn't shared."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own:
        os.makedirs(LOCAL_ROOT, exist_ok=True)
        _own[application] = "file://" + tempfile.mkdtemp(prefix="broadsheet-", dir=LOCAL_ROOT)
    return _own[application]


LOCAL_ROOT = "/tmp/checkpoints"
_own: dict[str, str] = {}


#: Spark's setting to drop an execution's shuffle files as it ends, instead of when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors.

    What was shuffled to make the table isn't needed again, so those files go when it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def with_fields(fields: list[T.StructField], more: str) -> T.StructType:
    """A schema of fields as they are, whatever their names, and others given as "name type, ..."."""
    kinds = {"long": T.LongType(), "string": T.StringType(), "binary": T.BinaryType(), "array<long>": T.ArrayType(T.LongType())}
    return T.StructType([*fields, *(T.StructField(n, kinds[k]) for n, k in (x.split() for x in more.split(", ")))])


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() would also touch other scripts."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
