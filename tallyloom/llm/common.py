"""Helpers that several of the operators share: scratch tables, input columns, buckets and the work per task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the rows whose crc32(doc_id as text) leaves this remainder by FOLDS are held out of every fit.
FOLDS = 5
HELD_OUT = 0


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset (tests, local mode) a temporary folder is put there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallyloom-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read back: this cuts the lineage, survives a lost
    executor, and gives later steps a table whose size is known."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, null texts as empty; further columns are left behind, so that
    clashing names cannot disturb an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is held out; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one number, which sets how many groups the work is dealt into."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def groups_for(total: int, size: int) -> int:
    """Groups of about ``size`` each; the same rule at every input size."""
    return max(1, -(-total // size))
