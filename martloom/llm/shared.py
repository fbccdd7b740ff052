"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; without that setting a private one,
    and only if the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="martloom-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, and a
    lost executor loses nothing of it."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def mounted(folder: str) -> str:
    """Path under which tasks open files of a shared folder; needs a mounted one."""
    at = urlparse(folder)
    if at.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {folder}")
    return unquote(at.path)


def up_to(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def blank(c: Column) -> Column:
    """Text with null as empty."""
    return F.coalesce(c, F.lit(""))
