"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where that is unset, a temporary folder, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="docfold-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/docfold/{name}-{uuid.uuid4().hex}"


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[list[Column], dict[str, str]]:
    """The columns of `df`, those named like one of `names` (upper and lower case alike) under unused names: {new: old}."""
    taken, moved, out = {c.lower() for c in df.columns} | set(names), {}, []
    for c in df.columns:
        new = c
        if c.lower() in names:
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            moved[new] = c
        out.append(F.col(f"`{c.replace('`', '``')}`").alias(new))
    return out, moved


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and still there when executors are lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a table made by `written` that nothing will read again."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/docfold/" not in path:
            raise ValueError(f"not a table made here: {path}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
