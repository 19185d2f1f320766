"""Results between jobs, in the folder that the cluster shares."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from pairloom.sources.workspace import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is there yet."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once and read back, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete what ``keep`` wrote for frames that nothing reads any more."""
    own = f"{shared_dir(spark)}/llm/"
    for df in frames:
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if own.split(":", 1)[-1].lstrip("/") in parent:
                path = spark._jvm.org.apache.hadoop.fs.Path(parent)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs now and not at the next collection."""
    gc.collect()
    spark._jvm.System.gc()
