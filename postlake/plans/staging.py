"""A written table between two passes over the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, else one in the warehouse: all executors reach both."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write the rows once and read them back: no second parse of the captures, no lineage to lose.

    The table also has real sizes, from which Spark chooses the joins that follow. The caller owns the
    folder; ``release`` removes what this application staged.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, folder: str | None = None) -> None:
    """Remove what this application staged, once its results are written; lazy results read these tables."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{folder or shared_folder(spark)}/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
