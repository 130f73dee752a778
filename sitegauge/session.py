"""Session and shared-folder helpers."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName("sitegauge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see, as named by ``spark.checkpoint.dir``.

    A session that names none uses a folder below the warehouse, which is shared as well. On a
    cluster a warehouse on a local disk is not, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.conf.get("spark.master").startswith("local") and re.match(r"(file:|/)", warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return f"{warehouse}/_checkpoints"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/sitegauge/{spark.conf.get('spark.app.id')}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder; nothing is created yet."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folders(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder; call it when its work is done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
