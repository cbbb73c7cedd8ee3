"""Session factory with the settings the library is written for, and tables that are made once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Adaptive execution re-plans joins and skewed partitions; ANSI mode surfaces bad casts and divisions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "demandscope", master: str | None = None, **settings: str) -> SparkSession:
    """The running session, or a new one with ``SETTINGS`` and what ``settings`` overrides (dots as double underscores)."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def once(df: DataFrame) -> DataFrame:
    """``df`` made now and read from there by all that follows: Parquet files in the folder of ``spark.checkpoint.dir``, which executors share. They are deleted when the driver's JVM ends.

    Files have columns that can be left out, and a row costs a fraction of what Spark's own checkpoints take, which pass each row through Java's serialization. Where that is unset, a local session gets a temporary folder; on a cluster this raises.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        known = sc.getConf().get("spark.checkpoint.dir")
        if not known and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="demandscope-"))
    path = f"{sc.getCheckpointDir()}/once-{uuid.uuid4().hex}"
    df.write.parquet(path)
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)
    return df.sparkSession.read.schema(df.schema).parquet(path)
