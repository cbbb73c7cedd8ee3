"""Helpers shared by the corpus operators: shared-folder tables, batches of bounded size, words."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run without ASCII white space (the same text in Java, RE2 and Python syntax).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: Text handled at once by a Python operator, in bytes of the Arrow buffer; a longer single row makes a slice of its own.
SLICE_BYTES = 4 << 20
BATCH_ROWS = 4096
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: str) -> str:
    """Lower-cases A-Z only; code-point positions stay the same."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def lower_ascii_col(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once: inside a lambda a plain column expression is evaluated for each element."""
    return F.transform(F.array(value), body)[0]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; on a cluster, where executors couldn't read it, this raises.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        known = sc.getConf().get("spark.checkpoint.dir")
        if not known and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="demandscope-"))
    return sc.getCheckpointDir()


_MADE: list[str] = []  # tables of the shared folder that this driver made and has not deleted


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def keep_until_exit(spark: SparkSession, path: str) -> None:
    """Has a folder of the shared place deleted when the driver's JVM ends, if ``release`` or ``released`` doesn't do so before."""
    store, p = _store(spark, path)
    store.deleteOnExit(p)
    _MADE.append(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    keep_until_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    store, p = _store(spark, path)
    store.delete(p, True)
    store.cancelDeleteOnExit(p)
    _MADE.remove(path)


def release(df: DataFrame) -> None:
    """Deletes a table of ``materialize`` that no later plan reads."""
    _delete(df.sparkSession, df._shared_path)


def finished(df: DataFrame, name: str, begun: int) -> DataFrame:
    """``materialize``, then deletes all that was made since ``begun`` (a length of ``made()``): what an operator needed on its way."""
    before = _MADE[begun:]
    out = materialize(df, name)
    for path in before:
        _delete(df.sparkSession, path)
    return out


def made() -> int:
    return len(_MADE)


def arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded size.

    The size of batches is a setting of the session that Spark reads when the plan runs, so it can't be put back here: the session's limits
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``) are lowered to ours for good where they are above, and stay where they
    are lower. Batches stand in buffers outside the heap on both sides of the pipe, once for each core; the default of 64 MB a batch is most of a
    small executor's overhead.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", SLICE_BYTES)):
        now = str(conf.get(key)).lower().rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that ``column`` has about ``most`` bytes in each: bounded memory with very long texts."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i in range(n):
            if held and held + lengths[i] > most:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += int(lengths[i])
        yield batch.slice(at)
        pa.default_memory_pool().release_unused()
