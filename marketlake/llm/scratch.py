"""Written tables between the steps of an operator, in the folder that the cluster shares."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 10_000
#: For rows of megabytes: a row group for each, so that a task holds one when it writes and one when it reads, however many it
#: has. Parquet else looks at the size of a group only after a hundred rows. Such values are told apart by no dictionary and no bounds.
LARGE_ROWS = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Only where it is unset in a local session, as in tests, one is made and set; on a
    cluster executors would each write to a folder of their own, so it has to be set there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
        folder = tempfile.mkdtemp(prefix="marketlake-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "zstd", large_rows: bool = False) -> DataFrame:
    """`df` written once and read back: cuts the lineage, outlives executors, and goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(LARGE_ROWS if large_rows else {})).option("compression", codec).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def row_by_row(spark: SparkSession) -> Iterator[None]:
    """While it lasts, each batch that a Python worker gets has one row; for rows of megabytes."""
    before = spark.conf.get(BATCH_ROWS, None)
    spark.conf.set(BATCH_ROWS, "1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_ROWS)
        else:
            spark.conf.set(BATCH_ROWS, before)


def in_few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """`df`, of about `rows` narrow rows and behind a shuffle, in a task for each ROWS_PER_TASK of them instead of one for
    each shuffle partition: every task costs the driver its metrics and events, also one without rows."""
    tasks = max(2, -(-rows // ROWS_PER_TASK))
    return df.coalesce(tasks) if tasks < cores(df.sparkSession) else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def cores(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def text_key() -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64("text").alias("text_key")


def without(documents: DataFrame, dropped: DataFrame) -> DataFrame:
    """`documents` but for the rows whose doc_id and text_key are in `dropped`."""
    dropped = dropped.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")).distinct()
    same = F.col("_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_text_key") == F.xxhash64("text"))
    return documents.join(dropped, same, "left_anti")
