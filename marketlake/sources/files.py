"""Directory questions answered by the Hadoop file system of a path, so that any store Spark reads works."""

import tempfile

from pyspark.sql import SparkSession

# Fixed value: codec of every table written; hashed keys, which are hexadecimal digits, take half of what they take by default.
TABLE_CODEC = "zstd"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly under a directory; none if it does not exist."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths that match a glob pattern, by one listing."""
    fs, p = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory for written intermediate tables, under the shared folder in ``spark.checkpoint.dir``.

    A session without that setting, as in tests, gets one of its own; a cluster must name a shared folder. The
    directory goes when the driver ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
        shared = tempfile.mkdtemp(prefix="marketlake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/{purpose}-{spark._jvm.java.util.UUID.randomUUID()}"
    fs, folder = _file_system(spark, path)
    fs.deleteOnExit(folder)
    return path
