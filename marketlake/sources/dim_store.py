"""The product dimension on disk: ``<path>/generation=G/run_day=D/is_current=...``, one directory per run.

A run adds the versions it closed (``is_current=false``) and the versions current after it (``true``). The
dimension is every closed version of the newest generation plus its newest run's current ones, so a daily run
never rewrites closed history. A rerun or rebuild of past days writes the whole dimension once, as the first run
of a new generation, and leaves the one it reads from untouched.

A late day changes versions in the middle of history. They go to ``<path>/generation=G/patch=D.N`` (the N-th patch after
run D), each with ``removed`` true or false; readers leave out the stored rows that a later patch removes. So closed
history that a late day does not touch is never rewritten; the next rebuild takes the patches in.

Spark leaves ``_SUCCESS`` in a run's directory when its single write job commits. Until then readers see the
state before it, so a run that dies halfway is invisible and is simply run again.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.sources.files import TABLE_CODEC, child_names, delete, matching

GENERATION, RUN, PATCH = "generation", "run_day", "patch"


def newest_day(spark: SparkSession, path: str) -> str | None:
    """The day of the newest finished run."""
    _, days = _newest_generation(spark, path)
    return days[-1] if days else None


def read_dim(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The dimension after the newest finished run; empty before the first.

    ``since`` leaves out runs that closed only versions no longer valid on that day, without listing them: a run
    closes versions up to the day before its own.
    """
    generation, days = _newest_generation(spark, path)
    if not days:
        return spark.createDataFrame([], schemas.DIM_PRODUCT)
    if since is not None:
        days = [d for d in days[:-1] if d > since] + days[-1:]
    base = f"{path}/{GENERATION}={generation}"
    stored = (
        spark.read.schema(f"{schemas.DIM_PRODUCT}, {RUN} date")
        .option("basePath", base)
        .parquet(*[f"{base}/{RUN}={d}" for d in days])
    )
    newest = F.col(RUN) == F.lit(days[-1]).cast("date")
    alive = stored.filter(~F.col("is_current") | newest).withColumn("patch", F.lit(-1))
    patches = _finished(spark, base, PATCH)
    if patches:
        alive = _patched(alive, [(base, p) for p in patches], newest)
    return alive.select(*schemas.column_names(schemas.DIM_PRODUCT))


def _patched(alive: DataFrame, patches: list[tuple[str, str]], newest: Column) -> DataFrame:
    """Stored rows and those of the patches, without the ones that a later patch removed.

    A patch comes after the run it is named after and before the next one, which writes all current versions anew.
    """
    spark, rows = alive.sparkSession, None
    for number, (base, name) in enumerate(patches):
        own = spark.read.schema(f"{schemas.DIM_PRODUCT}, removed boolean").parquet(f"{base}/{PATCH}={name}")
        own = own.withColumns({RUN: F.lit(name.partition(".")[0]).cast("date"), "patch": F.lit(number)})
        rows = own if rows is None else rows.unionByName(own)
    removed = rows.filter("removed").groupBy("product_sk").agg(F.max("patch").alias("_patch"), F.max(RUN).alias("_run"))
    added = rows.filter(~F.col("removed") & (~F.col("is_current") | newest)).drop("removed")
    both = alive.unionByName(added).join(removed, "product_sk", "left")
    later = F.when(F.col("patch") < 0, F.col("_run") >= F.col(RUN)).otherwise(F.col("_patch") > F.col("patch"))
    return both.filter(~F.coalesce(later, F.lit(False)))


def write_run(spark: SparkSession, versions: DataFrame, path: str, day: str, rebuild: bool = False) -> None:
    """Adds a run to the newest generation, or starts a new one with a rebuilt dimension."""
    generation, days = _newest_generation(spark, path)
    if rebuild and days:
        generation += 1
    (
        versions.select(*schemas.column_names(schemas.DIM_PRODUCT))
        .write.mode("overwrite")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .option("partitionOverwriteMode", "static")
        .partitionBy("is_current")
        .parquet(f"{path}/{GENERATION}={generation}/{RUN}={day}", compression=TABLE_CODEC)
    )


def write_patch(spark: SparkSession, changes: DataFrame, path: str) -> None:
    """Adds versions removed and versions put in their place (``splice_changes``) to the newest generation."""
    generation, days = _newest_generation(spark, path)
    base = f"{path}/{GENERATION}={generation}"
    number = len(child_names(spark, base)) + 1  # never used before, as nothing but whole generations is removed
    (
        changes.select(*schemas.column_names(schemas.DIM_PRODUCT), "removed")
        .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .parquet(f"{base}/{PATCH}={days[-1]}.{number:06d}", compression=TABLE_CODEC)
    )


def drop_old_runs(spark: SparkSession, path: str, kept: int = 1) -> None:
    """Frees what no reader of the newest ``kept`` runs needs: older generations, and older runs' current versions."""
    newest, days = _newest_generation(spark, path)
    for generation in _numbers(spark, path):
        if generation <= newest - kept:
            delete(spark, f"{path}/{GENERATION}={generation}")
    for day in days[:-kept]:
        delete(spark, f"{path}/{GENERATION}={newest}/{RUN}={day}/is_current=true")


def _newest_generation(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number and finished run days of the newest generation that has a finished run."""
    for generation in reversed(_numbers(spark, path)):
        base = f"{path}/{GENERATION}={generation}"
        finished = _finished(spark, base, RUN)
        if finished:
            return generation, finished
    return 0, []


def _finished(spark: SparkSession, base: str, kind: str) -> list[str]:
    """Names of the finished runs or patches of a generation, in order."""
    return [f.split("/")[-2].removeprefix(f"{kind}=") for f in matching(spark, f"{base}/{kind}=*/_SUCCESS")]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    prefix = f"{GENERATION}="
    return sorted(int(n.removeprefix(prefix)) for n in child_names(spark, path) if n.startswith(prefix))
