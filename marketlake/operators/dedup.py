"""Latest row per business key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], order_by: list[Column], dealt_by: list[str] | None = None) -> DataFrame:
    """Keeps the first row of each key under ``order_by``, which should end in something unique.

    Written as ``row_number = 1`` so that Spark keeps only one row per key in every map task before the shuffle
    (WindowGroupLimit): a key holding a third of the input sends one row per task, not a third of the input.

    That sorts every map task's rows as they are, which spills wide ones. ``dealt_by``, some of the keys, deals the rows
    by these first and sorts them once, after the shuffle; later steps by the same columns need no shuffle of their own.
    All rows of one value of ``dealt_by`` then meet in one task.
    """
    if dealt_by:
        df = df.repartition(*dealt_by)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def newest_first(time: str, columns: list[str]) -> list[Column]:
    """Newest first; rows of equal time in the order of ``columns``, which should tell them apart.

    Every column named here is read, shuffled and sorted, whatever a later step selects: name few.
    """
    return [F.col(c).desc() for c in dict.fromkeys([time, *columns])]
