"""Number helpers used by the table jobs."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(text: Column) -> Column:
    """The text as a double, NULL if it is none. An empty text is taken out first: casting it is correct but slow,
    as it fails with an exception on every such row."""
    return F.nullif(text, F.lit("")).try_cast("double")


def settled(c: Column, places: int) -> Column:
    """Rounds an average half-up, independently of the order in which its doubles were added.

    A double sum differs in its last bits with the number of partitions and after a task is run again. Passing
    through ten decimal places absorbs that noise, so a value half-way between two cents rounds the same way
    on every run.
    """
    return F.round(c.try_cast("decimal(38,10)"), places).cast("double")


def share_pct(part: Column, whole: Column) -> Column:
    """part / whole in percent with two decimals; NULL when whole is not positive."""
    return F.when(whole > 0, F.round(part / whole * 100, 2))
