"""Hashed keys: the same text always gives the same key, so reruns and backfills agree."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and digest width of all hashed keys.
SEPARATOR, DIGEST_BITS = "~", 256


def sha_key(*columns: str) -> Column:
    """SHA-256 of the columns' texts; NULL columns are left out."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.col(c).cast("string") for c in columns]), DIGEST_BITS)


def change_hash(tracked: list[str]) -> Column:
    """SHA-256 over the tracked attributes (see ``change_text``)."""
    return F.sha2(change_text([F.col(c) for c in tracked]), DIGEST_BITS)


def change_text(tracked: list[Column]) -> Column:
    """The tracked attributes as one text; NULL counts as empty text, so every attribute keeps its place."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in tracked])
