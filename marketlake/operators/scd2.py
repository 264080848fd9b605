"""Product history as a type-2 dimension: one row per version, with its first and last valid day.

Three ways give the same table: ``scd2_step`` adds one day to an existing dimension, ``scd2_history`` builds all
days in one pass, and ``scd2_splice`` puts a day that comes late, or comes again, into the middle of a history. All
expect at most one row per key and day, which the silver tables guarantee; a key's group is therefore never larger
than the number of days, whatever the skew of the raw feed.

A row with a NULL in its key matches nothing: it always starts a version of its own and is never closed.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.functions.keys import change_hash, change_text

VALIDITY = ("effective_date", "expiry_date", "is_current")


def day_literal(day: str | date) -> Column:
    return F.lit(str(day)).cast("date")


def as_new_versions(snapshots: DataFrame, tracked: list[str], day: Column) -> DataFrame:
    """The rows as open versions that start on ``day``, with the hash of their tracked attributes."""
    return as_open_versions(snapshots, day).withColumn("_attr_hash", change_hash(tracked))


def as_open_versions(snapshots: DataFrame, day: Column) -> DataFrame:
    """The rows as open versions that start on ``day``, not hashed yet."""
    return snapshots.withColumns({"effective_date": day, "expiry_date": F.lit(None).cast("date"), "is_current": F.lit(True)})


def scd2_history(versions: DataFrame, keys: list[str], tracked: list[str] | None = None) -> DataFrame:
    """Folds day-by-day versions (see ``as_new_versions``) into history in one shuffle on the key.

    A row equal to the one before it is dropped; each remaining row ends the day before the next one starts.
    With ``tracked`` the versions come without hashes (``as_open_versions``): rows are compared by these attributes and
    only those that remain are hashed, as hashes do not compress in a shuffle.
    """
    by_day = Window.partitionBy(*keys, "_alone").orderBy("effective_date")
    starts = (
        versions.withColumn("_alone", alone(keys))
        .withColumn("_starts", starts_version(tracked or ["_attr_hash"], by_day))
        .filter("_starts")
        .drop("_starts")
    )
    end = F.date_sub(F.lead("effective_date").over(by_day), 1)
    history = starts.withColumn("expiry_date", end).withColumn("is_current", F.col("expiry_date").isNull()).drop("_alone")
    return history.withColumn("_attr_hash", change_hash(tracked)) if tracked else history


def starts_version(tracked: list[str], by_day: WindowSpec) -> Column:
    """Whether a row is the first of its window or differs from the one before it in a tracked attribute.

    Compares what the hash is made of, from plain columns, so that nothing is added to the rows before their shuffle.
    """
    before = change_text([F.lag(c).over(by_day) for c in tracked])
    return (F.row_number().over(by_day) == 1) | (before != change_text([F.col(c) for c in tracked]))


def scd2_merge(current: DataFrame, incoming: DataFrame, day: str | date, keys: list[str]) -> DataFrame:
    """Current versions and one day's rows, merged: closed, new, changed and untouched versions.

    One full outer join does the work of an update pass and an insert pass. Both sides hold one row per key,
    so no key is hot.
    """
    columns = current.columns
    old = current.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*columns).alias("_old"))
    new = incoming.select(*[F.col(k).alias(f"_new_{k}") for k in keys], F.struct(*columns).alias("_new"))
    same_key = [F.col(f"_old_{k}") == F.col(f"_new_{k}") for k in keys]
    before, after = F.col("_old"), F.col("_new")
    closed = before.withField("expiry_date", F.date_sub(day_literal(day), 1)).withField("is_current", F.lit(False))
    versions = (
        F.when(before.isNull(), F.array(after))
        .when(after.isNull() | (before["_attr_hash"] == after["_attr_hash"]), F.array(before))
        .otherwise(F.array(closed, after))
    )
    return old.join(new, same_key, "full_outer").select(F.inline(versions))


def rewind(dim: DataFrame, day: str | date) -> DataFrame:
    """The dimension as it was before ``day``: later versions removed, the ones closed since then open again."""
    d = day_literal(day)
    closed_since = F.coalesce(F.col("expiry_date") >= F.date_sub(d, 1), F.lit(False))
    return (
        dim.filter(F.col("effective_date") < d)
        .withColumn("is_current", F.col("is_current") | closed_since)
        .withColumn("expiry_date", F.when(~F.col("is_current"), F.col("expiry_date")))
    )


def scd2_step(dim: DataFrame, incoming: DataFrame, day: str | date, keys: list[str]) -> DataFrame:
    """The whole dimension after ``day``. Running the newest day again gives the same dimension.

    A day before the newest one fails at once: history after it would be lost, and is rebuilt with
    ``scd2_history``. The check reads one column of the dimension first, as a check inside the result could be
    skipped by a pushed-down filter.
    Closed versions pass through without a shuffle; only current ones meet the incoming rows.
    """
    newest = dim.agg(F.max("effective_date")).first()[0]
    if newest is not None and str(newest) > str(day):
        raise ValueError(f"the dimension already holds versions later than {day}: the newest starts on {newest}")
    prior = rewind(dim, day)
    closed = prior.filter(~F.col("is_current"))
    return closed.unionByName(scd2_merge(prior.filter("is_current"), incoming, day, keys))


def first_after(snapshots: DataFrame, day: str | date, keys: list[str], asked: DataFrame) -> DataFrame:
    """The first of the versions (see ``as_new_versions``) that start after ``day``, of each asked key."""
    later = snapshots.filter(F.col("effective_date") > day_literal(day)).join(asked.select(*keys).distinct(), keys, "left_semi")
    first = F.min_by(F.struct(*snapshots.columns), "effective_date")
    return later.groupBy(*keys).agg(first.alias("first")).select("first.*")


def splice_keys(dim: DataFrame, incoming: DataFrame, day: str | date, keys: list[str]) -> DataFrame:
    """The keys whose history a day's rows may change: those of the rows, and those with a version that starts on it."""
    started = dim.filter(F.col("effective_date") == day_literal(day))
    return incoming.select(*keys).union(started.select(*keys)).dropna().distinct()


def splice_changes(dim: DataFrame, incoming: DataFrame, following: DataFrame, day: str | date, keys: list[str]) -> DataFrame:
    """What ``day``'s rows change in a history that reaches beyond it: versions with ``removed`` true or false.

    ``incoming`` holds all rows of the day, as it now is, and ``following`` the first row after it (``first_after``) of
    every key of ``splice_keys``, both as versions. Of a key's history only the version before the day, one that
    starts on it and the next one can change: the day's row splits the version that covers it, which goes on where
    it was next seen; a row equal to what is before it is no version; and a version equal to the day's row now starts on it.
    Other keys, and a key's other versions, do not occur in the result. A version that keeps its start but changes occurs
    as removed and as not removed.
    """
    d, columns = day_literal(day), dim.columns
    row = F.struct(*columns)
    touched = splice_keys(dim, incoming, day, keys)
    known = dim.join(touched, keys, "left_semi")
    covers = (F.col("effective_date") < d) & (F.col("expiry_date").isNull() | (F.col("expiry_date") >= F.date_sub(d, 1)))
    first_later = F.min_by(F.when(F.col("effective_date") > d, row), F.when(F.col("effective_date") > d, F.col("effective_date")))
    chain = known.groupBy(*keys).agg(
        F.max_by(F.when(covers, row), F.when(covers, F.col("effective_date"))).alias("before"),
        F.max(F.when(F.col("effective_date") == d, row)).alias("at"),
        first_later.alias("later"),
    )
    chain = touched.join(chain, keys, "left")
    chain = chain.join(incoming.select(*keys, row.alias("new")), keys, "left")
    chain = chain.join(following.select(*keys, row.alias("next")), keys, "left")
    before, at, new, next_ = (F.col(c) for c in ("before", "at", "new", "next"))
    later = F.when(F.col("later.effective_date") == next_["effective_date"], F.col("later"))
    chain = chain.select(before.alias("before"), at.alias("at"), new.alias("new"), F.coalesce(later, next_).alias("next"), later.alias("later"))
    state = F.coalesce(new["_attr_hash"], before["_attr_hash"])
    starts_here = new.isNotNull() & ~new["_attr_hash"].eqNullSafe(before["_attr_hash"])
    starts_next = next_.isNotNull() & ~next_["_attr_hash"].eqNullSafe(state)
    covering = F.coalesce(F.col("later"), at, before)  # the version that holds the following row, or the last one
    ends = covering["expiry_date"]
    next_start = F.when(starts_next, F.date_sub(next_["effective_date"], 1))
    after_here = F.when(starts_next, next_start).otherwise(ends)
    after_before = F.when(starts_here, F.date_sub(d, 1)).otherwise(after_here)

    def ending(version: Column, end: Column) -> Column:
        return version.withField("expiry_date", end).withField("is_current", end.isNull())

    old = F.array_compact(F.array(before, at, F.col("later")))
    now = F.array_compact(
        F.array(
            F.when(before.isNotNull(), ending(before, after_before)),
            F.when(starts_here, ending(new, after_here)),
            F.when(starts_next, ending(next_, ends)),
        )
    )
    shape = lambda versions: F.transform(versions, lambda v: F.struct(v["effective_date"], v["expiry_date"], v["_attr_hash"]))
    chain = chain.select(old.alias("old"), now.alias("now"), (at.isNull() & (shape(old) == shape(now))).alias("same")).filter("not same")
    both = F.concat(
        F.transform("old", lambda v: F.struct(v.alias("version"), F.lit(True).alias("removed"))),
        F.transform("now", lambda v: F.struct(v.alias("version"), F.lit(False).alias("removed"))),
    )
    changed = chain.select(F.inline(both)).select("version.*", "removed")
    keyless = _any_null(keys)
    gone = dim.filter(keyless & (F.col("effective_date") == d)).withColumn("removed", F.lit(True))
    come = incoming.filter(keyless).select(*columns).withColumn("removed", F.lit(False))
    return changed.unionByName(gone).unionByName(come)


def scd2_splice(dim: DataFrame, incoming: DataFrame, following: DataFrame, day: str | date, keys: list[str]) -> DataFrame:
    """The whole dimension with a late or repeated day in it: what ``scd2_history`` gives for all days together.

    ``dim`` is read several times: pass a stored table.
    """
    changes = splice_changes(dim, incoming, following, day, keys)
    removed = changes.filter("removed").select(*keys, "effective_date").dropna()
    kept = dim.join(removed, [*keys, "effective_date"], "left_anti")
    kept = kept.filter(~(_any_null(keys) & (F.col("effective_date") == day_literal(day))))
    return kept.unionByName(changes.filter(~F.col("removed")).drop("removed"))


def valid_between(dim: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """The versions valid on at least one day of a range; on a single day at most one per key."""
    still_valid = F.col("expiry_date").isNull() | (F.col("expiry_date") >= day_literal(start))
    return dim.filter((F.col("effective_date") <= day_literal(end)) & still_valid)


def alone(keys: list[str]) -> Column:
    """Tells every row without a complete key from all others, so that such rows never meet in one window."""
    return F.when(_any_null(keys), F.monotonically_increasing_id())


def _any_null(keys: list[str]) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return missing
