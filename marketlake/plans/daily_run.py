"""From raw feed to marts: one day, or a whole range of days as a few large Spark jobs."""

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.quality import dim_totals
from marketlake.operators.scd2 import first_after, rewind, splice_changes, splice_keys, valid_between
from marketlake.plans import dimension, facts, marts, silver
from marketlake.sources import dim_store
from marketlake.sources.drift import DRIFT, drifted
from marketlake.sources.feeds import FEEDS, Feed, feed_days, flatten, is_bad, quarantined, read_envelopes
from marketlake.sources.files import delete
from marketlake.sources.tables import RunReport, publish_days, read_days, stored_days


# Runs of the dimension that readers may still be using when a new one ends.
KEPT_RUNS = 2


@dataclass(frozen=True)
class Table:
    path: str
    schema: str


def tables(lake: str) -> dict[str, Table]:
    """Where each table of a lake lives, and its schema."""
    return {
        "bronze_search_results": Table(f"{lake}/bronze/search_results", schemas.BRONZE_SEARCH),
        "bronze_product_details": Table(f"{lake}/bronze/product_details", schemas.BRONZE_DETAILS),
        "quarantine_search_results": Table(f"{lake}/quarantine/search_results", schemas.QUARANTINE),
        "quarantine_product_details": Table(f"{lake}/quarantine/product_details", schemas.QUARANTINE),
        "silver_search_results": Table(f"{lake}/silver/search_results", schemas.SILVER_SEARCH),
        "silver_product_details": Table(f"{lake}/silver/product_details", schemas.SILVER_DETAILS),
        "dim_product": Table(f"{lake}/gold/dim_product", schemas.DIM_PRODUCT),
        "fact_search_ranking": Table(f"{lake}/gold/fact_search_ranking", schemas.FACT_SEARCH_RANKING),
        "fact_price_snapshot": Table(f"{lake}/gold/fact_price_snapshot", schemas.FACT_PRICE_SNAPSHOT),
        "fact_product_performance": Table(f"{lake}/gold/fact_product_performance", schemas.FACT_PRODUCT_PERFORMANCE),
        "mart_keyword_daily": Table(f"{lake}/gold/mart_keyword_daily", schemas.MART_KEYWORD_DAILY),
        "mart_brand_competitive": Table(f"{lake}/gold/mart_brand_competitive", schemas.MART_BRAND_COMPETITIVE),
    }


def run_day(
    spark: SparkSession, feeds: str, lake: str, day: str, multi_line: bool = True, kept_runs: int = KEPT_RUNS
) -> list[RunReport]:
    """Builds every table for one day, in dependency order. Running a day again gives the same tables.

    The dimension keeps what readers of its newest ``kept_runs`` runs need.
    """
    newest = dim_store.newest_day(spark, tables(lake)["dim_product"].path)
    if newest and day < newest:
        raise ValueError(f"{newest} is already loaded: use backfill to rebuild from {day} on, or run_late_day for that day alone")
    return _run(spark, feeds, lake, day, day, multi_line, "current", kept_runs)


def run_late_day(spark: SparkSession, feeds: str, lake: str, day: str, multi_line: bool = True) -> list[RunReport]:
    """Builds one day before the newest one, for the first time or again after late files; the lake is then what a
    backfill over all days gives.

    Product history is spliced: only versions that the day changes are written. Facts and marts are built again from the
    typed tables for the day and for the days on which a changed version was or is valid, as their surrogate keys follow.
    """
    path = tables(lake)["dim_product"].path
    newest = dim_store.newest_day(spark, path)
    if newest is None or day >= newest:
        return run_day(spark, feeds, lake, day, multi_line)
    job = _Job(spark, lake, day, day)
    reports = job.typed(feeds, multi_line)
    report, last = job.splice_dim(newest)
    return [*reports, report, *_Job(spark, lake, day, last).facts_and_marts("asof")]


def backfill(
    spark: SparkSession,
    feeds: str,
    lake: str,
    start: str,
    end: str,
    multi_line: bool = True,
    kept_runs: int = KEPT_RUNS,
) -> list[RunReport]:
    """Builds every table for all days of a range at once: one job per table, not one per day.

    Product history from ``start`` on is rebuilt from the range, so the range must reach the newest day loaded.
    """
    newest = dim_store.newest_day(spark, tables(lake)["dim_product"].path)
    if newest and newest > end:
        raise ValueError(f"days up to {newest} are loaded: a rebuild from {start} must reach that day")
    return _run(spark, feeds, lake, start, end, multi_line, "asof", kept_runs)


def _run(
    spark: SparkSession, feeds: str, lake: str, start: str, end: str, multi_line: bool, mode: str, kept_runs: int
) -> list[RunReport]:
    job = _Job(spark, lake, start, end)
    reports = [*job.typed(feeds, multi_line), job.update_dim(), *job.facts_and_marts(mode)]
    dim_store.drop_old_runs(spark, job.tables["dim_product"].path, kept_runs)
    return reports


def drift_tables(lake: str) -> dict[str, Table]:
    """Where fields beyond the declared schemas are kept, by feed."""
    return {f"drift_{feed.name}": Table(f"{lake}/drift/{feed.name}", DRIFT) for feed in FEEDS}


def record_drift(
    spark: SparkSession, feeds: str, lake: str, start: str, end: str, multi_line: bool = True
) -> list[RunReport]:
    """Keeps what the feeds of a range of days hold beyond their declared schemas; a day that is clean again is emptied.

    A job of its own, as it parses the files once more: run it beside ``run_day`` or ``backfill``, whose tables it
    does not touch. ``drift_report`` counts what it kept.
    """
    reports = []
    for feed in FEEDS:
        name, table = f"drift_{feed.name}", drift_tables(lake)[f"drift_{feed.name}"]
        days = _days(start, end)
        rows = drifted(spark, feeds, feed, days, multi_line)
        covered = feed_days(spark, feeds, feed, days)
        rows_out = 0 if rows is None else publish_days(rows, table.path, table.schema, start, end, True, covered)
        reports.append(RunReport(name, table.path, "replace days", rows_out, rows_out))
    return reports


class _Job:
    """One run over a range of days. Each table is read back from disk, which cuts the lineage between steps."""

    def __init__(self, spark: SparkSession, lake: str, start: str, end: str):
        self.spark, self.tables, self.start, self.end = spark, tables(lake), start, end

    def read(self, name: str) -> DataFrame:
        table = self.tables[name]
        return read_days(self.spark, table.path, table.schema, self.start, self.end)

    def build(self, name: str, source: DataFrame, transform) -> RunReport:
        """Writes a table from a source; a source without rows writes nothing, a source's day without result is emptied.

        The source is a stored table, so counting it reads file footers only.
        """
        table, rows_in = self.tables[name], source.count()
        rows_out = self._publish(name, transform(source), covered=self._days_of(source)) if rows_in else 0
        return RunReport(name, table.path, "replace days", rows_in, rows_out)

    def ingest(self, feeds: str, feed: Feed, multi_line: bool) -> RunReport:
        """Raw files to the raw table. The files are parsed a second time only if some of them are bad."""
        name = f"bronze_{feed.name}"
        envelopes = read_envelopes(self.spark, feeds, feed, _days(self.start, self.end), multi_line)
        if envelopes is None:
            return RunReport(name, self.tables[name].path, "replace days", 0, 0)
        seen = Observation()
        counted = envelopes.observe(
            seen, F.count(F.lit(1)).alias("envelopes"), F.count_if(is_bad(feed)).alias("bad_envelopes")
        )
        covered = feed_days(self.spark, feeds, feed, _days(self.start, self.end))
        rows_out = self._publish(name, flatten(counted, feed), rebalance=True, covered=covered)
        counts = seen.get
        quarantine = self.tables[f"quarantine_{feed.name}"].path
        for day in stored_days(self.spark, quarantine, self.start, self.end):
            delete(self.spark, f"{quarantine}/ingested_at={day}")
        if counts["bad_envelopes"]:
            self._publish(f"quarantine_{feed.name}", quarantined(envelopes, feed))
        return RunReport(name, self.tables[name].path, "replace days", counts["envelopes"], rows_out, counts)

    def typed(self, feeds: str, multi_line: bool) -> list[RunReport]:
        """The raw and the typed tables, from the feeds."""
        reports = [self.ingest(feeds, feed, multi_line) for feed in FEEDS]
        reports.append(self.build("silver_search_results", self.read("bronze_search_results"), silver.clean_search))
        reports.append(self.build("silver_product_details", self.read("bronze_product_details"), silver.clean_products))
        return reports

    def facts_and_marts(self, mode: str) -> list[RunReport]:
        """The facts and marts, from the typed tables and the dimension."""
        search, details = self.read("silver_search_results"), self.read("silver_product_details")
        dim = dim_store.read_dim(self.spark, self.tables["dim_product"].path, since=self.start)
        dim = valid_between(dim, self.start, self.end)
        reports = [
            self.build("fact_search_ranking", search, lambda s: facts.fact_search_ranking(s, dim, mode)),
            self.build("fact_price_snapshot", search, lambda s: facts.fact_price_snapshot(s, dim, mode, unique_grain=True)),
            self.build("fact_product_performance", details, lambda d: facts.fact_product_performance(d, dim, mode)),
        ]
        ranking, performance = self.read("fact_search_ranking"), self.read("fact_product_performance")
        brands = lambda f: marts.mart_brand_competitive(f, dim, unique_grain=True)
        return [
            *reports,
            self.build("mart_keyword_daily", ranking, lambda f: marts.mart_keyword_daily(f, unique_grain=True)),
            self.build("mart_brand_competitive", performance, brands),
        ]

    def splice_dim(self, newest: str) -> tuple[RunReport, str]:
        """Puts the day into the product history; also the last day on which a version that changed was or is valid."""
        path, day = self.tables["dim_product"].path, self.start
        details, last = self.read("silver_product_details"), day
        rows_in = details.count()
        if rows_in:
            dim, incoming = dim_store.read_dim(self.spark, path), dimension.dim_incoming(details, day)
            table = self.tables["silver_product_details"]
            later = read_days(self.spark, table.path, table.schema, _days(day, newest)[1], newest)
            asked = splice_keys(dim, incoming, day, dimension.KEYS)
            following = first_after(dimension.dim_incoming(later), day, dimension.KEYS, asked)
            seen = Observation()
            changes = splice_changes(dim, incoming, following, day, dimension.KEYS)
            until = F.max(F.coalesce("expiry_date", F.lit(newest).cast("date"))).alias("until")
            dim_store.write_patch(self.spark, changes.observe(seen, until), path)
            last = max(day, min(newest, str(seen.get["until"] or day)))
        totals = dim_totals(dim_store.read_dim(self.spark, path)).first().asDict()
        return RunReport("dim_product", path, "new patch", rows_in, totals["total_rows"], totals), last

    def update_dim(self) -> RunReport:
        """Adds the range's days to the product history, or rebuilds it from the first of them on."""
        path, details = self.tables["dim_product"].path, self.read("silver_product_details")
        rows_in = details.count()
        if rows_in:
            newest = dim_store.newest_day(self.spark, path)
            rebuild = newest is not None and self.start <= newest
            if rebuild:
                dim = rewind(dim_store.read_dim(self.spark, path), self.start)
            else:
                dim = dim_store.read_dim(self.spark, path, since=newest)
            versions = dimension.dim_update(dim, details, self.start, self.end)
            if rebuild:
                versions = versions.unionByName(dim.filter(~F.col("is_current")))
            dim_store.write_run(self.spark, versions, path, self.end, rebuild)
        totals = dim_totals(dim_store.read_dim(self.spark, path)).first().asDict()
        return RunReport("dim_product", path, "new run", rows_in, totals["total_rows"], totals)

    def _publish(self, name: str, df: DataFrame, rebalance: bool = False, covered: Iterable[str] = ()) -> int:
        table, many_days = self.tables[name], self.start < self.end
        return publish_days(df, table.path, table.schema, self.start, self.end, rebalance or many_days, covered)

    def _days_of(self, source: DataFrame) -> list[str]:
        """The days a stored table holds, as one row a day."""
        return [str(r[0]) for r in source.select("ingested_at").distinct().collect()]


def _days(start: str, end: str) -> list[str]:
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]
