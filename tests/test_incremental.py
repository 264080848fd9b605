"""Files that arrive in any order, a run that dies, and the lake that a backfill gives."""

import pytest
from pyspark.errors import StreamingQueryException

from marketlake.plans import daily_run, incremental
from test_daily_run import DAYS, LATE_TABLES, content, write_feeds


def test_files_in_any_order_give_the_lake_of_a_backfill(spark, tmp_path, monkeypatch):
    """The middle day arrives last and its run dies between its tables; one more file comes for the first day."""
    write_feeds(tmp_path / "all")
    feeds, lake, checkpoint = tmp_path / "feeds", str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def arrive(day, *names):
        for folder in ("search", "details"):
            (feeds / folder / day).mkdir(parents=True, exist_ok=True)
            for file in (tmp_path / "all" / folder / day).iterdir():
                if not names or file.name in names:
                    file.rename(feeds / folder / day / file.name)

    def take_in():
        return incremental.run_new_files(spark, str(feeds), lake, checkpoint)

    arrive(DAYS[0], "lamp.json", "lamps.json", "d.json")
    assert {r.table for r in take_in()} == {n for n in daily_run.tables("") if not n.startswith("quarantine")}
    arrive(DAYS[2])
    take_in()
    assert take_in() == []
    arrive(DAYS[1])
    arrive(DAYS[0])
    kept, calls = daily_run.marts.mart_keyword_daily, []

    def dies(*args, **options):
        calls.append(1)
        raise RuntimeError("killed")

    monkeypatch.setattr(daily_run.marts, "mart_keyword_daily", dies)
    with pytest.raises(StreamingQueryException):
        take_in()
    assert calls
    monkeypatch.setattr(daily_run.marts, "mart_keyword_daily", kept)
    take_in()
    daily_run.backfill(spark, str(feeds), str(tmp_path / "whole"), DAYS[0], DAYS[-1])
    for name in LATE_TABLES:
        found = content(spark, lake, name)
        assert found and found == content(spark, str(tmp_path / "whole"), name), name


def test_a_first_load_is_one_backfill(spark, tmp_path):
    write_feeds(tmp_path / "feeds")
    reports = incremental.run_new_files(spark, str(tmp_path / "feeds"), str(tmp_path / "lake"), str(tmp_path / "checkpoint"), files_a_batch=100)
    assert len(reports) == len({r.table for r in reports})
    daily_run.backfill(spark, str(tmp_path / "feeds"), str(tmp_path / "whole"), DAYS[0], DAYS[-1])
    assert content(spark, str(tmp_path / "lake"), "dim_product") == content(spark, str(tmp_path / "whole"), "dim_product")
