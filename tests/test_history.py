"""Counts per day: equal to a full scan, whatever comes late, is merged, killed or handed over."""

import json
from datetime import date

import pytest

import clickstream as cs
from clickstream.streaming import commits, history
from tests.conftest import rows
from tests.test_commits import Killed, kill  # noqa: F401 a fixture
from tests.test_streaming import NOW, Log, kafka_shaped


def entry(day, visitor, place="P1"):
    record = {"openid": visitor, "province": place, "city": f"{place}-c", "total_money": 1}
    if day:
        record["time"] = f"2024-01-{day:02d} 10:00:00"
    return json.dumps(record)


@pytest.fixture
def log(spark, tmp_path):
    log = Log(spark, tmp_path / "log")
    log.add(entry(1, "u1"), entry(1, "u1"), entry(1, "u2"), entry(2, "u1", "P2"), "not json", "")
    log.add(entry(3, "u3"), entry(3, None), entry(None, "u4"), entry(None, None))
    return log


def work(log, where, checkpoint="c"):
    """Archives what is new and counts it; the days that changed."""
    archive = cs.write_batch(str(where / "raw"), lambda b: cs.valid(cs.parse_log(b)), by=["dt"])
    stream = kafka_shaped(log)
    cs.run_batches(stream, str(where / checkpoint), archive, trigger=NOW).awaitTermination()


def refresh(log, where):
    return cs.refresh_visits(log.spark, str(where / "raw"), str(where / "visits"))


def check(log, where):
    """The reports against a scan of the whole log."""
    daily = cs.daily_visits(log.spark, str(where / "visits"))
    records = cs.valid(cs.parse_log(cs.read_lines(log.spark, str(log.folder))))
    columns = ["openid", "province", "city", "views"]
    assert rows(cs.areas_of_days(daily), *columns) == rows(cs.area_distribution(records), *columns)
    assert cs.traffic_of_days(daily).collect() == cs.pv_uv(records).collect()
    by_day = {r.dt: (r.pv, r.uv) for r in cs.traffic_by_day(daily).collect()}
    scanned = {}
    for r in records.select("dt", "openid").collect():
        scanned.setdefault(r.dt, []).append(r.openid)
    known = {day: [v for v in seen if v is not None] for day, seen in scanned.items()}
    assert by_day == {day: (len(seen), len(set(seen))) for day, seen in known.items()}


def test_late_records_change_their_day_only(log, tmp_path):
    work(log, tmp_path)
    assert set(refresh(log, tmp_path)) == {date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3), None}
    check(log, tmp_path)
    before = history._folders_by_day(commits.load(log.spark, str(tmp_path / "visits")))
    assert refresh(log, tmp_path) == []  # nothing new
    log.add(entry(1, "u9"), entry(1, "u1"))
    log.add(entry(1, "u9", "P7"))
    work(log, tmp_path)
    assert refresh(log, tmp_path) == [date(2024, 1, 1)]
    after = history._folders_by_day(commits.load(log.spark, str(tmp_path / "visits")))
    assert {day for day in after if after[day] != before.get(day)} == {"dt=2024-01-01"}
    check(log, tmp_path)


def test_days_are_chosen_by_their_folders(log, tmp_path):
    work(log, tmp_path)
    refresh(log, tmp_path)
    visits = str(tmp_path / "visits")
    some = cs.daily_visits(log.spark, visits, date(2024, 1, 2), date(2024, 1, 3))
    assert {r.dt.day for r in some.collect()} == {2, 3}
    assert all("2024-01-01" not in file for file in some.inputFiles())
    assert {r.dt.day for r in cs.daily_visits(log.spark, visits, last=date(2024, 1, 1)).collect()} == {1}
    assert cs.daily_visits(log.spark, visits, date(2025, 1, 1)).count() == 0


def test_merges_of_the_archive_count_nothing_twice(log, tmp_path):
    for i in range(3):
        work(log, tmp_path)
        refresh(log, tmp_path)
        assert cs.compact_table(log.spark, str(tmp_path / "raw")) >= 0
        check(log, tmp_path)
        log.add(entry(1 + i, "u1"), entry(9, f"u{i}"))
        log.add(entry(2, "u5"))


@pytest.mark.parametrize(
    "module, name, after",
    [
        (history, "size", False),  # written, not committed
        (commits, "create_new", False),
        (commits, "create_new", True),  # committed, the caller does not know
        (history, "delete", False),  # before old folders go
        (history, "delete", True),
    ],
)
def test_killed_refresh(log, tmp_path, kill, module, name, after):  # noqa: F811
    work(log, tmp_path)
    refresh(log, tmp_path)
    for i in (1, 2):
        log.add(entry(1, f"u{i}"), entry(4, "u1"))
        work(log, tmp_path)
        if i == 1:
            refresh(log, tmp_path)
    undo = kill(module, name, after=after)
    with pytest.raises(Killed):
        refresh(log, tmp_path)
    undo()
    refresh(log, tmp_path)
    check(log, tmp_path)


def test_an_archive_that_takes_batches_back_is_counted_anew(log, tmp_path):
    work(log, tmp_path)
    refresh(log, tmp_path)
    raw = str(tmp_path / "raw")
    commits.hand_over(log.spark, raw, 0)
    work(log, tmp_path, checkpoint="new")
    refresh(log, tmp_path)
    check(log, tmp_path)
    log.add(entry(2, "u2"))
    work(log, tmp_path, checkpoint="new")
    refresh(log, tmp_path)
    check(log, tmp_path)


def test_two_refreshes_at_once(log, tmp_path, monkeypatch):
    """The second to commit is refused, and the table stays right."""
    work(log, tmp_path)
    real, other = history.size, []

    def size(*args):
        if not other:
            other.append(1)
            monkeypatch.setattr(history, "_remove_remains", lambda *a: None)
            refresh(log, tmp_path)
        return real(*args)

    monkeypatch.setattr(history, "size", size)
    with pytest.raises(ValueError, match="another process"):
        refresh(log, tmp_path)
    check(log, tmp_path)


def test_no_archive_yet(spark, tmp_path):
    assert cs.refresh_visits(spark, str(tmp_path / "raw"), str(tmp_path / "visits")) == []
    daily = cs.daily_visits(spark, str(tmp_path / "visits"))
    assert cs.traffic_of_days(daily).collect() == [(0, 0)] and cs.areas_of_days(daily).count() == 0
