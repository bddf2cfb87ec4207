"""A stop that waits for the running batch, and leaves nothing half done."""

import threading
import time

import pytest

import clickstream as cs
from tests.conftest import rows
from tests.test_streaming import NOW, Log, entry, kafka_shaped


@pytest.fixture
def log(spark, tmp_path):
    log = Log(spark, tmp_path / "log")
    for i in range(6):
        log.add(entry(i), f"bad {i}")
    return log


def job(log, where, **options):
    return cs.run_job(
        kafka_shaped(log), str(where / "kpis"), str(where / "c"), str(where / "offsets"),
        malformed_path=str(where / "bad"), raw_path=str(where / "raw"),
        stop_marker=str(where / "stop"), **options,
    )


def kpis(log, where):
    return rows(cs.latest_kpis(log.spark, str(where / "kpis")), "kpi", "key", "value")


def batches_of(log, where, name):
    table = cs.batch_table(log.spark, str(where / name))
    return sorted({r.batch_id for r in table.collect()})


def test_the_running_batch_is_finished(log, tmp_path):
    """The marker comes while a batch runs: that one is whole, the next has not begun."""
    marker = str(tmp_path / "stop")
    real, seen = cs.streaming.kpis.write_batch, []

    def asks_to_stop(path, transform, by=()):
        step = real(path, transform, by)

        def slow(batch, batch_id):
            if batch_id == 2:
                cs.request_stop(log.spark, marker)
                seen.append(batch_id)
            step(batch, batch_id)

        slow.path = path
        return slow

    cs.streaming.kpis.write_batch = asks_to_stop
    try:
        assert cs.await_stop(job(log, tmp_path, trigger=NOW), marker)
    finally:
        cs.streaming.kpis.write_batch = real
    assert seen == [2] and not (tmp_path / "stop").exists()
    for name in ("offsets", "bad", "raw"):
        assert batches_of(log, tmp_path, name) == [0, 1, 2]
    assert sorted(p.name for p in (tmp_path / "kpis").glob("batch_id=*")) == [f"batch_id={i}" for i in range(3)]
    assert not cs.await_stop(job(log, tmp_path, trigger=NOW), marker)
    assert kpis(log, tmp_path) == log.expected()
    assert batches_of(log, tmp_path, "raw") == list(range(6))


def test_an_idle_stream_is_stopped(log, tmp_path):
    marker = str(tmp_path / "stop")
    query = job(log, tmp_path, trigger={"processingTime": "300 milliseconds"})
    query.processAllAvailable()
    threading.Thread(target=lambda: (time.sleep(0.5), cs.request_stop(log.spark, marker))).start()
    assert cs.await_stop(query, marker, poll_seconds=0.2)
    assert not query.isActive and kpis(log, tmp_path) == log.expected()


def test_another_end_is_told(log, tmp_path):
    with pytest.raises(Exception, match="no reason"):
        def fail(batch, batch_id):
            raise RuntimeError("no reason")

        query = cs.run_batches(log.stream(), str(tmp_path / "c"), fail, trigger=NOW)
        cs.await_stop(query, str(tmp_path / "stop"))
