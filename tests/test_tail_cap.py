"""The cap of the tail source: it delays lines, drops none, and outlives restarts."""

import os
import random

import pytest

import clickstream as cs
from clickstream.sources.tail import TailLogReader
from tests.conftest import rows


class Driver:
    """Calls a reader as a streaming query does; what is committed survives `restart`."""

    def __init__(self, folder, **options):
        self.options = {"path": str(folder / "logs"), "positions": str(folder / "positions"), **options}
        self.folder = folder / "logs"
        self.folder.mkdir()
        self.committed, self.lines, self.sizes = {}, [], []
        self.restart()

    def restart(self):
        self.reader = TailLogReader(self.options)

    def append(self, name, text):
        with open(self.folder / name, "ab") as file:
            file.write(text.encode())

    def plan(self):
        return self.reader.latestOffset()

    def run(self, end):
        read = []
        for share in self.reader.partitions(self.committed, end):
            for batch in self.reader.read(share):
                read += zip(batch.column("value").to_pylist(), batch.column("path").to_pylist())
        self.sizes.append(sum(len(value.encode()) + 1 for value, _ in read))
        self.lines += [value for value, _ in read]
        self.committed = end

    def all(self):
        while (end := self.plan()) != self.committed:
            self.run(end)
        return self.lines


def lines(n, prefix=""):
    return [f"{prefix}line {i} {'x' * (i % 40)}" for i in range(n)]


def text(values):
    return "".join(f"{v}\n" for v in values)


@pytest.fixture
def driver(tmp_path):
    return Driver(tmp_path, maxBytesPerTrigger="1000")


def test_a_backlog_is_read_in_parts(driver):
    driver.append("a.log", text(lines(300)))
    assert driver.all() == lines(300)
    assert max(driver.sizes) <= 1000 and len(driver.sizes) >= 8


def test_files_share_the_cap_and_none_waits(driver):
    driver.append("a.log", text(lines(300, "a")))
    driver.append("b.log", text(lines(300, "b")))
    driver.append("c.log", text(lines(5, "c")))
    driver.run(driver.plan())
    assert {value[0] for value in driver.lines} == {"a", "b", "c"}
    assert driver.sizes[0] <= 1000 and set(lines(5, "c")) <= set(driver.lines)
    assert sorted(driver.all()) == sorted(lines(300, "a") + lines(300, "b") + lines(5, "c"))


def test_a_line_longer_than_the_cap(driver):
    long = ["y" * 5000, "short", "z" * 2500]
    driver.append("a.log", text(long))
    driver.append("b.log", text(lines(3)))
    assert sorted(driver.all()) == sorted(long + lines(3))
    assert len(driver.sizes) >= 2


@pytest.mark.parametrize("seed", range(12))
def test_restarts_anywhere(tmp_path, seed):
    """Killed after planning, after logging a batch, or after finishing it; renamed meanwhile."""
    rng = random.Random(seed)
    driver = Driver(tmp_path, maxBytesPerTrigger="700")
    written, logged, names = [], None, 0
    for step in range(60):
        values = lines(rng.randint(0, 25), f"{step} ")
        written += values
        driver.append("a.log", text(values))
        if rng.random() < 0.1:
            names += 1
            os.rename(driver.folder / "a.log", driver.folder / f"a.log.{names}")
        what = rng.random()
        if what < 0.15:
            driver.restart()  # nothing was planned
        elif what < 0.3:
            driver.plan()  # planned, but not in the offset log
            driver.restart()
        elif what < 0.5:
            logged = driver.plan()  # in the offset log: the same batch runs again
            driver.restart()
            driver.run(logged)
        else:
            driver.run(driver.plan())
            if rng.random() < 0.3:
                driver.restart()
    assert sorted(driver.all()) == sorted(written)
    # A batch after a restart reaches over two caps at most, and a line of each file.
    assert max(driver.sizes) <= 2 * 700 + 60 * 10


def test_positions_are_needed_and_checked(tmp_path):
    with pytest.raises(ValueError, match="positions"):
        TailLogReader({"path": "x", "maxBytesPerTrigger": "5"})
    driver = Driver(tmp_path, maxBytesPerTrigger="100")
    driver.append("a.log", text(lines(50)))
    driver.all()
    os.remove(tmp_path / "positions")
    driver.restart()
    driver.append("a.log", text(lines(50)))
    with pytest.raises(ValueError, match="not of this checkpoint"):
        driver.run(driver.plan())


def test_a_file_written_anew_is_read_from_its_start(driver):
    driver.append("a.log", text(lines(100, "old ")))
    driver.all()
    (driver.folder / "a.log").write_text(text(lines(40, "new ")))
    assert driver.all() == lines(100, "old ") + lines(40, "new ")


def test_in_spark(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    cs.register_tail(spark)
    expected = []
    for run in range(2):
        expected += lines(400, f"{run} ")
        with open(tmp_path / "logs" / "a.log", "a") as file:
            file.write(text(lines(400, f"{run} ")))
        stream = spark.readStream.format("tail_log").options(
            maxBytesPerTrigger="4000", positions=str(tmp_path / "positions")
        )
        query = (
            stream.load(str(tmp_path / "logs")).writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
        )
        query.processAllAvailable()
        query.stop()
        assert query.lastProgress["batchId"] >= 3 * (run + 1)
        got = spark.read.parquet(str(tmp_path / "out"))
        assert rows(got, "value") == sorted(((v,) for v in expected), key=repr)
