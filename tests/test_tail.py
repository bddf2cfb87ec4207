import os
import re
import zlib
from unittest import mock

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

import clickstream as cs
from clickstream.sources.tail import Share, TailLogReader
from tests.conftest import rows

NOW = {"availableNow": True}


class Tail:
    """Runs the source on a folder until it has read what is there."""

    def __init__(self, spark, tmp_path):
        self.spark, self.work, self.folder = spark, tmp_path, tmp_path / "logs"
        self.folder.mkdir()
        cs.register_tail(spark)

    def append(self, name, data):
        with open(self.folder / name, "ab") as file:
            file.write(data)

    def read(self, **options):
        stream = self.spark.readStream.format("tail_log").options(**options)
        (
            stream.load(str(self.folder)).writeStream.format("parquet")
            .option("path", str(self.work / "out"))
            .option("checkpointLocation", str(self.work / "checkpoint"))
            .trigger(**NOW).start().awaitTermination()
        )
        return [value for value, in rows(self.spark.read.parquet(str(self.work / "out")), "value")]


@pytest.fixture
def tail(spark, tmp_path):
    return Tail(spark, tmp_path)


def test_torn_line_blank_line_new_file_and_restart(tail):
    tail.append("a.log", b"one\n\n  \r\ntwo\nto")
    assert tail.read() == ["  ", "one", "two"]
    tail.append("a.log", b"rn\n")
    tail.append("b.log", "手机\n".encode())
    assert tail.read() == ["  ", "one", "torn", "two", "手机"]
    assert tail.read() == ["  ", "one", "torn", "two", "手机"]


def test_charset_and_dirty_bytes(tail):
    tail.append("a.log", "手机\n".encode("gbk"))
    assert tail.read(charset="gbk") == ["手机"]
    tail.append("a.log", b"x\xff\n")
    assert tail.read(charset="gbk") == ["x�", "手机"]


def test_shorter_file_is_read_again(tail):
    tail.append("a.log", b"first\nsecond\n")
    tail.read()
    (tail.folder / "a.log").write_bytes(b"new\n")
    assert tail.read() == ["first", "new", "second"]


def test_deleted_file(tail):
    tail.append("a.log", b"one\n")
    tail.append("b.log", b"two\n")
    tail.read()
    os.remove(tail.folder / "a.log")
    assert tail.read() == ["one", "two"]
    tail.append("a.log", b"three\n")  # the same name again is a new file
    assert tail.read() == ["one", "three", "two"]


def test_many_small_splits_in_spark(tail):
    lines = [f"line {i} {'x' * (i % 50)}" for i in range(500)]
    tail.append("a.log", "".join(f"{line}\n" for line in lines[:250]).encode())
    assert tail.read(splitBytes="100") == sorted(lines[:250], key=lambda v: repr((v,)))
    tail.append("a.log", "".join(f"{line}\n" for line in lines[250:]).encode())
    assert tail.read(splitBytes="100") == sorted(lines, key=lambda v: repr((v,)))


def reader(path, **options):
    return TailLogReader({"path": str(path), **options})


def head(data):
    return [len(data), zlib.crc32(data)]


def ends(offset):
    """Where the files that are followed are read to, by path."""
    return {at["path"]: at["end"] for at in offset.values() if at["follow"]}


def values(source, start, end):
    """What each task reads, task by task."""
    return [
        [v for batch in source.read(share) for v in batch.column(0).to_pylist()]
        for share in source.partitions(start, end)
    ]


@pytest.mark.parametrize("split", range(1, 16))
def test_every_split_size_gives_each_line_once(tmp_path, split):
    (tmp_path / "a").write_bytes(b"a\nbb\n\nccc\r\nd\re\nlong long line\nz\n")
    source = reader(tmp_path, splitBytes=str(split))
    end = source.latestOffset()
    parts = values(source, {}, end)
    lines = ["a", "bb", "ccc", "d", "e", "long long line", "z"]
    assert [v for part in parts for v in part] == lines
    middle = {key: at | {"end": 5, "head": head(b"a\nbb\n")} for key, at in end.items()}
    assert [v for part in values(source, middle, end) for v in part] == lines[2:]


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.text("ab \r\n手", max_size=12), min_size=1, max_size=6),
    st.integers(1, 30),
    st.integers(1, 9),
)
def test_any_growth_any_split(tmp_path_factory, pieces, split, block):
    """However the file grows and is cut up, each complete line comes once and in order."""
    path = tmp_path_factory.mktemp("tail") / "a"
    source = reader(path, splitBytes=str(split))
    got, start, written = [], {}, ""
    with mock.patch("clickstream.sources.tail.BLOCK_BYTES", block):
        for piece in pieces:
            written += piece
            path.write_bytes(written.encode())
            end = source.latestOffset()
            got += [v for part in values(source, start, end) for v in part]
            start = end
    complete = written[: written.rfind("\n") + 1]
    assert got == [line for line in re.split("\r|\n", complete) if line]


def test_blocks_smaller_than_lines(tmp_path, monkeypatch):
    monkeypatch.setattr("clickstream.sources.tail.BLOCK_BYTES", 3)
    (tmp_path / "a").write_bytes(b"abcdefgh\nij\n\nklmnop\ntail")
    source = reader(tmp_path)
    assert ends(source.latestOffset()) == {str(tmp_path / "a"): 20}
    assert values(source, {}, source.latestOffset()) == [["abcdefgh", "ij", "klmnop"]]


def test_small_files_share_a_task(tmp_path):
    for i in range(10):
        (tmp_path / f"{i}.log").write_bytes(b"x\n")
    source = reader(tmp_path / "*.log", splitBytes="8")
    assert [len(v) for v in values(source, {}, source.latestOffset())] == [4, 4, 2]


def test_hidden_files_and_missing_files(tmp_path):
    (tmp_path / "_tmp").write_bytes(b"x\n")
    (tmp_path / ".swp").write_bytes(b"x\n")
    assert reader(tmp_path).latestOffset() == {}
    assert reader(tmp_path / "absent").latestOffset() == {}


def test_offsets_follow_growth_and_truncation(tmp_path):
    path = tmp_path / "a"
    path.write_bytes(b"one\ntw")
    source = reader(path)
    assert ends(source.latestOffset()) == {str(path): 4}
    path.write_bytes(b"one\ntwo\n")
    start = source.latestOffset()
    assert ends(start) == {str(path): 8}
    path.write_bytes(b"x\n")
    end = source.latestOffset()
    assert ends(end) == {str(path): 2}
    with pytest.warns(UserWarning, match="anew"):
        assert values(source, start, end) == [["x"]]


@pytest.mark.parametrize("restarted", [False, True])
def test_renamed_file_is_finished_and_its_name_is_new(tmp_path, restarted):
    path = tmp_path / "a.log"
    path.write_bytes(b"old1\nold2\n")
    source = reader(tmp_path / "*.log")
    start = source.latestOffset()
    assert values(source, {}, start) == [["old1", "old2"]]
    with path.open("ab") as file:
        file.write(b"old3\n")
    path.rename(tmp_path / "a.log.1")  # the pattern does not match this
    path.write_bytes(b"".join(b"new%d\n" % i for i in range(6)))  # longer than the old position
    source = reader(tmp_path / "*.log") if restarted else source
    end = source.latestOffset()
    got = [v for part in values(source, start, end) for v in part]
    assert sorted(got) == ["new0", "new1", "new2", "new3", "new4", "new5", "old3"]
    with (tmp_path / "a.log.1").open("ab") as file:  # its writer had not yet let go of it
        file.write(b"old4\n")
    later = source.latestOffset()
    assert values(source, end, later) == [["old4"]]


def test_copied_and_cut_off(tmp_path):
    path = tmp_path / "a.log"
    path.write_bytes(b"old1\nold2\n")
    source = reader(path)
    start = source.latestOffset()
    values(source, {}, start)
    (tmp_path / "a.log.1").write_bytes(path.read_bytes())
    with path.open("r+b") as file:  # the same file, regrown past the old position
        file.truncate()
        file.write(b"new1\nnew2\nnew3\n")
    with pytest.warns(UserWarning, match="anew"):
        assert values(source, start, source.latestOffset()) == [["new1", "new2", "new3"]]


def test_renamed_between_planning_and_reading(tmp_path):
    path = tmp_path / "a.log"
    path.write_bytes(b"old\n")
    source = reader(path)
    share, = source.partitions({}, source.latestOffset())
    path.rename(tmp_path / "a.log.1")
    path.write_bytes(b"new and longer\n")
    assert [v for b in source.read(share) for v in b.column(0).to_pylist()] == ["old"]


def test_file_that_comes_to_match_is_read_whole(tmp_path):
    (tmp_path / "a.tmp").write_bytes(b"one\n")
    (tmp_path / "b.log").write_bytes(b"two\n")
    source = reader(tmp_path / "*.log")
    start = source.latestOffset()
    assert values(source, {}, start) == [["two"]]
    (tmp_path / "a.tmp").rename(tmp_path / "a.log")
    assert values(source, start, source.latestOffset()) == [["one"]]


def test_unread_file_that_is_gone(tmp_path):
    path = tmp_path / "a"
    path.write_bytes(b"one\ntorn")
    source = reader(path)
    start = source.latestOffset()
    path.unlink()
    with pytest.raises(OSError, match="unread"):
        source.partitions(start, source.latestOffset())
    lenient = reader(path, failOnDataLoss="false")
    with pytest.warns(UserWarning, match="unread"):
        assert lenient.partitions(start, lenient.latestOffset()) == []


def test_lost_bytes_fail_unless_allowed(tmp_path):
    path = str(tmp_path / "a")
    (tmp_path / "a").write_bytes(b"one\n")
    key, = reader(path).latestOffset()
    gone = Share([(path, key, 0, 100, 0)])
    with pytest.raises(OSError, match="no longer"):
        list(reader(path).read(gone))
    kept = list(reader(path, failOnDataLoss="false").read(gone))
    assert [v for b in kept for v in b.column(0).to_pylist()] == ["one"]


def test_file_url(tmp_path):
    (tmp_path / "a#1.log").write_bytes(b"x\n")
    assert ends(reader(tmp_path / "a#1.log").latestOffset()) == {str(tmp_path / "a#1.log"): 2}
    assert ends(reader(f"file://{tmp_path}").latestOffset()) == {str(tmp_path / "a#1.log"): 2}


def test_bad_options():
    with pytest.raises(ValueError, match="mounted"):
        reader("hdfs://host/logs")
    with pytest.raises(ValueError, match="path"):
        TailLogReader({})
    with pytest.raises(ValueError, match="utf-16"):
        TailLogReader({"path": os.sep, "charset": "utf-16-le"})
    with pytest.raises(LookupError):
        TailLogReader({"path": os.sep, "charset": "no-such"})
