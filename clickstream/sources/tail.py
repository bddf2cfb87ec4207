"""`tail_log`: a streaming source of the lines appended to growing files.

Spark's own file source never looks again at a file it has seen. This one notes, per file, how
far complete lines reach. The driver only asks for file sizes and looks back from the end of a
file that grew for its last newline; executors read the byte ranges, a large range in parallel.
The files must be visible to the driver and all executors under the same path.

    register_tail(spark)
    spark.readStream.format("tail_log").option("path", "/logs/access*.log").load()

Options: `path`, a file, a directory or a pattern; `charset`, UTF-8 by default, any in which a
line feed is one byte of its own; `splitBytes`, the size of one task's share; `failOnDataLoss`, true
by default: fail if bytes are known to have gone unread.

Rows: `value`, one line without its end, and `path`. Empty lines are dropped, lines of spaces
are not. A line is emitted once it ends in a newline.

Rotation: a position belongs to a file, known by its folder, its inode and a checksum of its first
bytes, and is kept in the checkpoint. A file renamed within its folder is read on under the new
name, whether or not the pattern matches that, and the file that takes its old name is read from
its start. A file that was cut off and written anew is read from its start, even if it has grown
past the old position since. What is cut off before it is read is lost, as for any reader. A file
that was renamed before a restart and is still written to after it may be read twice if the job is
killed within the batch in which that happens.

A cap delays lines and drops none. Files that have little new are read whole, the others share
what is left, and each gives at least a line. What a batch was given ends at a line. Spark does not tell
a Python source where it went on after a restart, so the source notes that itself, in `positions`,
before each batch; the first batch after a restart may reach over two caps.

With the trigger `availableNow` a run makes one batch, of at most a cap if there is one; if an earlier run was killed within a batch,
that one is finished first and the lines after it wait for the next run.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import warnings
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "value string, path string"
SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
HEAD_BYTES = 1024


class TailLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TailLogReader(self.options)


class Share(InputPartition):
    """What one task reads: (path, inode, lo, hi, first) slices, `first` being the batch's start.

    A line belongs to the slice in which it starts.
    """

    def __init__(self, slices):
        self.slices = slices


class TailLogReader(DataSourceStreamReader):
    """An offset has, by file, its path, how far it is read, its size, a checksum, and `follow`:
    whether it has once matched the pattern and is read on under any name."""

    def __init__(self, options):
        if not options.get("path"):
            raise ValueError("tail_log needs the option 'path'")
        url = urlsplit(options["path"])
        if url.scheme not in ("", "file"):
            raise ValueError(f"tail_log reads mounted files only, not {options['path']}")
        self.path = url.path if url.scheme else options["path"]
        self.charset = options.get("charset", "utf-8")
        if "\n".encode(self.charset) != b"\n":
            raise ValueError(f"lines cannot be told apart by bytes in {self.charset}")
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.fail_on_data_loss = options.get("failOnDataLoss", "true").lower() != "false"
        self.max_bytes = int(options.get("maxBytesPerTrigger", 0))
        self.positions = options.get("positions")
        if self.max_bytes and not self.positions:
            raise ValueError("maxBytesPerTrigger needs the option 'positions'")
        self.given = None  # how far each file was given out, by a cap
        self.seen = {}
        self.followed = set()
        self.placed = set()

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        latest = {}
        matching = set(self._files())
        folder = self.path if os.path.isdir(self.path) else os.path.dirname(self.path)
        folders = {os.path.dirname(path) for path in matching} | {folder}
        for path in sorted(matching | set(_siblings(folders))):
            try:
                status = os.stat(path)
                key, size = _key(path, status), status.st_size
                if self.placed and path not in matching and key not in self.followed:
                    continue  # only at the start may it be a file that was followed before
                known_size, known_end, known_head = self.seen.get(key, (0, 0, [0, 0]))
                if size < known_size or not _same_head(path, known_head):
                    known_size = known_end = 0
                end = known_end if size == known_size else _last_line_end(path, known_end, size)
                head = _head(path, min(end, HEAD_BYTES))
            except (FileNotFoundError, PermissionError):
                continue
            self.seen[key] = (size, end, head)
            if path in matching:
                self.followed.add(key)
            follow = key in self.followed
            latest[key] = {"path": path, "end": end, "size": size, "head": head, "follow": follow}
        if self.max_bytes:
            self._cap(latest)
        return latest

    def _cap(self, latest: dict) -> None:
        """Takes back what is beyond the cap, and notes how far each file is given out."""
        if self.given is None:
            self.given = _noted(self.positions)
        waiting = []
        for key, to in latest.items():
            since = self.given.get(key, 0)
            since = since if since <= to["end"] else 0  # else written anew
            if to["follow"] and to["end"] > since:
                waiting.append((to["end"] - since, since, key))
        room = self.max_bytes
        for place, (more, since, key) in enumerate(sorted(waiting)):
            to, share = latest[key], room // (len(waiting) - place)
            if more > share:
                try:
                    end = _last_line_end(to["path"], since, since + share)
                    to["end"] = end if end > since else _first_line_end(to["path"], since)
                    to["head"] = _head(to["path"], min(to["end"], HEAD_BYTES))
                except FileNotFoundError:  # renamed just now: the next poll finds it
                    to["end"] = since
                    to["head"] = [0, 0] if not since else to["head"]
            room = max(0, room - (to["end"] - since))
        given = {key: to["end"] for key, to in latest.items() if to["follow"]}
        if given != self.given:
            _note(self.positions, given)
            self.given = given

    def partitions(self, start: dict, end: dict) -> list[Share]:
        self._check_lost(start, end)
        if self.max_bytes and self.given is None:  # a batch runs again
            self.given = {key: to["end"] for key, to in end.items() if to["follow"]}
        shares, slices, room = [], [], self.split_bytes
        for key, to in sorted(end.items()):
            since = start.get(key, {"end": 0, "follow": False})
            if not (to["follow"] or since["follow"]):
                continue
            # What a file held before it first matched the pattern has not been read.
            first = since["end"] if since["follow"] or key in self.placed else 0
            stop = to["end"]
            if self.max_bytes and stop < first <= to["size"]:
                raise ValueError(f"{self.positions} is not of this checkpoint: run once without a cap")
            self.followed.add(key)
            self.placed.add(key)
            if stop < first or (first and not _same_start(since["head"], to["head"], to["path"])):
                warnings.warn(f"{to['path']} was written anew; reading from its start")
                first = 0
            lo = first
            while lo < stop:
                hi = min(stop, lo + room)
                slices.append((to["path"], key, lo, hi, first))
                room -= hi - lo
                lo = hi
                if room == 0:
                    shares.append(Share(slices))
                    slices, room = [], self.split_bytes
        return shares + [Share(slices)] if slices else shares

    def read(self, partition: Share) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["value", "path"]
        for path, key, lo, hi, first in partition.slices:
            for block in self._blocks(path, key, lo, hi, first):
                text = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
                text = pa.array([text.decode(self.charset, "replace")])
                lines = pc.split_pattern(text, "\n").flatten()
                lines = lines.filter(pc.not_equal(lines, ""))
                if len(lines):
                    yield pa.RecordBatch.from_arrays([lines, pa.repeat(path, len(lines))], names)

    def _check_lost(self, start: dict, end: dict) -> None:
        """A file that is gone must have been read as far as it was seen to reach."""
        for key in start.keys() - end.keys():
            gone = start[key]
            if gone["follow"] and gone["size"] > gone["end"]:
                told = f"{gone['path']} has gone with unread bytes after {gone['end']}"
                if self.fail_on_data_loss:
                    raise OSError(told)
                warnings.warn(told)

    def _files(self) -> list[str]:
        if os.path.isdir(self.path):
            names = [name for name in os.listdir(self.path) if name[0] not in "._"]
            found = [os.path.join(self.path, name) for name in names]
        else:
            found = glob.glob(self.path)
        return [path for path in found if os.path.isfile(path)]

    def _blocks(self, path: str, key: str, lo: int, hi: int, first: int) -> Iterator[bytes]:
        """The lines that start in [lo, hi), some megabytes at a time."""
        with _open(path, key) as file:
            at = lo
            if lo > first:
                file.seek(lo - 1)
                at += len(file.readline()) - 1
            else:
                file.seek(lo)
            while at < hi:
                block = file.read(min(BLOCK_BYTES, hi - at))
                if not block.endswith(b"\n"):
                    block += file.readline()
                if not block.endswith(b"\n"):
                    if self.fail_on_data_loss:
                        raise OSError(f"{path} no longer has the bytes up to {hi}")
                    return
                at += len(block)
                yield block


def _key(path: str, status: os.stat_result) -> str:
    """What stays the same when a file is renamed within its folder."""
    return f"{os.path.dirname(path)}:{status.st_ino}"


def _siblings(folders: set[str]) -> Iterator[str]:
    """All files of the folders: a followed file may have any name there."""
    for folder in folders:
        if os.path.isdir(folder):
            with os.scandir(folder) as entries:
                for entry in entries:
                    if entry.name[0] not in "._" and entry.is_file():
                        yield entry.path


def _head(path: str, size: int) -> list[int]:
    """Size and checksum of the first bytes."""
    with open(path, "rb") as file:
        return [size, zlib.crc32(file.read(size))]


def _same_head(path: str, head: list[int]) -> bool:
    return _head(path, head[0]) == head


def _same_start(before: list[int], now: list[int], path: str) -> bool:
    """Whether the file still begins as it did; it is looked at only if it has grown meanwhile."""
    return before == now or (before[0] < now[0] and _same_head(path, before))


def _open(path: str, key: str):
    """The file itself, also if it was renamed since the batch was planned."""
    for name in [path, *_siblings({os.path.dirname(path)})]:
        try:
            file = open(name, "rb")
        except FileNotFoundError:
            continue
        if _key(path, os.fstat(file.fileno())) == key:
            return file
        file.close()
    raise OSError(f"{path} is no longer in its folder")


def _last_line_end(path: str, start: int, size: int) -> int:
    """Position after the last newline in [start, size), or `start` if there is none."""
    with open(path, "rb") as file:
        end = size
        while end > start:
            begin = max(start, end - BLOCK_BYTES)
            file.seek(begin)
            newline = file.read(end - begin).rfind(b"\n")
            if newline >= 0:
                return begin + newline + 1
            end = begin
    return start


def _first_line_end(path: str, start: int) -> int:
    """Position after the first newline from `start` on."""
    with open(path, "rb") as file:
        file.seek(start)
        return start + len(file.readline())


def _noted(path: str) -> dict[str, int]:
    try:
        with open(path, encoding="utf-8") as file:
            return json.load(file)
    except FileNotFoundError:
        return {}


def _note(path: str, given: dict[str, int]) -> None:
    with open(f"{path}.new", "w", encoding="utf-8") as file:
        json.dump(given, file)
        file.flush()
        os.fsync(file.fileno())
    os.replace(f"{path}.new", path)


def register_tail(spark: SparkSession) -> None:
    """Make `tail_log` known to the session; the class travels to the executors by value."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TailLogSource)
