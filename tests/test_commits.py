"""Batch tables: nothing lost and nothing twice, wherever a writer or a merge is killed."""

import json
import shutil

import pytest

import clickstream as cs
from clickstream.storage import create_new, names
from clickstream.streaming import batches, commits, sinks
from tests.conftest import rows
from tests.test_streaming import NOW, Log, entry, kafka_shaped


@pytest.fixture
def log(spark, tmp_path):
    log = Log(spark, tmp_path / "log")
    for i in range(4):
        log.add(f"bad {i}", entry(i), f"worse {i}")
    return log


def lines(log):
    return sorted(f"{word} {i}" for i in range(log.files) for word in ("bad", "worse"))


def run(log, where, *more, checkpoint="c"):
    cs.run_batches(
        kafka_shaped(log), str(where / checkpoint), cs.quarantine(str(where / "bad")), *more, trigger=NOW
    ).awaitTermination()
    return kept(log, where)


def kept(log, where):
    return [value for value, in rows(cs.batch_table(log.spark, str(where / "bad")), "value")]


class Killed(RuntimeError):
    pass


@pytest.fixture
def kill(monkeypatch):
    """Makes a function fail at its n-th call, before or after it has done its work."""

    def at(module, name, call=1, after=False):
        real, calls = getattr(module, name), []

        def fails(*args, **options):
            calls.append(1)
            if len(calls) == call and not after:
                raise Killed
            result = real(*args, **options)
            if len(calls) == call:
                raise Killed
            return result

        monkeypatch.setattr(module, name, fails)
        return lambda: monkeypatch.setattr(module, name, real)

    return at


@pytest.mark.parametrize(
    "module, name, call, after",
    [
        (batches, "size", 2, False),  # rows are written, not committed
        (commits, "create_new", 1, False),  # not even claimed
        (commits, "create_new", 1, True),  # claimed
        (commits, "create_new", 3, False),
        (commits, "create_new", 3, True),  # committed, not so in the checkpoint
    ],
)
def test_killed_writer(log, tmp_path, kill, module, name, call, after):
    mend = kill(module, name, call, after)
    with pytest.raises(Exception, match="Killed"):
        run(log, tmp_path)
    mend()
    table = cs.batch_table(log.spark, str(tmp_path / "bad"))
    partly = [] if table is None else [r.value for r in table.collect()]
    assert len(set(partly)) == len(partly)
    assert run(log, tmp_path) == lines(log)
    folders = list((tmp_path / "bad" / "data").iterdir())
    assert len(folders) == 4  # what was left is gone
    log.add("bad 4", "worse 4")
    assert run(log, tmp_path) == lines(log)


@pytest.mark.parametrize("after", [False, True])
def test_killed_merge(log, tmp_path, kill, after):
    run(log, tmp_path)
    path, spark = str(tmp_path / "bad"), log.spark
    before = cs.batch_table(spark, path)  # listed before the merge, read after it
    mend = kill(commits, "create_new", 1, after)
    with pytest.raises(Killed):
        cs.compact_table(spark, path)
    mend()
    assert kept(log, tmp_path) == lines(log)
    cs.compact_table(spark, path)
    assert kept(log, tmp_path) == lines(log)
    assert sorted(r.value for r in before.collect()) == lines(log) if not after else True
    state = commits.load(spark, path)
    assert len(state.folders) == 2  # the merge and the last batch
    log.add("bad 4", "worse 4")
    assert run(log, tmp_path) == lines(log)
    cs.compact_table(spark, path)
    cs.compact_table(spark, path)
    state = commits.load(spark, path)
    on_disk = {n.removeprefix("commit_folder=") for n in names(spark, f"{path}/data") if n[0] != "_"}
    assert on_disk == {*state.folders, *state.replaced}
    assert kept(log, tmp_path) == lines(log)


def test_merge_beside_a_writer(log, tmp_path, monkeypatch):
    """Another process commits while a batch is about to: both commits stand."""
    path, spark = str(tmp_path / "bad"), log.spark
    run(log, tmp_path)
    real, merged = batches.size, []

    def merges_first(*args):
        if not merged:
            merged.append(0)
            merged.append(cs.compact_table(spark, path))
        return real(*args)

    log.add("bad 4", "worse 4")
    monkeypatch.setattr(batches, "size", merges_first)
    assert run(log, tmp_path) == lines(log)
    assert merged[1] == 3


def test_full_folders_are_not_written_again(log, tmp_path):
    run(log, tmp_path)
    assert cs.compact_table(log.spark, str(tmp_path / "bad"), target_bytes=1) == 0


@pytest.mark.parametrize("every", [2, 3])
def test_snapshots(log, tmp_path, monkeypatch, every):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", every)
    for i in range(4, 9):
        log.add(f"bad {i}", f"worse {i}")
    assert run(log, tmp_path) == lines(log)
    cs.compact_table(log.spark, str(tmp_path / "bad"))
    assert kept(log, tmp_path) == lines(log)
    files = [n for n in names(log.spark, f"{tmp_path}/bad/_log") if n[0] != "."]
    assert len(files) <= 2 * every + 3


def test_only_one_can_make_a_commit(spark, tmp_path):
    (tmp_path / "x").mkdir()
    assert create_new(spark, f"{tmp_path}/x/1", b"a")
    assert not create_new(spark, f"{tmp_path}/x/1", b"b")
    assert (tmp_path / "x" / "1").read_bytes() == b"a"
    assert [p.name for p in (tmp_path / "x").iterdir() if not p.name.endswith(".crc")] == ["1"]


def test_another_checkpoint_is_refused(log, tmp_path):
    run(log, tmp_path)
    with pytest.raises(ValueError, match="another checkpoint"):
        run(log, tmp_path, checkpoint="other")
    assert kept(log, tmp_path) == lines(log)


@pytest.mark.parametrize("name", ["offsets_path", "malformed_path", "raw_path"])
def test_every_path_of_the_job_is_guarded(log, tmp_path, name):
    paths = {name: str(tmp_path / name)}

    def job(where):
        cs.run_job(
            kafka_shaped(log), str(tmp_path / where / "kpis"), str(tmp_path / where / "c"), trigger=NOW, **paths
        ).awaitTermination()

    job("a")
    with pytest.raises(ValueError, match="another checkpoint"):
        job("b")


def job(log, where, checkpoint, **options):
    query = cs.run_job(
        kafka_shaped(log), str(where / "kpis"), str(where / checkpoint), str(where / "offsets"),
        malformed_path=str(where / "bad"), raw_path=str(where / "raw"), trigger=NOW,
        compact_every=2, **options,
    )
    query.awaitTermination()


def totals(log, where):
    spark = log.spark
    return (
        rows(cs.latest_kpis(spark, str(where / "kpis")), "kpi", "key", "value"),
        kept(log, where),
        rows(cs.batch_table(spark, str(where / "raw")), "openid", "total_money"),
    )


@pytest.mark.parametrize("tables", [0, 1, 2, 3])
def test_hand_over_after_a_batch_that_was_not_recorded(log, tmp_path, kill, tables, monkeypatch):
    """The batch is in some tables when the job is killed and its checkpoint lost."""
    job(log, tmp_path, "c")
    log.add("bad 4", entry(4), "worse 4")
    real, calls = commits.create_new, []

    def fails(spark, path, content):
        if '"add"' in content.decode():
            calls.append(path)
            if len(calls) > tables:
                raise Killed
        return real(spark, path, content)

    if tables < 3:
        monkeypatch.setattr(commits, "create_new", fails)
        with pytest.raises(Exception, match="Killed"):
            job(log, tmp_path, "c")
        monkeypatch.setattr(commits, "create_new", real)
    else:
        job(log, tmp_path, "c")
    shutil.move(tmp_path / "c", tmp_path / "lost")
    recorded = commits.load(log.spark, str(tmp_path / "offsets")).last
    # The new run starts after the files of the recorded batches.
    later = Log(log.spark, tmp_path / "later")
    for i in range(recorded + 1, 7):
        later.add(f"bad {i}", entry(i), f"worse {i}")
    job(later, tmp_path, "new", take_over=True)
    job(later, tmp_path, "new", take_over=True)
    for i in range(5, 7):
        log.add(f"bad {i}", entry(i), f"worse {i}")
    shown = totals(log, tmp_path)
    whole = cs.valid(cs.parse_log(cs.read_lines(log.spark, str(log.folder))))
    assert shown[0] == log.expected()
    assert shown[1] == lines(log)
    assert shown[2] == rows(whole, "openid", "total_money")
    # The old query finds the table taken.
    shutil.move(tmp_path / "lost", tmp_path / "c")
    log.add(entry(9))
    with pytest.raises(Exception, match="another checkpoint"):
        job(log, tmp_path, "c")


def test_state_of_the_query_is_carried_over(log, tmp_path):
    """`run_kpis` has its sums in the checkpoint: the new one starts from what the table holds."""
    for i in range(4, 9):
        log.add(entry(i))
    table = str(tmp_path / "table")

    def kpis(log, checkpoint, **options):
        cs.run_kpis(
            log.stream(), table, str(tmp_path / checkpoint), trigger=NOW, compact_every=2, state_partitions=2, **options
        ).awaitTermination()

    kpis(log, "c")
    later = Log(log.spark, tmp_path / "later")
    for i in range(9, 16):
        later.add(entry(i))
    with pytest.raises(ValueError, match="another checkpoint"):
        kpis(later, "new")
    kpis(later, "new", take_over=True)
    for i in range(9, 16):
        log.add(entry(i))
    assert rows(cs.latest_kpis(log.spark, table), "kpi", "key", "value") == log.expected()


def test_a_fenced_query_cannot_claim(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    monkeypatch.setattr(commits, "query_id", lambda spark: "old")
    commits.claim(spark, path, commits.load(spark, path))
    commits.hand_over(spark, path, 0)
    with pytest.raises(ValueError, match="another checkpoint"):
        commits.claim(spark, path, commits.load(spark, path))
    monkeypatch.setattr(commits, "query_id", lambda spark: "new")
    assert commits.claim(spark, path, commits.load(spark, path)).owner == "new"
    assert sinks.latest_kpis and json.loads((tmp_path / "t" / "_log" / f"{0:012d}").read_text()) == {"owner": "old"}


def test_planned_ranges(spark, tmp_path):
    c = tmp_path / "c"
    (c / "offsets").mkdir(parents=True)
    (c / "sources" / "0").mkdir(parents=True)
    (c / "sources" / "0" / "0").write_bytes(b'\0v1\n{"t":{"0":5,"1":0}}')
    for batch, ends in enumerate(['{"t":{"0":9,"1":0}}', '{"t":{"0":9,"1":4,"2":3},"u":{"0":1}}']):
        (c / "offsets" / str(batch)).write_text(f'v1\n{{"batchWatermarkMs":0}}\n{ends}\n{{"logOffset":3}}')
    found = [rows(cs.consumed_ranges(spark, str(c), batch)) for batch in (0, 1)]
    assert found[0] == [("t", 0, 5, 9), ("t", 1, 0, 0)]
    assert found[1] == [("t", 0, 9, 9), ("t", 1, 0, 4), ("t", 2, 0, 3), ("u", 0, 0, 1)]
    (c / "offsets" / "2").write_text('v1\n{}\n{"logOffset":3}')
    assert cs.consumed_ranges(spark, str(c), 2) is None
