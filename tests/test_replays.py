"""Interval sets of offsets, and the operator that keeps them as state."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import clickstream as cs
from clickstream.operators import replays
from tests.conftest import rows

NOW = {"availableNow": True}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 60), max_size=30), max_size=6))
def test_interval_sets(batches):
    starts = ends = np.zeros(0, np.int64)
    seen = set()
    for batch in batches:
        offsets = np.array(batch, np.int64)
        new = replays._new(offsets, starts, ends)
        expected = []
        for offset in batch:
            expected.append(offset not in seen)
            seen.add(offset)
        assert new.tolist() == expected
        starts, ends = replays._joined(offsets[new], starts, ends)
        assert {o for a, b in zip(starts, ends) for o in range(a, b)} == seen
        # As few intervals as there are gaps.
        assert len(starts) == sum(o - 1 not in seen for o in seen)


def stream(spark, folder, batches):
    """Each list of (topic, partition, offset, value) is a file and a batch."""
    schema = "topic string, partition int, offset bigint, value string"
    for n, batch in enumerate(batches):
        path = folder / f"{n:03d}.parquet"
        if not path.exists():
            spark.createDataFrame(batch, schema).toPandas().astype({"offset": "Int64", "partition": "Int32"}).to_parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run(spark, df, where, **options):
    query = (
        cs.drop_replayed(df, **options).writeStream.format("parquet").option("path", str(where / "out"))
        .option("checkpointLocation", str(where / "c")).trigger(**NOW).start()
    )
    query.awaitTermination()
    found = spark.read.schema(df.schema).parquet(str(where / "out"))
    return rows(found), query.lastProgress["stateOperators"][0]["numRowsTotal"]


@pytest.mark.parametrize("shares", [1, 3])
def test_records_delivered_again(spark, tmp_path, shares):
    records = [("t", i % 2, i // 2, f"v{i}") for i in range(6000)]
    batches = [records[:3000], records[2000:4500], records[:100] + records[4000:], records, records[5:6] * 3]
    (tmp_path / "in").mkdir()
    got, state = run(spark, stream(spark, tmp_path / "in", batches), tmp_path, shares=shares)
    assert got == sorted(records, key=repr)
    assert state == 2 * shares
    # A restart knows them too.
    again, state = run(spark, stream(spark, tmp_path / "in", [*batches, records[:10] + [("t", 0, 9999, "n")]]), tmp_path, shares=shares)
    assert Counter(again) - Counter(got) == Counter([("t", 0, 9999, "n")])


def test_state_grows_with_gaps(spark):
    class State:
        exists, value = False, None

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

    import pandas as pd

    state = State()
    for day in range(5):
        offsets = [o for o in range(day * 1000, (day + 2) * 1000) if o % 500]
        part = pd.DataFrame({"offset": offsets, "_share": 0, "_place": offsets})
        list(replays._kept(("t", 0, 0), iter([part]), state))
    assert len(state.value[0]) == len([o for o in range(6000) if o % 500 == 0])


def test_odd_records(spark, tmp_path):
    batch = [(None, None, None, "a"), (None, None, None, "b"), ("t", 0, -5, "c"), ("t", 0, -5, "d"), ("t", 0, 1 << 60, "e")]
    schema = "topic string, partition int, offset bigint, value string"
    df = spark.createDataFrame(batch, schema)
    assert cs.drop_replayed(df).count() == 3
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    got, _ = run(spark, spark.readStream.schema(schema).parquet(str(tmp_path / "in")), tmp_path)
    assert len(got) == 3
