"""Records that are delivered again, told by which offsets have been seen at all.

The offsets of a partition come nearly without gaps, so what has been seen of them is a few intervals,
however long the stream runs. The state of a share of a partition is that list, and nothing expires.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUN = 1024  # consecutive offsets that stay in one share
STATE = "starts array<bigint>, ends array<bigint>"


def _new(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each offset is in no interval and not equal to an earlier one of the array."""
    at = np.searchsorted(starts, offsets, "right") - 1
    seen = (at >= 0) & (offsets < np.append(ends, 0)[at])
    first = np.zeros(len(offsets), bool)
    first[np.unique(offsets, return_index=True)[1]] = True
    return first & ~seen


def _joined(
    offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The intervals, each without its end, that cover what the given ones and the offsets do."""
    starts, ends = np.concatenate([starts, offsets]), np.concatenate([ends, offsets + 1])
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    opens = np.append(True, starts[1:] > reach[:-1])[: len(starts)]
    closes = np.append(opens[1:], True)[: len(starts)]
    return starts[opens], reach[closes]


def _kept(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    starts, ends = (
        (np.array(values, np.int64) for values in state.get)
        if state.exists
        else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    )
    for part in parts:
        places = part["_place"].to_numpy()
        new = _new(places, starts, ends)
        starts, ends = _joined(places[new], starts, ends)
        if new.any():
            yield part[new].drop(columns=["_share", "_place"])
    state.update((starts.tolist(), ends.tolist()))


def drop_replayed(df: DataFrame, shares: int = 8) -> DataFrame:
    """One row per topic, partition and offset, for all time, on a stream or in batch.

    A record that was seen before goes, whether it comes again after a second or a year, as does
    one that comes twice in a batch. The state of a stream has a row for each topic, partition and
    share, which grows with the gaps between the offsets seen, not with the records. `shares`
    spreads a partition over so many tasks, in runs of consecutive offsets; it is part of the state
    and stays as it was when the checkpoint was new. Null topics, partitions or offsets count as
    values; a null offset is kept once per partition.
    """
    keys = ["topic", "partition", "offset"]
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package
    offset = F.coalesce(F.col("offset").cast("long"), F.lit(-1).cast("long"))
    run = F.floor(offset / RUN)
    # Within a share its runs follow each other without gaps.
    place = F.floor(run / shares) * RUN + F.pmod(offset, F.lit(RUN))
    placed = df.withColumn("_share", F.pmod(run, F.lit(shares)).cast("int"))
    placed = placed.withColumn("_place", place.cast("long"))
    return placed.groupBy("topic", "partition", "_share").applyInPandasWithState(
        _kept, df.schema, STATE, "append", GroupStateTimeout.NoTimeout
    )
