"""The place of each row in its group, for groups of any size.

A window over a group would gather a hot group in one task. Here the rows are range-partitioned by a distributed
sort, each task counts the rows of a group as they pass, and a group that began in an earlier partition
is shifted by what lies there: one number per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import reliable


def _count(group: str, weight: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            key = b.column(group)
            starts = np.flatnonzero(np.concatenate([[key[0].as_py() != last], pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)]))
            steps = b.column(weight).to_numpy(zero_copy_only=False).astype(np.int64) if weight else np.ones(n, np.int64)
            ends = np.cumsum(steps)
            begins = ends - steps
            base = np.full(n, -seen)  # what the place of a row is counted from
            lead = int(starts[0]) if len(starts) else n
            base[lead:] = np.repeat(begins[starts], np.diff(np.concatenate([starts, [n]])))
            last, seen = key[n - 1].as_py(), int(ends[-1] - base[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(begins - base), pa.array(ends - base)],
                                             names=[*b.schema.names, "_part", "_place", "_end"])

    return run


def places(df: DataFrame, group: str, order: list[Column], name: str = "pos", weight: str | None = None) -> DataFrame:
    """Adds the long column ``name``: the place, from 0, of a row among those of its ``group`` (a string, not null) in ``order``.

    With ``weight`` (a long column, not null nor below 0) it is the sum of the weights before the row instead of their count.
    Rows that tie in ``order`` follow one another in any order; the result is a written table, so it stays as it fell.
    ``df`` is read twice (the sort looks for its bounds first): write it before if it is dear."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    told = reliable(df.orderBy(group, *order).mapInArrow(_count(group, weight), f"{schema}, _part int, _place long, _end long"), "places")
    ends = told.groupBy("_part").agg(F.min(group).alias("first"), F.max(F.struct(group, "_end")).alias("last")).orderBy("_part").collect()  # one row per partition
    carried, open_group, length = [], None, 0
    for r in ends:
        before = length if r["first"] == open_group else 0
        carried.append((r["_part"], r["first"], before))
        open_group, n = r["last"]
        length = n + (before if open_group == r["first"] else 0)
    shift = df.sparkSession.createDataFrame(carried, "_of int, _first string, _before long")
    own = (F.col("_part") == F.col("_of")) & (F.col(group) == F.col("_first"))
    return told.join(F.broadcast(shift), own, "left").withColumn(name, F.col("_place") + F.coalesce("_before", F.lit(0))).drop("_part", "_place", "_end", "_of", "_first", "_before")
