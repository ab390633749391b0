"""Documents packed into chunks of bounded size, written once and joined per chunk without a shuffle of texts.

A chunk is one row: the ids of its documents and their compressed texts. The table is bucketed by chunk, so
what a shuffle brings back for a chunk (bitmaps, tables of values) meets it in place. A document's
chunk is fixed by what was written, so a task that runs again after a lost executor sees the same chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import bucketed, prepare, shuffle_partitions

SCHEMA = "chunk long, n_bytes long, ids array<long>, tags array<string>, sizes array<long>, texts binary"


def stage(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int, tag_col: str | None = None) -> DataFrame:
    """Chunks of about ``chunk_bytes`` of text (a longer text is a chunk by itself); a null text counts as empty.

    Within a chunk documents follow one another by id (null last), then text."""
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), (F.col(tag_col).cast("string") if tag_col else F.lit(None).cast("string")).alias("tag"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            held.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
            body = b"".join(r[2] for r in held)
            cols = [pa.array([number], pa.int64()), pa.array([len(body)], pa.int64()), pa.array([[r[0] for r in held]], pa.list_(pa.int64())),
                    pa.array([[r[1] for r in held]], pa.list_(pa.string())), pa.array([[len(r[2]) for r in held]], pa.list_(pa.int64())),
                    pa.array([_pack(body)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["chunk", "n_bytes", "ids", "tags", "sizes", "texts"])

        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if held and size + len(row[2]) > chunk_bytes:
                    yield out()
                    number, held, size = number + 1, [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield out()

    packed = src.mapInArrow(run, SCHEMA)
    return bucketed(packed, shuffle_partitions(spark), "chunk", "chunks")


def _pack(body: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(body, asbytes=True)


def texts(n_bytes: int, sizes: np.ndarray, packed: bytes) -> tuple[bytes, np.ndarray]:
    """The joined texts of a chunk and where each begins, with the end of the last."""
    return pa.Codec("zstd").decompress(packed, n_bytes, asbytes=True), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def buckets_for(items: int, each: int) -> int:
    """How many shards hold ``items`` at about ``each``."""
    return max(1, -(-items // each))
