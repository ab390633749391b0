"""Packing of documents into fixed-length token sequences as a cutting-stock problem, solved by column generation.

Whole sequences are cut off each document, then a tail that leaves one of ``CLASSES`` lengths. A pattern says how many
pieces of each length share a sequence, and costs its padding and ``SEQUENCE_COST``. The linear program over patterns and a stream
that use up the length histogram is solved by the revised simplex method, where a knapsack dynamic program prices all
patterns at once. Rounded down, then up while pieces last, the patterns are handed to the
documents by their rank among those of their length. Tails and pieces that no pattern without padding takes lie end to end in one
stream that is cut every ``seq_len`` tokens, its tail into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import prepare, reliable
from quiver.llm.packing import encoder
from quiver.llm.places import places

END_ID = 0
CLASSES = 64  # lengths in the linear program: the multiples of this part of a sequence
SEQUENCE_COST = 1.0  # tokens that a sequence costs beside its padding: among equal paddings, fewer sequences
STREAM_COST = 2.0  # tokens that a sequence of the stream costs, whose pieces are cut
TOLERANCE = 0.01  # tokens that a pattern must gain to enter the linear program
GAP = 0.02  # share of the tokens which the program may leave to the stream
COLUMNS = 8  # patterns that may enter after one pricing
PIVOTS = 200  # pivots a length after which the program's solution is taken as it stands
BROADCAST_ROWS = 1_000_000  # rows (two longs each) of the stream up to which its keys are broadcast
PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
_PLACED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def padding(seq_len: int) -> np.ndarray:
    """The padding of a sequence of 0..seq_len tokens: none at a power of two, else up to ``seq_len``."""
    n = np.arange(seq_len + 1)
    return np.where((n & (n - 1) == 0) & (n > 0), 0, seq_len - n)


def _price(lengths: np.ndarray, values: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray]:
    """For each total, the largest sum of values of pieces that make it exactly, and the last piece taken (-1: none do)."""
    best, last = np.full(seq_len + 1, -np.inf), np.full(seq_len + 1, -1)
    best[0] = 0.0
    upto = np.searchsorted(lengths, np.arange(seq_len + 1), side="right")
    for total in range(int(lengths[0]), seq_len + 1):
        k = upto[total]
        worth = best[total - lengths[:k]] + values[:k]
        j = int(np.argmax(worth))
        if worth[j] > -np.inf:
            best[total], last[total] = worth[j], j
    return best, last


def solve(counts: dict[int, int], seq_len: int) -> list[tuple[dict[int, int], float]]:
    """Patterns ``{length: how many}`` and how often each is used, which may be a fraction, by the linear program.

    A piece may go to the stream at its share of ``STREAM_COST``, so the program starts from the stream alone. It
    ends when no pattern gains ``TOLERANCE``, when the stream holds at most ``GAP`` of the tokens, or after ``PIVOTS`` pivots a
    length; its work does not depend on the number of pieces. What is not listed is streamed."""
    lengths = np.array(sorted(counts))
    demand = np.array([counts[int(x)] for x in lengths], float)
    m, cost = len(lengths), padding(seq_len) + SEQUENCE_COST
    totals = np.unique([seq_len, *(1 << np.arange(seq_len.bit_length()))])
    patterns: list[dict[int, int] | None] = [None] * m
    inverse, used = np.eye(m), demand.copy()
    value, pivots = lengths / seq_len * STREAM_COST, 0
    tokens = float((lengths * demand).sum())
    while sum(lengths[j] * used[j] for j in range(m) if patterns[j] is None) > GAP * tokens:
        best, last = _price(lengths, value, seq_len)
        gains = np.stack([np.where(lengths <= t, best[np.maximum(t - lengths, 0)] + value - cost[t], -np.inf) for t in totals])
        entered = False
        for at in np.argsort(-gains, axis=None)[:COLUMNS]:
            t, j = divmod(int(at), m)
            total = int(totals[t])
            if gains[t, j] <= TOLERANCE:
                break
            pattern, left = {j: 1}, total - int(lengths[j])
            while left:
                k = int(last[left])
                pattern[k] = pattern.get(k, 0) + 1
                left -= int(lengths[k])
            reduced = sum(value[k] * n for k, n in pattern.items()) - cost[total]
            if reduced <= TOLERANCE:  # the values have moved since the pricing
                continue
            column = inverse[:, list(pattern)] @ np.array(list(pattern.values()), float)
            ratio = np.full(m, np.inf)
            up = column > 1e-9
            ratio[up] = used[up] / column[up]
            step = ratio.min()
            tied = np.flatnonzero(ratio <= step + 1e-12)
            r = int(tied[np.argmax(column[tied])])
            value = value - reduced / column[r] * inverse[r]
            used = np.maximum(used - step * column, 0.0)
            used[r] = step
            pivot = inverse[r] / column[r]
            inverse -= np.outer(column, pivot)
            inverse[r] = pivot
            patterns[r] = pattern
            entered, pivots = True, pivots + 1
        if not entered or pivots > PIVOTS * m:
            break
    return [({int(lengths[j]): n for j, n in p.items()}, float(x)) for p, x in zip(patterns, used) if p and x > 1e-9]


def plan(counts: dict[int, int], seq_len: int) -> list[tuple[dict[int, int], int]]:
    """Patterns without padding and how often each is made; together they use no more than ``counts``.

    The program's fractions are rounded down, then up, the largest fraction first, as long as there are pieces."""
    left, out, pad = dict(counts), [], padding(seq_len)
    found = [(p, x) for p, x in solve(left, seq_len) if not pad[sum(k * n for k, n in p.items())]] if left else []
    for down in (True, False):
        for p, x in sorted(found, key=lambda f: -f[1] if down else f[1] // 1 - f[1]):
            times = min(min(left[k] // n for k, n in p.items()), int(x + 1e-6) if down else 1)
            if times:
                out.append((p, times))
                for k, n in p.items():
                    left[k] -= n * times
    return out


def _slots(planned: list[tuple[dict[int, int], int]]) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """``(length, first rank, rank behind, first sequence, pieces in a sequence, offset)``, and the count of sequences."""
    rows, used, sequence = [], {}, 0
    for pattern, times in planned:
        base = 0
        for length in sorted(pattern, reverse=True):
            n, lo = pattern[length], used.get(length, 0)
            rows.append((length, lo, lo + n * times, sequence, n, base))
            used[length] = lo + n * times
            base += n * length
        sequence += times
    return rows, sequence


def _cut(seq_len: int, grain: int, paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(*paths), TaskContext.get().partitionId() << 40
        for b in batches:
            out = {name.split()[0]: [] for name in PIECES.split(", ")}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(enc(text) if text else np.zeros(0, np.uint32), np.uint32(END_ID)).astype("<u4")
                rest = len(ids) % seq_len
                ends = [*range(seq_len, len(ids) + 1, seq_len), *([len(ids) - rest % grain] if rest >= grain else []), *([len(ids)] if rest % grain else [])]
                for at, end in zip([0, *ends], ends):
                    piece = ids[at:end]
                    for name, x in zip(out, (row, doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece.astype(np.int32))):
                        out[name].append(x)
                    row += 1
            kinds = [pa.int64()] * 6 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out.values(), kinds)], names=list(out))

    return run


def stream_bounds(total: int, seq_len: int) -> list[int]:
    """Where the last, incomplete sequence of a stream of ``total`` tokens is cut: into powers of two, the largest first."""
    at, out = total - total % seq_len, []
    for bit in reversed(range(max(seq_len.bit_length(), 1))):
        if (total % seq_len) >> bit & 1:
            out.append(at)
            at += 1 << bit
    return out


def _lay(seq_len: int, total: int, first: int):
    """Pieces of the stream, cut where a sequence ends."""
    tail = stream_bounds(total, seq_len)
    whole = total // seq_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {name: [] for name in (*_PLACED, "ids")}
            for r in b.to_pylist():
                lo, hi = r["at"], r["at"] + r["length"]
                cuts = [lo, *(x for x in range(lo - lo % seq_len + seq_len, min(hi, whole * seq_len + 1), seq_len)), *(x for x in tail if lo < x < hi)]
                cuts = [*sorted({x for x in cuts if x < hi}), hi]
                ids = np.array(r["ids"], "<u4")
                for s, e in zip(cuts, cuts[1:]):
                    k = sum(x <= s for x in tail)
                    begin = tail[k - 1] if k else s - s % seq_len
                    piece = ids[s - lo:e - lo]
                    place = (r["doc_id"], r["start"] + s - lo, e - s, zlib.crc32(piece.tobytes()), r["doc_tokens"], first + (whole + k - 1 if k else s // seq_len), s - begin)
                    for name, x in zip(out, (*place, piece.astype(np.int32))):
                        out[name].append(x)
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out.values(), kinds)], names=list(out))

    return run


def pack_cutting(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 1024, json_path: str | None = None,
                 ranks_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]``.

    Each id of a document, and the closing id 0, lies in one piece. A sequence holds at most ``seq_len`` tokens; all but
    full ones hold a power of two of them, so nothing is padded. A null or empty text is the closing id alone. Null and repeated ids
    keep their rows, and rows that tie in length are interchangeable; long texts are whole sequences and a rest. Other columns are not
    read, whatever their names. An empty table gives no rows. The pieces are written with their ids; only their places are shuffled.
    """
    spark = docs.sparkSession
    prepare(spark)
    paths = (json_path or public_tokenizers.path("byte_bpe_50k.json"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    grain = max(seq_len // CLASSES, 1)
    cut = reliable(src.mapInArrow(_cut(seq_len, grain, paths), PIECES), "cut")
    ids = ["ids"] if with_ids else []
    rest = cut.where(F.col("length") < seq_len)
    counts = {r["length"]: r["count"] for r in rest.where(F.col("length") >= grain).groupBy("length").count().collect()}  # about CLASSES rows
    slots, first = _slots(plan(counts, seq_len))
    narrow = rest.select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.lpad(F.col("length").cast("string"), 10, "0").alias("of"))
    ranked = places(narrow, "of", [F.col("row")], "rank").drop("of")
    table = spark.createDataFrame(slots, "_length long, _lo long, _hi long, _first long, _each long, _base long")  # bounded: a few patterns a length
    hit = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_lo")) & (F.col("rank") < F.col("_hi"))
    nth = F.col("rank") - F.col("_lo")
    ranked = ranked.join(F.broadcast(table), hit, "left").withColumns({
        "sequence_id": F.expr("_first + (rank - _lo) div _each"), "offset": F.col("_base") + nth % F.col("_each") * F.col("length")})
    ranked = reliable(ranked.drop("rank", "_length", "_lo", "_hi", "_first", "_each", "_base"), "ranked")
    loose = ranked.where("sequence_id is null")
    loose = places(loose.select("row", "length", F.lit("").alias("of")), "of", [F.col("length").desc(), F.col("row")], "at", weight="length").select("row", "at")
    n, total = ranked.where("sequence_id is null").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    stream = rest.join(F.broadcast(loose) if n <= BROADCAST_ROWS else loose, "row").select("doc_id", "start", "length", "doc_tokens", "at", "ids")
    laid = stream.mapInArrow(_lay(seq_len, total, first), ", ".join(f"{c} long" for c in _PLACED) + ", ids array<int>").select(*_PLACED, *ids)
    planned = ranked.where("sequence_id is not null")
    if with_ids:
        planned = planned.join(rest.select("row", "ids"), "row")
    beyond = first + total // seq_len + seq_len.bit_length()
    full = cut.where(F.col("length") == seq_len).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") + beyond).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *ids)
    return full.unionByName(planned.select(*_PLACED, *ids)).unionByName(laid)
