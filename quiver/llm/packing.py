"""Best-two-fit packing of documents into fixed-length token sequences.

Bins are planned on the histogram of piece lengths, which has at most ``seq_len`` entries whatever the
corpus: a bin is filled greedily with the longest pieces that fit, then its smallest piece is replaced by
two unpacked ones that fill the expanded gap more tightly, for as long as such a pair exists. The same bin
is made as often as the counts allow before the next one is planned. Pieces then get their place by their
rank among the pieces of their length, which Spark counts in lanes, so no length is gathered in one task.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quiver.llm.common import prepare, reliable

END_ID = 0
LANE_ROWS = 1_000  # pieces of one length that are ranked together, about
_ENCODERS: dict = {}


class Encoder:
    """Ids of the byte-level BPE in ``json_path``.

    ``ranks_path`` holds the same vocabulary as merge ranks, which tiktoken applies to the same split
    several times faster; the ids are equal for every code point (tests/llm/test_packing.py). Texts on
    which its splitter gives up go to the tokenizers library."""

    def __init__(self, json_path: str, ranks_path: str):
        self.slow = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(json_path: str, ranks_path: str) -> Encoder:
    key = (json_path, ranks_path)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048,
           json_path: str | None = None, ranks_path: str | None = None, with_ids: bool = False, along: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the ids of each text and a closing id 0, cut into
    ``seq_len``-token pieces where longer, the first of which takes the remainder. Whole-number columns ``along``
    go with each piece, as ``_0``, ``_1`` and so on."""
    paths = (json_path or public_tokenizers.path("byte_bpe_50k.json"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(*paths)
        for b in batches:
            row, piece, start, length, crc, out = [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = np.append(enc(text) if text else np.zeros(0, np.uint32), np.uint32(END_ID)).astype("<u4")
                raw, cut = memoryview(ids).cast("B"), [0, *range(len(ids) % seq_len or seq_len, len(ids) + 1, seq_len)]
                for k, (s, e) in enumerate(zip(cut, cut[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(raw[4 * s:4 * e]))
                    if with_ids:
                        out.append(ids[s:e].astype(np.int32))
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(out, pa.list_(pa.int32())))
                names.append("ids")
            for k in range(len(along)):
                cols.append(b.column(2 + k).take(pa.array(row, pa.int64())))
                names.append(f"_{k}")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *[F.col(c).cast("long").alias(f"_{k}") for k, c in enumerate(along)])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return src.mapInArrow(run, schema + "".join(f", _{k} long" for k in range(len(along))))


def _best_pair(avail: np.ndarray, room: int, above: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum in (above, room]."""
    have = np.flatnonzero(avail[: room])
    if not len(have):
        return None
    other = np.searchsorted(have, room - have, side="right") - 1  # the longest that still fits beside
    ok = other >= 0
    a, b = have[ok], have[other[ok]]
    twin = (a == b) & (avail[a] < 2)
    lower = other[ok] - 1
    b = np.where(twin & (lower >= 0), have[np.maximum(lower, 0)], b)
    total = np.where(twin & (lower < 0), -1, a + b)
    if not len(total) or total.max() <= above:
        return None
    k = int(np.argmax(total))
    return int(a[k]), int(b[k])


def plan_bins(counts: dict[int, int], seq_len: int) -> list[tuple[dict[int, int], int]]:
    """Bins as ``({length: how many}, how often)`` that use up ``counts`` of lengths 1..seq_len."""
    left = np.zeros(seq_len + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        avail, bin_, gap = left.copy(), {}, seq_len
        while gap and len(fit := np.flatnonzero(avail[: gap + 1])):
            length = int(fit[-1])
            n = int(min(avail[length], gap // length))
            bin_[length] = bin_.get(length, 0) + n
            avail[length] -= n
            gap -= n * length
        while gap:
            small = min(bin_)
            pair = _best_pair(avail, gap + small, small)
            if pair is None:
                break
            bin_[small] -= 1
            avail[small] += 1
            if not bin_[small]:
                del bin_[small]
            for length in pair:
                bin_[length] = bin_.get(length, 0) + 1
                avail[length] -= 1
            gap += small - sum(pair)
        times = min(int(left[length]) // n for length, n in bin_.items())
        for length, n in bin_.items():
            left[length] -= n * times
        plan.append((bin_, times))
    return plan


def _slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, rank behind, first sequence, pieces in a sequence, offset)`` of each length of each bin."""
    out, used, sequence = [], {}, 0
    for bin_, times in plan:
        base = 0
        for length in sorted(bin_, reverse=True):
            n, lo = bin_[length], used.get(length, 0)
            out.append((length, lo, lo + n * times, sequence, n, base))
            used[length] = lo + n * times
            base += n * length
        sequence += times
    return out


def place(cut: DataFrame, seq_len: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``cut``, a written table of pieces with a ``length`` in 1..seq_len."""
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most seq_len rows
    slots = _slots(plan_bins(counts, seq_len))
    lanes = spark.createDataFrame([(length, -(-n // LANE_ROWS)) for length, n in counts.items()], "length long, _lanes long")
    laned = cut.join(F.broadcast(lanes), "length").withColumn("_lane", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_lanes"))).drop("_lanes")
    per = laned.groupBy("length", "_lane").agg(F.count("*").alias("_n"))
    before = per.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "_lane", F.coalesce("_before", F.lit(0)).alias("_before"))
    ranked = laned.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_lane").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(before, ["length", "_lane"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    # bounded by seq_len: a bin holds at most 2 * sqrt(seq_len) lengths, and each bin uses up a length or leaves fewer than fit once
    table = spark.createDataFrame(slots, "_length long, _lo long, _hi long, _first long, _each long, _base long")
    hit = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    nth = F.col("_rank") - F.col("_lo")
    return (ranked.join(F.broadcast(table), hit)
            .withColumn("sequence_id", (F.col("_first") + F.floor(nth / F.col("_each"))).cast("long"))
            .withColumn("offset", (F.col("_base") + F.pmod(nth, F.col("_each")) * F.col("length")).cast("long"))
            .drop("_lane", "_rank", "_before", "_length", "_lo", "_hi", "_first", "_each", "_base"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048, json_path: str | None = None,
         ranks_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    A null or empty text is one piece with the closing id alone. Null and repeated ids keep their rows
    (equal pieces are interchangeable); other columns are not read, whatever their names. An empty table
    gives an empty result. Ties among equal lengths go by (doc_id, piece).
    """
    prepare(docs.sparkSession)
    return place(reliable(pieces(docs, id_col, text_col, seq_len, json_path, ranks_path, with_ids), "pieces"), seq_len)


def _place_group(t: pa.Table, seq_len: int) -> pa.Table:
    """Sequence and offset of the pieces of one group; sequences are numbered by their earliest piece."""
    t = t.sort_by([(c, "ascending") for c in ("_1", "_2", "doc_id", "piece", "ids_crc32")])
    length = t.column("length").to_numpy()
    by_length = np.argsort(length, kind="stable")
    have, first, n = np.unique(length[by_length], return_index=True, return_counts=True)
    at = dict(zip(have.tolist(), first.tolist()))
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    for size, lo, hi, seq, each, base in _slots(plan_bins(dict(zip(have.tolist(), n.tolist())), seq_len)):
        rows, nth = by_length[at[size] + lo:at[size] + hi], np.arange(hi - lo)
        sequence[rows] = seq + nth // each
        offset[rows] = base + nth % each * size
    _, earliest, number = np.unique(sequence, return_index=True, return_inverse=True)
    sequence = np.argsort(np.argsort(earliest))[number]
    return t.drop_columns(["_1", "_2"]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))


def pack_mixture(docs: DataFrame, group_col: str, order_cols: tuple[str, str], id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048,
                 json_path: str | None = None, ranks_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Like :func:`pack`, with the sequences in the order of a mixture.

    Each group of ``group_col``, a number of bounded size such as a period of the schedule, is packed by
    itself, so a sequence holds pieces of one group, and groups follow one another. Pieces of a length go by ``order_cols``,
    the sequences of a group by their earliest piece.
    """
    prepare(docs.sparkSession)
    cut = reliable(pieces(docs, id_col, text_col, seq_len, json_path, ranks_path, with_ids, (group_col, *order_cols)), "pieces")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    placed = cut.groupBy("_0").applyInArrow(lambda t: _place_group(t, seq_len), schema + ", _0 long, sequence_id long, offset long")
    placed = reliable(placed, "placed")
    per = placed.groupBy("_0").agg((F.max("sequence_id") + 1).alias("_n"))
    before = per.select(F.col("_0").alias("_group"), F.coalesce(F.sum("_n").over(Window.orderBy("_0").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(before), F.col("_0") == F.col("_group"))
            .withColumn("sequence_id", F.col("sequence_id") + F.col("_before")).drop("_0", "_group", "_before"))
