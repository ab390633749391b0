"""Exact substring deduplication with fixed-block anchors.

Any window of ``window`` words holds a whole one of the non-overlapping ``block``-word reference blocks of its
document (``2 * block <= window + 1``). So of two equal windows the earlier one holds a reference block that
a rolling ``block``-word window of the later one equals. Three steps over the corpus, in chunks of documents:

1. Anchors. Each chunk sends the distinct hashes of its rolling ``block``-word windows, marked where one is a
   reference block, to shards by hash. A hash that is a reference block somewhere and occurs twice is a hit; bitmaps
   of the hits go back to the chunks.
2. Extension. Each chunk extends its hits to all windows of ``window`` words that hold one, and sends the first
   occurrence of each distinct window (96-bit fingerprint) in document order to shards, which mark all
   but the first in the corpus. Bitmaps go back again.
3. Adjacent and overlapping repeated windows unite to maximal repeats, whose words are removed.

What a chunk sends is distinct within it, so a passage that a third of all documents share reaches its shard
once per chunk. Texts are never shuffled, and no pairs of occurrences are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.chunks import buckets_for, stage, texts
from quiver.llm.common import reliable

WINDOW, BLOCK = 20, 10
CHUNK_BYTES = 4 << 20
SHARD_ANCHORS = 2_000_000  # hashes that a shard gets, about
SHARD_WINDOWS = 1_000_000
_WORD_BYTES = 5  # a word and its space take about so many bytes, when the number of shards is chosen
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd
_ALL = (1 << 64) - 1


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Words:
    """The words of a chunk: ``id`` of each word, first word of each document, and rolling hashes."""

    def __init__(self, n_bytes: int, sizes: np.ndarray, packed: bytes):
        body, at = texts(n_bytes, sizes, packed)
        vocabulary, ids, count = _Vocabulary(), [], []
        for s, e in zip(at[:-1].tolist(), at[1:].tolist()):
            own = body[s:e].split()
            ids.append(np.fromiter(map(vocabulary.__getitem__, own), np.uint32, len(own)))
            count.append(len(own))
        self.tie = np.array([xxhash.xxh64_intdigest(body[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())], np.uint64)
        self.words = list(vocabulary)
        self.id = np.concatenate([*ids, np.zeros(0, np.uint32)])
        self.first = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(count)), count)
        self.end = self.first[1:][self.doc] if len(self.doc) else np.zeros(0, np.int64)

    def hashes(self, n: int, seed: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the ``n``-word windows that lie in one document, and a 64-bit hash of each."""
        code = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))[self.id]
        at = np.flatnonzero(np.arange(len(self.id)) + n <= self.end)
        if not len(at):
            return at, np.zeros(0, np.uint64)
        total, off, power = None, 0, 1  # hash of the first ``off`` words of each window, and base ** off
        h, k, step = code, 1, base
        while k <= n:
            if n & k:
                m = len(code) - off - k + 1
                total = h[:m] if total is None else total[:m] + np.uint64(power) * h[off:off + m]
                off, power = off + k, power * step & _ALL
            if 2 * k <= n:
                m = len(code) - 2 * k + 1
                h = h[:m] + np.uint64(step) * h[k:k + m]
            k, step = 2 * k, step * step & _ALL
        return at, _mixed(total[at])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Anchors:
    """The distinct rolling block hashes of a chunk, by shard and value."""

    def __init__(self, w: Words, block: int, shards: int):
        self.at, h = w.hashes(block, 1, _BASES[0])
        shard = (h >> np.uint64(32)) % np.uint64(shards)
        self.key = shard << np.uint64(30) | h & np.uint64((1 << 30) - 1)
        reference = (self.at - w.first[w.doc[self.at]]) % block == 0
        mark = np.sort(self.key << np.uint64(1) | reference.astype(np.uint64))
        key = mark >> np.uint64(1)
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        last = np.concatenate([new[1:], [len(key)]]) - 1 if len(new) else new
        self.distinct = key[new]
        value = (self.distinct & np.uint64((1 << 30) - 1)).astype(np.uint32) << np.uint32(2)
        self.value = value | ((last > new).astype(np.uint32) << np.uint32(1)) | (mark[last] & np.uint64(1)).astype(np.uint32)
        self.cut = np.searchsorted(self.distinct, np.arange(shards + 1, dtype=np.uint64) << np.uint64(30))

    def hits(self, bits: dict[int, bytes]) -> np.ndarray:
        """Word positions at which a hit begins."""
        own = np.zeros(len(self.distinct), bool)
        for s, b in bits.items():
            lo, hi = self.cut[s], self.cut[s + 1]
            own[lo:hi] = np.unpackbits(np.frombuffer(b, np.uint8), count=hi - lo).astype(bool)
        found = self.distinct[own]
        if not len(found):
            return self.at[:0]
        return self.at[found[np.minimum(np.searchsorted(found, self.key), len(found) - 1)] == self.key]


class Windows:
    """The windows that hold a hit: their positions, and the distinct ones in order of their first occurrence."""

    def __init__(self, w: Words, hits: np.ndarray, window: int, block: int, shards: int):
        at, h = w.hashes(window, 1, _BASES[0])
        mark = np.zeros(len(w.id) + 2, np.int64)
        mark[hits + 1] = 1
        seen = np.cumsum(mark)
        own = seen[at + window - block + 1] > seen[at]
        self.at, h = at[own], h[own]
        g = (w.hashes(window, 2, _BASES[1])[1][own] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((g, h))
        new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])]) if len(order) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        first = order[new]  # lexsort is stable, so the earliest position of each group
        by_place = np.argsort(first, kind="stable")
        number = np.empty(len(first), np.int64)
        number[by_place] = np.arange(len(first))
        self.group = np.empty(len(order), np.int64)
        self.group[order] = number[group]
        self.first = first[by_place]
        self.h, self.g = h[self.first], g[self.first]
        self.shard = ((self.h >> np.uint64(44)) % np.uint64(shards)).astype(np.int64)

    def repeated(self, bits: dict[int, bytes]) -> np.ndarray:
        """Positions of the windows whose words start earlier somewhere."""
        late = np.zeros(len(self.first), bool)
        for s, b in bits.items():
            own = np.flatnonzero(self.shard == s)
            late[own] = np.unpackbits(np.frombuffer(b, np.uint8), count=len(own)).astype(bool)
        out = late[self.group]
        again = np.ones(len(self.at), bool)
        again[self.first] = False
        return self.at[out | again]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}


def _bits(rows: list[dict] | None) -> dict[int, bytes]:
    return {r["shard"]: r["bits"] for r in rows or ()}


def _words(r: dict) -> Words:
    return Words(r["n_bytes"], np.array(r["sizes"], np.int64), r["texts"])


def _split(flags: np.ndarray, lengths: list[int]) -> list[bytes]:
    return [np.packbits(x).tobytes() for x in np.split(flags, np.cumsum(lengths)[:-1])]


def _anchor_hits(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's hits: values that are a reference block somewhere and occur twice."""
    own = [np.frombuffer(x, np.uint32) for x in pdf["data"]]
    value = np.concatenate(own)
    key, inv = np.unique(value >> np.uint32(2), return_inverse=True)
    many = np.bincount(inv, weights=1 + (value >> np.uint32(1) & np.uint32(1)), minlength=len(key)) > 1
    reference = np.bincount(inv, weights=value & np.uint32(1), minlength=len(key)) > 0
    return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "bits": _split((many & reference)[inv], [len(x) for x in own])})


def _late_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of each window of a shard, all occurrences but the one in the first document."""
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["h"]])
    g = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["g"]])
    ids = [np.array([x for x in own], object) for own in pdf["doc"]]
    size = [len(x) for x in ids]
    flat = np.concatenate(ids)
    none = np.array([x is None or x != x for x in flat], bool)
    doc = np.array([0 if n else int(x) for x, n in zip(flat, none)], np.int64)
    tie = np.concatenate([np.asarray(x, np.int64) for x in pdf["tie"]])
    chunk = np.repeat(pdf["chunk"].to_numpy(), size)
    place = np.empty(len(doc), np.int64)
    place[np.lexsort((chunk, tie, doc, none))] = np.arange(len(doc))
    rank = np.repeat(place, np.concatenate([np.asarray(x, np.int64) for x in pdf["count"]]))
    order = np.lexsort((rank, g, h))
    late = np.zeros(len(h), bool)
    late[order[1:]] = (h[order][1:] == h[order][:-1]) & (g[order][1:] == g[order][:-1])
    return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "bits": _split(late, [len(x) // 8 for x in pdf["h"]])})


def _gathered(bits: DataFrame, name: str) -> DataFrame:
    """A chunk's bitmaps, at most one per shard, in one row."""
    return bits.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias(name))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK,
                     chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by one
    space) and ``spans`` (``start``, ``end`` of the maximal repeats removed, in words).

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``window`` words that covers it has the same words as
    one that starts earlier: in a document with a smaller id, or earlier in its own; windows are judged on the input.
    Documents with a null id come after all others, rows with one id in the order of a hash of their text; of equal
    rows one counts as the first. A null text has no words. Texts shorter than ``window`` words lose nothing. Other
    columns are not read, whatever their names. An empty table gives an empty result.
    """
    if 2 * block > window + 1:
        raise ValueError("a window must hold a whole reference block: 2 * block <= window + 1")
    chunks = stage(docs, id_col, text_col, chunk_bytes)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    n1 = buckets_for(total // _WORD_BYTES, SHARD_ANCHORS)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            a = Anchors(_words(r), block, n1)
            own = [s for s in range(n1) if a.cut[s] < a.cut[s + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([r["chunk"]] * len(own), pa.int64()),
                                              pa.array([a.value[a.cut[s]:a.cut[s + 1]].tobytes() for s in own], pa.binary())], names=["shard", "chunk", "data"])

    sent = chunks.mapInArrow(anchors, "shard int, chunk long, data binary")
    hits = reliable(_gathered(sent.groupBy("shard").applyInPandas(_anchor_hits, "chunk long, shard int, bits binary"), "hits"), "anchors")
    with_hits = chunks.join(hits, "chunk", "left")
    n2 = buckets_for(total // _WORD_BYTES, SHARD_WINDOWS)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            w = _words(r)
            x = Windows(w, Anchors(w, block, n1).hits(_bits(r["hits"])), window, block, n2)
            place = w.doc[x.at[x.first]]
            rows = []
            for s in np.unique(x.shard).tolist():
                own = x.shard == s
                d, count = np.unique(place[own], return_counts=True)
                rows.append((s, r["chunk"], x.h[own].tobytes(), x.g[own].tobytes(), [r["ids"][i] for i in d], w.tie[d].view(np.int64).tolist(), count.tolist()))
            shape = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("h", pa.binary()), ("g", pa.binary()), ("doc", pa.list_(pa.int64())), ("tie", pa.list_(pa.int64())), ("count", pa.list_(pa.int32()))])
            yield pa.RecordBatch.from_arrays([pa.array([y[k] for y in rows], f.type) for k, f in enumerate(shape)], schema=shape)

    sent = with_hits.mapInArrow(windows, "shard int, chunk long, h binary, g binary, doc array<long>, tie array<long>, count array<int>")
    late = _gathered(sent.groupBy("shard").applyInPandas(_late_windows, "chunk long, shard int, bits binary"), "late")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                           ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for r in _rows(batches):
            w = _words(r)
            x = Windows(w, Anchors(w, block, n1).hits(_bits(r["hits"])), window, block, n2)
            gone = x.repeated(_bits(r["late"]))
            cover = np.zeros(len(w.id) + 1, np.int64)
            np.add.at(cover, gone, 1)
            np.add.at(cover, gone + window, -1)
            stay = np.cumsum(cover)[:-1] == 0
            rows = []
            for i, doc_id in enumerate(r["ids"]):
                lo, hi = int(w.first[i]), int(w.first[i + 1])
                own = stay[lo:hi]
                edge = np.flatnonzero(np.diff(np.concatenate([[1], own, [1]])))
                rows.append((doc_id, hi - lo, int(hi - lo - own.sum()), b" ".join([w.words[k] for k in w.id[lo:hi][own].tolist()]).decode(),
                             [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]))
            yield pa.RecordBatch.from_arrays([pa.array([y[k] for y in rows], f.type) for k, f in enumerate(shape)], schema=shape)

    return with_hits.join(late, "chunk", "left").mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>")
