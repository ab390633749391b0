"""Quality by the perplexity of an interpolated modified Kneser-Ney n-gram model.

The model is over UTF-8 bytes, with marks before and behind each text, and is trained on trusted documents, all of them but the held-out ones.
Counts, discounts, interpolation weights and probabilities are tables that joins by n-gram and by context
combine, shard by shard, from the lowest order up; n-grams that training never saw get the interpolated
rest of their longest seen context. Each chunk of documents gets the probabilities of its own distinct
n-grams back and sums them per document. One trusted document in five is held out of the training: a
document is kept if its perplexity is at most ``SLACK`` times its language's quantile of the held-out perplexities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.chunks import stage, texts
from quiver.llm.common import reliable

ORDER = 4
QUANTILE = 0.99
SLACK = 1.5  # clean documents of other kinds than the trusted ones stay
HELD_OUT = 5  # one trusted document in so many, by a hash of its id
CHUNK_BYTES = 8 << 20
SYMBOLS = 255  # 254 byte values that text, or a mark behind it, can have, rounded up: the uniform distribution below order one
_START, _END = b"\xff", b"\xfe"  # never part of UTF-8
_SLICE = 1 << 20


def _grams(body: bytes, order: int) -> Iterator[np.ndarray]:
    """Keys of the n-grams of marked texts, slice by slice; those that predict a start mark are left out."""
    a = np.frombuffer(body, np.uint8)
    kind = np.uint32 if order <= 4 else np.uint64
    for at in range(0, max(0, len(a) - order + 1), _SLICE):
        b = a[at:at + _SLICE + order - 1]
        key = np.zeros(len(b) - order + 1, kind)
        for j in range(order):
            key = key << kind(8) | b[j:len(b) - order + 1 + j]
        yield key[b[order - 1:] != _START[0]]


def _marked(docs: list[bytes], order: int) -> bytes:
    pad = _START * (order - 1)
    return b"".join(pad + d + _END for d in docs)


def _groups(docs: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about a slice together; a longer document is a range by itself."""
    at = size = 0
    for i, d in enumerate(docs):
        if i > at and size + len(d) > _SLICE:
            yield at, i
            at, size = i, 0
        size += len(d)
    if docs:
        yield at, len(docs)


def _distinct(docs: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts."""
    key, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for lo, hi in _groups(docs):
        for g in _grams(_marked(docs[lo:hi], order), order):
            k, c = np.unique(g, return_counts=True)
            both, inv = np.unique(np.concatenate([key, k.astype(np.uint64)]), return_inverse=True)
            n = np.bincount(inv, weights=np.concatenate([n, c]), minlength=len(both)).astype(np.int64)
            key = both
    return key, n


def _log_likelihoods(docs: list[bytes], order: int, gram: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """Each document's sum of ``lp``, the log probabilities of the sorted n-grams ``gram``."""
    out = np.zeros(len(docs))
    for lo, hi in _groups(docs):
        each = (lp[np.searchsorted(gram, g)] for g in _grams(_marked(docs[lo:hi], order), order))
        if hi - lo == 1:  # of any length: slice by slice
            out[lo] = sum(float(x.sum()) for x in each)
        else:
            start = np.cumsum([0, *(len(d) + 1 for d in docs[lo:hi - 1])])
            out[lo:hi] = np.add.reduceat(np.concatenate(list(each)), start)
    return out


def _docs(r: dict) -> list[bytes]:
    body, at = texts(r["n_bytes"], np.array(r["sizes"], np.int64), r["texts"])
    return [body[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ from the numbers of n-grams with count one to four; 0.5, 1 and 1.5 where a formula has no value."""
    n = counts.agg(*[F.sum((F.col("c") == i).cast("long")) for i in range(1, 5)]).first()
    n = [x or 0 for x in n]
    out = [0.5, 1.0, 1.5]
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        for i in range(3):
            d = i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.0
            out[i] = d if 0 < d < i + 1 else out[i]
    return out


def _probabilities(wanted: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """``(gram, p)`` for the n-grams ``wanted(gram)`` from the training ``counts(gram, c)`` of the highest order."""
    tables = {order: reliable(counts, "counts")}
    for k in range(order - 1, 0, -1):  # in how many ways an n-gram is continued to the left
        low = tables[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).agg(F.count("*").alias("c"))
        tables[k] = reliable(low, "counts")
    below = None
    for k in range(1, order + 1):
        t, (d1, d2, d3) = tables[k], _discounts(tables[k])
        c = F.col("c")
        context = F.shiftright("gram", 8)
        off = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        ctx = t.groupBy(context.alias("ctx")).agg(F.sum("c").alias("total"), F.sum(off).alias("rest"))
        seen = t.join(ctx, context == F.col("ctx")).select(F.col("gram").alias("g"), (F.greatest(c - off, F.lit(0.0)) / F.col("total")).alias("alpha"))
        want = wanted.select(F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).distinct()
        want = want.join(seen, F.col("gram") == F.col("g"), "left").drop("g")
        ctx = ctx.select("ctx", (F.col("rest") / F.col("total")).alias("gamma"))
        want = want.join(ctx, context == F.col("ctx"), "left")
        if below is None:
            want = want.withColumn("q", F.lit(1.0 / SYMBOLS))
        else:
            short = below.select(F.col("gram").alias("s"), F.col("p").alias("q"))
            want = want.join(short, F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)) == F.col("s"))
        p = F.coalesce("alpha", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("q")
        below = want.select("gram", p.alias("p"))
    return below


def perplexities(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``lang``, ``held_out``, ``n_symbols``, ``perplexity``.

    ``trusted`` holds the ids of the trusted documents in a column ``id_col``; ``held_out`` marks those not trained on. ``n_symbols`` counts the bytes and the
    closing mark. A null text counts as empty, a null id is never trusted; rows with one id are trusted
    together and repeated rows count as often as they occur. Without trusted texts every symbol is uniform."""
    if not 2 <= order <= 7:
        raise ValueError("2 <= order <= 7: an n-gram is a key of eight bytes")
    chunks = stage(docs, id_col, text_col, chunk_bytes, lang_col)
    ids = trusted.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    held = F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)) == 0
    members = chunks.select("chunk", F.posexplode("ids").alias("at", "id")).join(ids, "id", "left_semi")
    members = members.groupBy("chunk").agg(F.collect_list(F.when(~held, F.col("at"))).alias("own"), F.collect_list(F.when(held, F.col("at"))).alias("held"))
    members = reliable(members, "trusted")
    marked = chunks.join(members, "chunk", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}
                own, all_ = set(r["own"] or ()), _docs(r)
                known = [d for k, d in enumerate(all_) if k in own]
                key, n = _distinct(known, order)
                other, _ = _distinct([d for k, d in enumerate(all_) if k not in own], order)
                both = np.union1d(key, other)
                c = np.zeros(len(both), np.int64)
                c[np.searchsorted(both, key)] = n
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(both), r["chunk"], np.int64)), pa.array(both.astype(np.int64)), pa.array(c)], names=["chunk", "gram", "c"])

    grams = reliable(marked.mapInArrow(count, "chunk long, gram long, c long"), "grams")
    counts = grams.groupBy("gram").agg(F.sum("c").alias("c"))
    p = _probabilities(counts.select("gram"), counts.where("c > 0"), order)
    back = grams.select("chunk", "gram").join(p.select(F.col("gram").alias("g"), F.log("p").alias("lp")), F.col("gram") == F.col("g"))
    back = back.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("gram", "lp"))).alias("lp"))
    back = back.select("chunk", F.col("lp.gram").alias("gram"), F.col("lp.lp").alias("lp"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names) if name not in ("gram", "lp")}
                gram = b.column(b.schema.get_field_index("gram"))[i].values.to_numpy().astype(np.uint64)
                lp = b.column(b.schema.get_field_index("lp"))[i].values.to_numpy()
                gram = gram.astype(np.uint32) if order <= 4 else gram
                all_, held = _docs(r), set(r["held"] or ())
                n = np.array([len(d) + 1 for d in all_], np.int64)
                total = _log_likelihoods(all_, order, gram, lp)
                cols = [pa.array(r["ids"], pa.int64()), pa.array(r["tags"], pa.string()), pa.array([k in held for k in range(len(n))]), pa.array(n), pa.array(np.exp(-total / n))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang", "held_out", "n_symbols", "perplexity"])

    return marked.join(back, "chunk").mapInArrow(score, "doc_id long, lang string, held_out boolean, n_symbols long, perplexity double")


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            order: int = ORDER, quantile: float = QUANTILE, slack: float = SLACK,
            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """:func:`perplexities` with ``threshold``, ``slack`` times the ``quantile`` of the held-out documents of the language, and ``kept``.

    A null language is a language of its own; one without held-out documents has no threshold and keeps all. A
    perplexity equal to the threshold is kept. Other columns are not read, whatever their names. An empty
    table gives an empty result."""
    scored = reliable(perplexities(docs, trusted, id_col, text_col, lang_col, order, chunk_bytes), "perplexity")
    limit = scored.where("held_out").groupBy(F.col("lang").alias("l")).agg((F.percentile_approx("perplexity", quantile, 10_000) * slack).alias("threshold"))
    out = scored.join(limit, F.col("lang").eqNullSafe(F.col("l")), "left").drop("l")
    return out.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def trusted_ids(labels: DataFrame, good: Column, id_col: str = "doc_id") -> DataFrame:
    """Ids all of whose labels satisfy ``good``."""
    return labels.groupBy(id_col).agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("__good")).where("__good = 1").select(id_col)
