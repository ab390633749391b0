"""SimHash near-duplicates with pigeonring filtering.

A document's 64-bit fingerprint sums the bits of its shingle hashes. Two fingerprints within
``max_bits`` differing bits are linked. With ``m = max_bits + 1`` segments on a ring, every linked pair
has a start segment from which each chain of ``l`` consecutive segments differs in at most
``floor(l * max_bits / m)`` bits: none in the first, at most one in the first two, and so on. The first two
budgets make the key (the first segment and one half of the second, equal); the longer chains are
checked before the full Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiver.llm.common import components, local_stars, prepare, reliable

SEED = 42
GROUP_CAP = 2048  # fingerprints of a key compared in one go; larger keys are split further, without loss
FREE_BITS = 11  # bits outside a key that are not split: at most 2 ** 11 fingerprints share it
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, words between ASCII white space, XXH64 (seed 42) of each shingle."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = end[shingle - 1:] if len(words) >= shingle else end[-1:]
    total = np.zeros(64, np.int64)
    step = 1 << 16
    for k in range(0, n, step):
        s, e = start[k:min(n, k + step)].tolist(), last[k:k + step].tolist()
        h = np.fromiter((xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(s, e)), np.uint64, len(s))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (total * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _row_keys(id_col: str, text_col: str) -> list[Column]:
    """Two hashes that name a row by its id and text; rows equal in both are interchangeable."""
    own = [F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))]
    return [F.xxhash64(*own).alias("__sim_a"), F.hash(*own).alias("__sim_b")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp, row key)`` for every row of ``docs``; ``fp`` is the fingerprint as a signed long. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x, shingle) for x in b.column(1).cast(pa.binary()).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2), b.column(3)], names=["doc_id", "fp", "__sim_a", "__sim_b"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *_row_keys(id_col, text_col))
    return src.mapInArrow(run, "doc_id long, fp long, __sim_a long, __sim_b int")


def _widths(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ``max_bits + 1`` segments."""
    m = max_bits + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def pigeonring(x: np.ndarray, start: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether the chains of the XORs ``x`` from segment ``start`` keep all proportional budgets, the last
    of which is the full Hamming distance."""
    seg = _widths(max_bits)
    m = len(seg)
    count = np.stack([_popcount((x >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in seg], axis=1)
    ok, cum = np.ones(len(x), bool), np.zeros(len(x), np.int64)
    for length in range(1, m + 1):
        cum += count[np.arange(len(x)), (start + length - 1) % m]
        ok &= cum <= length * max_bits // m
    return ok


def _keys(max_bits: int):
    """Key masks: for each start segment, the segment and either half of the next one."""
    seg = _widths(max_bits)
    out = []
    for i, (s, w) in enumerate(seg):
        mask = ((1 << w) - 1) << s
        if max_bits:
            ns, nw = seg[(i + 1) % len(seg)]
            lo = ((1 << (nw // 2)) - 1) << ns
            hi = (((1 << nw) - 1) << ns) & ~lo
            out += [(i, mask | lo), (i, mask | hi)]
        else:
            out.append((i, mask))
    return out


def _finer(mask: int, max_bits: int) -> list[int]:
    """Masks that split the bits outside ``mask`` into ``max_bits + 1`` parts, one of which must be equal."""
    free = [i for i in range(64) if not mask >> i & 1]
    m = max_bits + 1
    return [mask | sum(1 << i for i in free[len(free) * k // m: len(free) * (k + 1) // m]) for k in range(m)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(max_bits: int):
    """Edges between the fingerprints of equal keys; rows arrive sorted by (start, mask, key).

    Within a batch of groups the verified pairs are contracted to one star per component, so what
    leaves a group is at most one edge per fingerprint however many pairs are linked."""

    def compare(g: np.ndarray, fp: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, held = [], [], 0
        i, d = np.arange(len(fp) - 1), 1
        while len(i):
            i = i[i + d < len(fp)]
            i = i[g[i] == g[i + d]]
            x = fp[i] ^ fp[i + d]
            near = i[_popcount(x) <= 2 * max_bits]
            near = near[pigeonring(fp[near] ^ fp[near + d], start[near], max_bits)] if len(near) else near
            a.append(fp[near].view(np.int64))
            b.append(fp[near + d].view(np.int64))
            held += len(near)
            if held > 1 << 20:
                s = local_stars(np.concatenate(a), np.concatenate(b))
                a, b, held = [s[0]], [s[1]], 0
            d += 1
        return local_stars(np.concatenate(a), np.concatenate(b)) if a else (fp[:0].view(np.int64),) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def out(cols):
            g = np.cumsum(np.concatenate([[0], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])]))
            x, y = compare(g, cols[2].view(np.uint64), cols[3])
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)]
            if rest is not None:
                cols = [np.concatenate([p, q]) for p, q in zip(rest, cols)]
            if not len(cols[0]):
                continue
            tail = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = int(np.argmax(tail))
            rest = [c[cut:] for c in cols]
            if cut:
                yield out([c[:cut] for c in cols])
        if rest is not None and len(rest[0]) > 1:
            yield out(rest)

    return run


def links(fps: DataFrame, max_bits: int = 3, cap: int = GROUP_CAP) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the distinct fingerprints ``fps(fp)`` linked at ``max_bits`` or fewer.

    Keys that hold more than ``cap`` fingerprints are split again: the bits outside the key go into
    ``max_bits + 1`` parts, one of which must be equal in a linked pair, until no key is that large or
    ``FREE_BITS`` bits are left, which bound its size by themselves."""
    spark = fps.sparkSession
    level = [(i, mask) for i, mask in _keys(max_bits)]
    cur = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("start"), F.lit(_signed(m)).alias("mask")) for i, m in level])).alias("k"))
    cur = cur.select("fp", "k.start", "k.mask")
    out = None
    while True:
        keyed = cur.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        size = keyed.groupBy("mask", "key", "start").count().where("count > 1")
        sized = reliable(keyed.join(size, ["mask", "key", "start"]), "simhash")
        large = (F.col("count") > cap) & (F.bit_count("mask") < 64 - FREE_BITS)
        small = sized.where(~large).repartition("mask", "key").sortWithinPartitions("mask", "key")
        found = small.select("mask", "key", "fp", F.col("start").cast("long")).mapInArrow(_links(max_bits), "a long, b long")
        found = reliable(found, "simhash")
        out = found if out is None else out.union(found)
        masks = sized.where(large).select("start", "mask").distinct().collect()  # a few per level, whatever the data
        if not masks:
            return out
        finer = {(r.start, r.mask): _finer(r.mask & (1 << 64) - 1, max_bits) for r in masks}
        table = spark.createDataFrame([(s, m, _signed(f)) for (s, m), fs in finer.items() for f in fs], "start int, mask long, finer long")
        cur = (sized.where(large).join(F.broadcast(table), ["start", "mask"])
               .select("fp", "start", F.col("finer").alias("mask")))


def _named(fps: DataFrame, best: Column, max_bits: int, cap: int) -> DataFrame:
    """``(class, best)``: for each fingerprint the least ``best`` of its component's rows.

    Rows are first aggregated to their fingerprint and fingerprints to their component, so neither a
    group of copies nor a component is gathered row by row."""
    classes = reliable(fps.groupBy("fp").agg(F.min(best).alias("best")), "simhash")
    comp = components(links(classes.select("fp"), max_bits, cap), "simhash")
    label = classes.join(comp, classes.fp == comp.node, "left").select("fp", "best", F.coalesce("root", "fp").alias("root"))
    least = label.groupBy("root").agg(F.min("best").alias("least"))
    return label.join(least, "root").select(F.col("fp").alias("class"), F.col("least").alias("best"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3,
                   cap: int = GROUP_CAP) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, itself included (null where no
    member has an id). Texts: null or without words give fingerprint zero, linked like any other; fewer
    words than ``shingle`` give one shingle of all. Repeated rows and ids each keep their row; rows of one
    fingerprint form one class, so copies are never paired. Columns beside ``id_col`` and ``text_col`` are
    not read, whatever their names. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    fps = reliable(fingerprints(docs, id_col, text_col, shingle), "simhash")
    named = _named(fps, F.col("doc_id"), max_bits, cap)
    return (fps.join(named, F.col("fp") == F.col("class"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("best").alias("component_id")))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3,
                  cap: int = GROUP_CAP) -> DataFrame:
    """One row of ``docs`` of each group of :func:`simhash_groups`, with all its columns: the one with the smallest id
    (a null id only where all are null; of rows with one id that with the smallest hash, of equal rows any)."""
    prepare(docs.sparkSession)
    fps = reliable(fingerprints(docs, id_col, text_col, shingle), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__sim_a", "__sim_b")
    kept = _named(fps, first, max_bits, cap).select("best.__sim_a", "best.__sim_b").distinct()
    own = docs.select("*", *_row_keys(id_col, text_col)).join(kept, ["__sim_a", "__sim_b"], "left_semi")
    equal = Window.partitionBy("__sim_a", "__sim_b").orderBy("__sim_a")  # as the join deals them: no further shuffle
    return own.withColumn("__sim_n", F.row_number().over(equal)).where("__sim_n = 1").select(*docs.columns)
