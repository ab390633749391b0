"""Personal data: rule-based entities, and terms of the context that disclose them.

Emails, IP addresses, card and phone numbers are found by rules. The corpus then tells how strongly a term
beside an entity reveals it: with ``n_t`` and ``n_e`` rows that hold the term and the entity, ``n_te`` rows that hold
both, wherever in the text, and ``N`` rows in all, the normalised pointwise mutual information

    log2(N * n_te / (n_t * n_e)) / log2(N / n_te)

is 1 where term and entity only occur together and 0 where they are independent. An entity counts on several
levels, as most values occur once: its kind, its domain or prefix, and its value. From ``generalise`` on a
term is generalised to its word class, from ``remove`` on it is removed, at each of its places in the rows that hold
the entity; ``support`` rows must show the pair.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import prepare, reliable, scratch_path

KINDS = ("email", "ip", "card", "phone")
FLUSH = 300_000  # terms that a task counts before it hands them on
ROWS = 128  # texts whose terms are held at a time
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match always starts a run of digits and possessive runs cannot be given back, so these are linear
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > floor and _LOCAL.match(text, s - 1):
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end()
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def entities(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the entities of ``text``, by kind and start; code points, end exclusive."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def _merged(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint union of the spans."""
    starts, ends = [], []
    for s, e in sorted((s, e) for _, s, e in spans):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def _levels(kind: int, found: str) -> list[int]:
    """Keys of the levels on which an entity is counted: its kind, email domain, first four phone digits, first six
    card digits or first two and three parts of an IP address, and its value."""
    value = found.lower() if kind == 0 else found if kind == 1 else _digits(found)
    if kind == 0:
        prefix = [value[value.index("@") + 1:]]
    elif kind == 1:
        prefix = [value.rsplit(".", 2)[0], value.rsplit(".", 1)[0]]
    else:
        prefix = [value[:6 if kind == 2 else 4]]
    names = [f"{kind}", *(f"{kind}:{i}:{x}" for i, x in enumerate(prefix)), f"{kind}::{value}"]
    return [xxhash.xxh64_intdigest(x.encode()) - (1 << 63) for x in names]


def _terms(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The terms of the text that lie in no entity, each with its places."""
    out: dict[str, dict] = {}
    starts, ends = _merged(spans)
    for m in _TERM.finditer(text):
        i = bisect_left(starts, m.end()) - 1
        if i < 0 or ends[i] <= m.start():
            at = out.setdefault(m[0].lower(), {"term": m[0].lower(), "starts": [], "ends": []})
            at["starts"].append(m.start())
            at["ends"].append(m.end())
    return list(out.values())


_FOUND = "key long, base string, levels array<long>, terms array<struct<term:string,starts:array<int>,ends:array<int>>>"
_LEVELS = pa.list_(pa.int64())
_TERMS = pa.list_(pa.struct([("term", pa.string()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, with its entities' levels and, where it has any, its terms, and rows of how many texts hold each term."""
    names = ["doc_id", "key", "base", "levels", "terms", "term", "n"]
    counts: Counter = Counter()

    def counted() -> pa.RecordBatch:
        none = [pa.nulls(len(counts), t) for t in (pa.int64(), pa.int64(), pa.string(), _LEVELS, _TERMS)]
        out = pa.RecordBatch.from_arrays([*none, pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=names)
        counts.clear()
        return out

    for b in (x.slice(at, ROWS) for x in batches for at in range(0, x.num_rows, ROWS)):
        base, levels, terms = [], [], []
        for text in b.column(2).to_pylist():
            spans = entities(text) if text else []
            base.append(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans))
            levels.append(sorted({x for k, s, e in spans for x in _levels(k, text[s:e])}))
            terms.append(_terms(text, spans) if spans else [])
            if text:
                counts.update({w.lower() for w in set(_TERM.findall(text))})
            if len(counts) > FLUSH:
                yield counted()
        none = [pa.nulls(b.num_rows, t) for t in (pa.string(), pa.int64())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(base, pa.string()), pa.array(levels, _LEVELS), pa.array(terms, _TERMS), *none], names=names)
    if counts:
        yield counted()


def _key(id_col: str, text_col: str) -> Column:
    """A row's key: equal for equal ids and texts, which have the same spans."""
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
             generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``key``, ``base`` and ``spans``.

    ``base`` and ``spans`` are comma-joined ``kind:start:end`` (code points, end exclusive), ``base`` of the
    entities by kind and start, ``spans`` those followed by the disclosing terms, of kind ``generalise`` or
    ``remove`` (the stronger where both apply), by start. A term discloses an entity in every row that holds
    both, wherever they stand. A null text counts as empty; null and repeated ids and rows keep their rows, and repeated rows
    count as often as they occur. Ties cannot arise: every threshold is a comparison of whole counts. Other
    columns are not read, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    path = scratch_path(spark, "pii")
    scanned = src.mapInArrow(_scan, f"doc_id long, {_FOUND}, term string, n long").withColumn("part", F.when(F.col("n").isNull(), "texts").otherwise("terms"))
    scanned.write.partitionBy("part").parquet(path)
    # no texts, no parts: the schema of the read is given
    table = spark.read.schema(f"doc_id long, {_FOUND}, term string, n long, part string").parquet(path)
    found = table.where("part = 'texts'")
    n = found.count()
    level = found.select("doc_id", "key", F.explode("levels").alias("entity"))
    n_e = level.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    # values below the support go before the terms come in: most occur once
    known = level.join(n_e, "entity").groupBy("doc_id", "key").agg(F.collect_set(F.struct("entity", "n_e")).alias("known"))
    known = known.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "known")
    rich = found.select("doc_id", "key", "terms").join(known, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")))
    rich = reliable(rich.select("doc_id", "key", "known", "terms"), "pii_terms")
    held = rich.select("doc_id", "key", F.explode("terms").alias("t"), "known").select("doc_id", "key", "t", F.explode("known").alias("e")).select("doc_id", "key", "t", "e.*")
    n_te = held.groupBy("entity", F.col("t.term").alias("term")).agg(F.count("*").alias("n_te"), F.first("n_e").alias("n_e")).where(F.col("n_te") >= support)
    n_t = table.where("part = 'terms'").groupBy("term").agg(F.sum("n").alias("n_t"))
    pair = n_te.join(n_t, "term")
    pmi = F.log2(F.lit(float(n)) * F.col("n_te") / (F.col("n_t").cast("double") * F.col("n_e")))
    most = F.log2(F.lit(float(n)) / F.col("n_te"))
    pair = pair.withColumn("npmi", F.when(most > 0, pmi / most).otherwise(F.lit(0.0))).where(F.col("npmi") >= generalise)
    pair = pair.select("entity", "term", (F.col("npmi") >= remove).alias("strong"))
    pair = reliable(pair, "pii_pairs")
    places = F.explode(F.arrays_zip(F.col("t.starts").alias("start"), F.col("t.ends").alias("end"))).alias("p")
    terms = (held.join(pair, (held["entity"] == pair["entity"]) & (F.col("t.term") == pair["term"])).select("doc_id", "key", "strong", places)
             .groupBy("doc_id", "key", "p.start", "p.end").agg(F.max("strong").alias("strong"))
             .groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.when(F.col("strong"), "remove").otherwise("generalise").alias("kind")))).alias("more")))
    more = F.transform("more", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    terms = terms.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.array_join(more, ",").alias("more"))
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.col("more"))
    return (found.join(terms, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
            .select("doc_id", "key", "base", spans.alias("spans")))


def sanitise(text: str, spans: str) -> str:
    """``text`` with entities replaced by ``[KIND]``, generalised terms by ``[name]`` or ``[word]``, removed ones left out."""
    marks = []
    for x in spans.split(","):
        kind, s, e = x.split(":")
        marks.append((int(s), int(e), kind))
    out, at = [], 0
    for s, e, kind in sorted(marks):
        if s < at:  # entities of two kinds overlap: the part not yet replaced goes too
            at = max(at, e)
            continue
        out.append(text[at:s])
        out.append({"remove": "", "generalise": "[name]" if text[s:s + 1].isupper() else "[word]"}.get(kind, f"[{kind.upper()}]"))
        at = e
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """``docs`` with every text sanitised; all rows and columns stay. See :func:`find_pii` for nulls, ties and repeats."""
    hit = find_pii(docs, id_col, text_col, **kwargs).where("spans <> ''").select(F.col("doc_id").alias("__pii_d"), F.col("key").alias("__pii_k"), F.col("spans").alias("__pii_s")).distinct()

    @F.pandas_udf("string")
    def clean(text, spans):
        return text.combine(spans, lambda t, s: None if s is None or t is None else sanitise(t, s))

    on = F.col(id_col).cast("long").eqNullSafe(F.col("__pii_d")) & (_key(id_col, text_col) == F.col("__pii_k"))
    joined = docs.join(hit, on, "left")
    new = clean(F.when(F.col("__pii_s").isNotNull(), F.col(text_col)), F.col("__pii_s"))
    return joined.withColumn(text_col, F.when(F.col("__pii_s").isNotNull(), new).otherwise(F.col(text_col))).select(*docs.columns)
