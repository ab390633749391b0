"""Repair of the turn structure of conversations by a generalised LR parse of their roles.

The grammar of roles is: nothing, or an optional system turn and pairs of user and assistant. The parser reads a
conversation with several stacks at once. At each row every stack may keep, rerole or delete it, and may insert empty turns
before it; stacks that come to the same top are merged, the least (cost, audit) staying. An audit tells all edits, so two of the same cost
from the same stack are never prefixes of one another, and the merge is exact.

A conversation is parsed in segments of bounded length, whichever stack they begin with, and a short pass over its segments picks
the stacks. The only sequential work on a long conversation is that pass and the hash of the repaired text, which is
streamed; its audit is one value of the result, so that many bytes are held at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import prepare, reliable
from quiver.llm.places import places

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SEGMENT = 256  # rows parsed together
SPACE = r"\x20\x09-\x0D"
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
# LR states: 0 start, s system, u user of the first pair, p that pair, P pairs, S pairs after system, n user of a further pair, m that pair
SHIFT = {"0": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "p"}, "P": {"u": "n"}, "S": {"u": "n"}, "n": {"a": "m"}}
REDUCE = {"p": 2, "m": 3}  # states in which a rule is complete, and the length of its right side
GOTO = {"0": "P", "s": "S"}
ACCEPT = "0PS"
START = "0"


def push(stack: str, role: str) -> str | None:
    """The stack after a turn with this role initial; None where the grammar has no such turn."""
    state = SHIFT.get(stack[-1], {}).get(role)
    if state is None:
        return None
    stack += state
    if state in REDUCE:
        stack = stack[:-REDUCE[state]]
        stack += GOTO[stack[-1]]
    return stack


@lru_cache(None)
def inserts(stack: str) -> tuple[tuple[str, int, str], ...]:
    """Stacks after no, one or two inserted turns; a third only leads back to the top after one."""
    out = [(stack, 0, "")]
    for n in (1, 2):
        out += [(s, n * INSERT, "I" * n) for t, _, a in out if len(a) == n - 1 for r in ROLES if (s := push(t, r))]
    return tuple(out)


@lru_cache(None)
def moves(stack: str, role: str, fault: str) -> tuple[tuple[str, int, str], ...]:
    """What a stack may become at a row: ``(stack, cost, edits)``."""
    out = []
    for s, cost, edits in inserts(stack):
        out.append((s, cost + DELETE, edits + "D"))
        if fault not in ("blank", "duplicate"):
            kept = cost + TRUNCATED * (fault == "truncated")
            out += [(t, kept, edits + "K") for t in [push(s, role)] if t]
            out += [(t, kept + REROLE, edits + "R") for r in ROLES if (t := push(s, r))]
    return tuple(out)


@lru_cache(None)
def all_stacks() -> tuple[str, ...]:
    found = [START]
    for s in found:
        found += [t for r in "sua" if (t := push(s, r)) and t not in found]
    return tuple(found)


def _merge(tops: dict, stack: str, cost: int, audit: str, *rest) -> None:
    if stack[-1] not in tops or (cost, audit) < tops[stack[-1]][1:3]:
        tops[stack[-1]] = (stack, cost, audit, *rest)


def parse(rows: list[tuple[str, str]], start: str) -> list[tuple[str, int, str]]:
    """``(role initial, fault)`` rows read from one stack: the merged stacks with cost and audit."""
    tops = {start[-1]: (start, 0, "")}
    for role, fault in rows:
        after: dict = {}
        for stack, cost, audit in tops.values():
            for s, c, edits in moves(stack, role, fault):
                _merge(after, s, cost + c, audit + edits)
        tops = after
    return list(tops.values())


SEGMENTS = "key string, seg long, start string, end string, cost long, audit string, first string, last string, illegal long"
LINES = "key string, seg long, lines string"
PATHS = "key string, seg long, start string, piece string, cost long, audit string, illegal long"


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The rows, which come sorted, by their first ``keys`` columns."""
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    return groupby(rows, key=lambda r: r[:keys])


def _told(rows: Iterator[tuple], schema: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, (_, kind) in zip(zip(*some), fields)], names=[name for name, _ in fields])


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, seg, initial, fault``."""

    def out():
        for (key, seg), run in _runs(batches, 2):
            rows = [r[2:] for r in run]
            roles = [r[0] for r in rows]
            illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))
            for start in (START,) if seg == 0 else all_stacks():
                for end in parse(rows, start):
                    yield key, seg, start, *end, roles[0], roles[-1], illegal

    return _told(out(), SEGMENTS)


def _path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``SEGMENTS``."""

    def out():
        for (key,), own in _runs(batches, 1):
            tops, steps, illegal, before = {START: (START, 0, "", None, "")}, [], 0, None
            for _, run in groupby(own, key=lambda r: r[1]):
                after: dict = {}
                for at, (_, _, start, end, cost, audit, first, last, inner) in enumerate(run):
                    if at == 0:
                        illegal += inner + (before is not None and before + first not in LEGAL)
                    here = tops.get(start[-1])
                    if here and here[0] == start:
                        _merge(after, end, here[1] + cost, here[2] + audit, start, audit)
                before, tops = last, after
                steps.append({v[0]: v[3:] for v in after.values()})
            cost, audit, stack, edits = min((cost + c, audit + e, s0, e) for s0, cost, audit, *_ in tops.values() for s, c, e in inserts(s0) if s[-1] in ACCEPT)
            for seg in reversed(range(len(steps))):
                start, piece = steps[seg][stack]
                yield key, seg, start, piece + edits, *((cost, audit, illegal) if seg == 0 else (None, None, None))
                stack, edits = start, ""

    return _told(out(), PATHS, 64)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, seg, start, piece, role, initial, text``."""

    def out():
        for (key, seg, stack, piece), run in _runs(batches, 4):
            turns, lines = (r[4:] for r in run), []
            for edit in piece:
                role, initial, text = ("", "", "") if edit == "I" else next(turns)
                if edit == "D":
                    continue
                if edit != "K":
                    initial = next(r for r in ROLES if push(stack, r))  # each state has one
                    role = ROLES[initial]
                stack = push(stack, initial)
                lines.append(f"{role}:{text}")
            yield key, seg, "\n".join(lines) if lines else None

    return _told(out(), LINES, 64)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's lines, which come in order; one hash state is held."""
    open_key, state = None, None
    for b in batches:
        keys, digests = [], []
        for key, lines in zip(b.column(0).to_pylist(), b.column(1)):
            if key == open_key:
                state.update(b"\n")
            else:
                if state:
                    keys.append(open_key)
                    digests.append(state.hexdigest())
                open_key, state = key, hashlib.sha256()
            state.update(lines.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], names=["key", "repaired_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([open_key]), pa.array([state.hexdigest()])], names=["key", "repaired_sha256"])


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets its role to user; null role and text, and a null
    in the key, are one space."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")])
    name = [F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")]
    c = c.withColumn("_by", F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20).where("_by <> 0")
    text = F.when(F.col("_by") == 1, "").when(F.col("_by") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_by") == 4, "user").otherwise(F.col("role"))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("_by") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def repaired(conversations: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """A summary per conversation that has rows, and its repaired lines by segment.

    The summary holds ``key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``; the lines, written, are ``key, seg,
    lines`` (null: no line). Rows are taken by turn (nulls first), then role, then text, both bytewise; repeated rows are duplicates. A null
    conv_id is a conversation of its own; a null role or text is one space; an empty role has an empty initial, which no rule takes."""
    prepare(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")])
    rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    rows = reliable(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    placed = places(rows, "key", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")])
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    firsts = placed.groupBy("key", said.alias("_said")).agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("_new"))
    fault = (F.when(~F.col("text").rlike(f"[^{SPACE}]"), "blank").when(F.col("_new").isNull(), "duplicate")
             .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated").otherwise(""))
    told = placed.join(firsts, ["key", "pos"], "left").select(
        "key", "conv_id", "turn", "pos", F.expr(f"pos div {segment}").alias("seg"), "role", F.substring("role", 1, 1).alias("initial"), "text", fault.alias("fault"))
    told = reliable(told, "faults")
    by_segment = told.repartition("key", "seg").sortWithinPartitions("key", "seg", "pos")
    segments = by_segment.select("key", "seg", "initial", "fault").mapInArrow(_segment, SEGMENTS)
    paths = reliable(segments.repartition("key").sortWithinPartitions("key", "seg").mapInArrow(_path, PATHS), "paths")
    edited = told.join(paths.select("key", "seg", "start", "piece"), ["key", "seg"])
    # by an expression of its own: a shuffle on the join's keys would be dropped, and a join turned to broadcast reads its rows as they lie
    edited = edited.repartition(F.xxhash64("key", "seg")).sortWithinPartitions("key", "seg", "pos")
    lines = reliable(edited.select("key", "seg", "start", "piece", "role", "initial", "text").mapInArrow(_replay, LINES), "lines")
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    counts = told.groupBy("key", "conv_id").agg(span.alias("gaps"), *[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])
    return counts.join(paths.where("seg = 0").select("key", "illegal", "cost", "audit"), "key"), lines


def repair(conversations: DataFrame, originals: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conv_id of ``originals``: what was wrong with its rows in ``conversations``, the cheapest repair and the digest of its text.

    A conversation without rows has zeros, an empty audit and the hash of an empty text; without originals there is no row. Other columns are
    not read, whatever their names. See ``repaired`` for nulls and ties."""
    summary, lines = repaired(conversations, segment)
    ordered = lines.where("lines is not null").repartition("key").sortWithinPartitions("key", "seg").select("key", "lines")
    digests = ordered.mapInArrow(_hash, "key string, repaired_sha256 string")
    ids = originals.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    ids = ids.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    out = ids.join(summary.drop("conv_id"), "key", "left").join(digests, "key", "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
