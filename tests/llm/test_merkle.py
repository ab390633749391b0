import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quiver.llm.merkle import PROOFS, manifest
from quiver.llm.places import places
from tests.llm.fixtures import awkward, awkward_rows, empty


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, fanout=16):
    """Rows (doc_id, text, lang, source, n_chars): the whole trees in memory."""

    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    def tree(nodes):
        """The root, and the runs on the way of each leaf as (before, behind)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for p, i in enumerate(at):
                run = nodes[i - i % fanout:i - i % fanout + fanout]
                paths[p].append(("".join(run[:i % fanout]), "".join(run[i % fanout + 1:])))
                at[p] = i // fanout
            nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        return nodes[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[s] = (own, *tree([leaf(r, r[1]) for r in own]))
    root, tops = tree([trees[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            path = path + top
            node = leaf(r, lower(r[1]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[1])
            for a, b in path:
                node = sha(a + node + b)
            out.append((r[0], leaf(r, r[1]), subroot, root, sha("".join(a + b for a, b in path)), node, node == root))
    return Counter(out)


@pytest.mark.parametrize("fanout, height", [(16, 3), (2, 1), (2, 2), (3, 2)])
def test_manifest_against_whole_trees(spark, fanout, height):
    got = Counter(map(tuple, manifest(awkward(spark), fanout=fanout, height=height).collect()))
    assert got == brute([r[:5] for r in awkward_rows()], fanout)


def test_hot_source_over_many_superblocks(spark):
    rows = [(i % 997, f"Text {i}", "en", "hot" if i % 3 else f"s{i % 40}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert Counter(map(tuple, manifest(df, fanout=4, height=2).collect())) == brute(rows, 4)


def test_one_row_and_no_row(spark):
    one = awkward(spark).where("doc_id = 200")
    r = manifest(one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("") and r.verified
    none = manifest(empty(spark))
    assert none.columns == [c.split()[0] for c in PROOFS.split(", ")] and none.count() == 0


def test_tampering_is_found(spark):
    rows = manifest(awkward(spark)).collect()
    changed = {r[0] for r in awkward_rows() if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] != lower(r[1])}
    assert changed and {r.doc_id for r in rows if not r.verified} == changed


def test_places(spark):
    rows = [("a" * (i % 5 == 0) + str(i % 3), i * 7 % 1000) for i in range(1000)]
    got = places(spark.createDataFrame(rows, "g string, x long").repartition(6), "g", [F.col("x")]).collect()
    want = {}
    for g in {r[0] for r in rows}:
        want |= {(g, x): p for p, x in enumerate(sorted(x for h, x in rows if h == g))}
    assert {(r.g, r.x): r.pos for r in got} == want


def test_places_by_weight(spark):
    rows = [(str(i % 3 % 2), i * 7 % 1000, i % 5) for i in range(1000)]
    got = places(spark.createDataFrame(rows, "g string, x long, w long").repartition(6), "g", [F.col("x")], "at", weight="w").collect()
    sums, want = Counter(), {}
    for g, x, w in sorted(rows):
        want[g, x] = sums[g]
        sums[g] += w
    assert {(r.g, r.x): r["at"] for r in got} == want
