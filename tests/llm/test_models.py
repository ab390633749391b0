import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiver.llm.quality import perplexities, quality, trusted_ids
from quiver.llm.toxicity import fit_chain, score
from tests.llm.fixtures import awkward, awkward_rows, empty

SF = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_chain_finds_held_out_toxic_texts(spark):
    docs, lab = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0
    # some labels are wrong: texts of low quality marked toxic that hold no toxic word at all
    credible = (F.col("toxic") == 0) | (F.col("quality") == 1)
    chain = fit_chain(docs, lab.where(~out), {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")})
    got = score(docs, chain, {"toxic": 0.5}).join(lab.where(out & credible), "doc_id").groupBy("toxic").agg(F.avg(F.col("rejected").cast("int")).alias("r"))
    rate = {r.toxic: r.r for r in got.collect()}
    assert rate[1] > 0.9 and rate[0] < 0.01
    assert len(chain.models[1].chain) == 1 and chain.models[0].chain == []


def test_chain_on_awkward_rows(spark):
    df = awkward(spark)
    cats = {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")}
    for rows in ([], [(1, 1, 0), (2, 1, 0)], [(1, None, None), (None, 1, 1)], [(1, 1, 1), (1, 0, 0), (2, 1, 0), (300, 1, 0), (301, 0, 1), (200, 1, 1)]):
        out = score(df, fit_chain(df, labels(spark, rows), cats), {"toxic": 0.9})
        got = out.collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in awkward_rows())
        assert all(0 <= r.p_toxic <= 1 and isinstance(r.rejected, bool) for r in got)
    assert score(empty(spark), fit_chain(empty(spark), labels(spark, []), cats), {"toxic": 0.5}).count() == 0


def kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over bytes by the textbook, with dictionaries."""
    grams = Counter()
    for t in texts:
        b = [255] * (order - 1) + list(t.encode()) + [254]
        grams.update(tuple(b[i:i + order]) for i in range(len(b) - order + 1))
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    off = {}
    for k, t in tables.items():
        n = [sum(c == i for c in t.values()) for i in range(1, 5)]
        d = [0.5, 1.0, 1.5]
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            for i in range(3):
                x = i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0
                d[i] = x if 0 < x < i + 1 else d[i]
        off[k] = d

    def p(g):
        if not g:
            return 1 / 255
        t, d = tables[len(g)], off[len(g)]
        own = {h: c for h, c in t.items() if h[:-1] == g[:-1]}
        total = sum(own.values())
        if not total:
            return p(g[1:])
        cut = lambda c: d[min(c, 3) - 1]
        return (max(own[g] - cut(own[g]), 0) / total if g in own else 0) + sum(map(cut, own.values())) / total * p(g[1:])

    return p


def test_perplexity_equals_the_textbook(spark):
    r = random.Random(2)
    texts = [(i, "".join(r.choice("abc ") for _ in range(r.randint(0, 25)))) for i in range(30)] + [(40, "zzé"), (41, None), (None, "ab")]
    df = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(25)], "doc_id long")
    got = perplexities(df, trusted, order=3, chunk_bytes=100).collect()
    held = {x.doc_id for x in got if x.held_out}
    assert held and held < set(range(25))
    p = kneser_ney([t for i, t in texts if i is not None and i < 25 and i not in held], 3)
    want = {}
    for i, t in texts:
        b = [255, 255, *(t or "").encode(), 254]
        lp = [np.log(p(tuple(b[j:j + 3]))) for j in range(len(b) - 2)]
        want[i] = np.exp(-np.mean(lp))
    assert len(got) == len(texts)
    for x in got:
        assert x.perplexity == pytest.approx(want[x.doc_id], rel=1e-9)


def test_quality_keeps_good_texts_and_drops_junk(spark):
    docs, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality(docs, trusted_ids(lab, F.col("quality") == 1)).join(lab, "doc_id")
    rate = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.98 and rate[0] < 0.3


def test_quality_on_awkward_rows(spark):
    for ids in ([], [(i,) for i in range(20)]):
        got = quality(awkward(spark), spark.createDataFrame(ids, "doc_id long"), chunk_bytes=2000).collect()
        assert Counter((r.doc_id, r.lang) for r in got) == Counter((r[0], r[2]) for r in awkward_rows())
        assert all(r.kept is not None and r.perplexity > 0 for r in got)
        assert ids or all(r.kept and r.perplexity == pytest.approx(255.0) for r in got)
    assert quality(empty(spark), spark.createDataFrame([], "doc_id long")).count() == 0
