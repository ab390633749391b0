from collections import Counter, defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as E
from quiver.llm import pii
from quiver.llm.simhash import fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        rows, before = out.collect(), docs.collect()
        ids = {r.doc_id for r in before}
        if name == "toxicity":
            # texts of low quality marked toxic hold no toxic word: their labels are wrong
            bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1 and quality = 1").collect()}
            assert {r.doc_id for r in rows} <= ids and len(rows) > 0.8 * len(before)
            assert len(bad & {r.doc_id for r in rows}) <= 0.2 * len(bad)
        if name == "simhash":
            fps = {r.doc_id: fingerprint(r.text.encode()) for r in before}
            group = {i: i for i in fps}
            for _ in fps:
                new = {i: min(group[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3) for i in fps}
                if new == group:
                    break
                group = new
            assert {r.doc_id for r in rows} == set(group.values()) and len(rows) == len(set(group.values()))
        if name == "pii":
            assert {r.doc_id for r in rows} == ids
            assert all(r.n_chars == len(r.text) for r in rows)
            assert not any(pii.entities(r.text) for r in rows)
            changed = {r.doc_id for r in before if pii.entities(r.text)}
            same = {r.doc_id: r.text for r in before if r.doc_id not in changed}
            assert all(r.text == same[r.doc_id] for r in rows if r.doc_id in same)
        if name == "mixing":
            assert sorted(map(tuple, rows)) == sorted(map(tuple, before))
        if name == "packing":
            assert {r.doc_id for r in rows} == ids
            seq = defaultdict(list)
            for r in rows:
                seq[r.sequence_id].append((r.offset, r.length))
            assert all(sum(x for _, x in s) <= 2048 for s in seq.values())
        kept = rows
        docs = spark.createDataFrame(rows, out.schema)
    whole = corpus_pipeline.run(spark, SF).agg(F.sum("length"), F.count("*")).first()
    assert whole[0] == sum(r.length for r in kept) and whole[1] == len(kept)


def test_sequences_follow_the_weights(spark, monkeypatch):
    text = "Some plain words of a text about nothing. " * 20
    rows = [(i, text, "en", f"src{i % 2}", len(text)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(corpus_pipeline, "BLOCK_SIZE", 4 * len(text))
    monkeypatch.setattr(corpus_pipeline, "REST_WEIGHT", 1)
    for weights in ({"src0": 3, "src1": 1}, {"src0": 1, "src1": 3}):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        got = corpus_pipeline.packing(spark, corpus_pipeline.mixing(spark, docs, SF), SF).collect()
        assert Counter(r.doc_id for r in got) == Counter(range(400))
        ends = defaultdict(int)
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == ends[r.sequence_id]
            ends[r.sequence_id] += r.length
        assert set(ends) == set(range(len(ends))) and max(ends.values()) <= 2048
        # of 16 documents a period 12 are of the source of weight 3, as long as it lasts: 200 // 12 periods
        got.sort(key=lambda r: (r.sequence_id, r.offset))
        for p in range(1, 17):
            heavy = sum(f"src{r.doc_id % 2}" == max(weights, key=weights.get) for r in got[:16 * p])
            assert heavy == 12 * p


def test_all_queries_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
