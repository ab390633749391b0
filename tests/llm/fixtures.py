"""Small tables with the awkward cases, shared by the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, stream string, rejected string, spans string, chunk string"


def awkward_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, clashing column names."""
    r = random.Random(5)
    words = ["alpha", "beta", "Gamma", "délta", "日本", "x", "under_score", "a-b", "<s>", "<|endoftext|>"]
    passage = " ".join(r.choice(words) + str(i % 7) for i in range(60))
    rows = [(i, " ".join(r.choice(words) + str(r.randint(0, 99)) for _ in range(r.choice([1, 3, 25, 80]))), "en", f"src{i % 4}") for i in range(30)]
    rows += [(100, passage, "en", "src0"), (101, "lead in " + passage + " tail", "en", "src0"), (102, passage, None, None), (7, passage + "\n" + passage, "en", "src1")]
    rows += [(200, None, "de", "src2"), (201, "", "de", "src2"), (202, " \t\n", None, "src3"), (None, passage, "en", "src1"), (None, None, None, None)]
    rows += [(300, "same row", "en", "src0")] * 3 + [(301, "one text", "en", "src0"), (301, "another text", "en", "src0")]
    rows += [(400, " ".join(r.choice(words) + str(r.randint(0, 500)) for _ in range(9000)), "en", "src0"), (401, "nospace" * 9000, "en", "src9")]
    return [(i, t, lang, s, None if t is None else len(t), "s", "r", "p", "c") for i, t, lang, s in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
