"""Operators on texts against brute force on the awkward rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quiver.llm import pii
from quiver.llm.simhash import fingerprint, simhash_dedup, simhash_groups
from quiver.llm.substring import dedup_substrings
from quiver.llm.tokens import count_long, load_model, token_counts
from tests.llm.fixtures import awkward, awkward_rows, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest_of(rows, window):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode()) + (1 << 63) & (1 << 64) - 1))
    seen, out = set(), []
    for doc_id, text in order:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if k in seen:
                gone[p:p + window] = [True] * window
            seen.add(k)
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


def test_substring_dedup_equals_brute_force(spark):
    rows = [r[:2] for r in awkward_rows()]
    for chunk in (500, 1 << 20):
        got = dedup_substrings(awkward(spark), chunk_bytes=chunk).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == digest_of(rows, 20)
        for r in got:
            assert sum(s["end"] - s["start"] for s in r.spans) == r.n_removed
    assert dedup_substrings(empty(spark)).count() == 0


def test_fingerprints_equal_brute_force():
    for text in ["", "  ", "One", "a b", "The the THE quick", "x " * 500, "ÀB cD eF gH"]:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert fingerprint(None) == 0


def components_of(fps, ids, bits):
    label = list(range(len(fps)))
    for _ in range(len(fps)):
        before = list(label)
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= bits:
                    label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    low = {}
    for i, x in enumerate(label):
        if ids[i] is not None:
            low[x] = min(low.get(x, ids[i]), ids[i])
    return [low.get(x) for x in label]


def test_simhash_groups_equal_brute_force(spark):
    rows = awkward_rows()
    fps, ids = [fingerprint(r[1].encode() if r[1] else None) for r in rows], [r[0] for r in rows]
    for bits, cap in ((3, 2048), (3, 6), (0, 2048), (8, 2048)):
        want = Counter(zip(ids, (f"{f:016x}" for f in fps), components_of(fps, ids, bits)))
        got = simhash_groups(awkward(spark), max_bits=bits, cap=cap).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash_dedup(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert kept.count() == len(set(components_of(fps, list(range(len(fps))), 3)))
    assert simhash_groups(empty(spark)).count() == simhash_dedup(empty(spark)).count() == 0


def test_pigeonring_loses_no_link_when_keys_are_split(spark):
    from quiver.llm.common import components
    from quiver.llm.simhash import links

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 5)
    fps = sorted({int(b) ^ sum(1 << int(x) for x in rng.integers(0, 60, rng.integers(0, 4))) for b in base for _ in range(60)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = components_of(fps, fps, 3)
    for cap in (2048, 20):
        got = {r.node: r.root for r in components(links(df, 3, cap)).collect()}
        assert [got.get(f, f) for f in fps] == want


def test_token_counts_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in awkward_rows())
    for chunk, overlap in ((64_000, 1000), (50, 7)):
        got = token_counts(awkward(spark), limit=10, chunk_bytes=chunk, overlap_bytes=overlap).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 10) for r in got)
    assert token_counts(empty(spark)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab  ▁é日🙂\n<s>", max_size=120), st.integers(4, 40), st.integers(1, 12))
def test_resynchronisation_is_exact(text, chunk, overlap):
    model = load_model(public_tokenizers.path("piece_bpe_32k.model"))
    starts = lambda b: np.fromiter((p.begin for p in model.encode(b.decode(), return_type="proto").pieces), np.int64)
    assert count_long(text.encode(), starts, chunk, overlap) == len(model.encode(text))


PLAIN = {0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_entities(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if "0" <= c <= "9"]
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0):
                continue
            if kind == 3 and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789..@+- ()aZ_%é", max_size=60))
def test_entities_equal_the_plain_patterns(text):
    assert pii.entities(text) == plain_entities(text)


def test_pii_terms_and_sanitised_texts(spark):
    card = "4111 1111 1111 1111"
    rows = [(i, f"filler words common Zyxquor wrote from zed@site.org today {i}") for i in range(6)]
    rows += [(50 + i, "filler words common wrote from today nothing here") for i in range(60)]
    rows += [(200, f"pay {card} or +1 (456) 555-2186, 10.0.0.255"), (201, None), (None, "else@site.org"), (202, ""), (203, "same"), (203, "same")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, spans string")
    got = pii.find_pii(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        assert by[doc_id].base == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in plain_entities(text or ""))
        assert by[doc_id].spans.startswith(by[doc_id].base)
    # the rare name that always stands by the address discloses it; words that are common do not
    assert all("remove:20:27" in by[i].spans for i in range(6))
    assert all(by[50 + i].spans == "" for i in range(60))
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[0] == "filler words common  wrote from [EMAIL] today 0"
    assert clean[200] == "pay [CARD] or [PHONE], [IP]" and clean[201] is None and clean[51] == rows[7][1]
    assert pii.sanitised(df).columns == df.columns and pii.sanitised(df).count() == len(rows)
    assert pii.find_pii(empty(spark)).count() == 0
    assert pii.find_pii(awkward(spark)).count() == len(awkward_rows())


def test_pii_terms_of_a_level(spark):
    """Every value occurs once; the domain, the prefix and the kind are what the term discloses."""
    near = [lambda i: f"p{i}@site.org", lambda i: f"10.20.{i}.7", lambda i: f"+1 (456) 555-21{i:02}"]
    rows = [(100 * k + i, f"plain words common {w} wrote to {f(i + 10)} today") for k, (w, f) in enumerate(zip(("Zyxquor", "Vlimbor", "Quandry"), near)) for i in range(6)]
    rows += [(1000 + i, "plain words common wrote today nothing here") for i in range(60)]
    by = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in range(3):
        assert all("remove:19:26" in by[100 * k + i] for i in range(6))
    assert all(by[1000 + i] == "" for i in range(60))


def test_pii_terms_anywhere_in_the_text(spark):
    """The name stands far from the address, and twice; where there is no address it stays."""
    far = "common words " * 40
    rows = [(i, f"Zyxquor {far}wrote from zed{i % 2}@site.org {far}to Zyxquor") for i in range(6)]
    rows += [(50 + i, f"{far}wrote from to nothing here") for i in range(60)] + [(None, rows[0][1])] * 2 + [(300, "Vlimbor else@other.net"), (301, "Vlimbor")]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    texts = dict(rows)
    for r in got:
        terms = [x for x in r.spans.split(",") if x.split(":")[0] in ("remove", "generalise")]
        names = [f"remove:{m.start()}:{m.end()}" for m in re.finditer("Zyxquor", texts[r.doc_id])]
        assert terms == names


def test_long_runs_are_linear():
    assert pii.entities("9" * 200_000) == [] and pii.entities("a" * 200_000) == [] and pii.entities("a@" * 50_000) == []
    assert len(pii.entities("1." * 100_000)) > 0


def test_digest_of_the_query(spark):
    from quiver.llm.queries import op1_substring_dedup

    r = op1_substring_dedup(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    assert len(r.kept_sha256) == len(hashlib.sha256().hexdigest())
