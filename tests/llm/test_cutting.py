import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quiver.llm.cutting import GAP, SEQUENCE_COST, STREAM_COST, TOLERANCE, pack_cutting, padding, plan, solve, stream_bounds
from tests.llm.fixtures import awkward, awkward_rows, empty


def whole_check(rows, texts, seq_len):
    """Every id of every document once, gapless sequences, no padding; returns the number of sequences."""
    enc = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pad, bins, docs = padding(seq_len), defaultdict(list), Counter()
    for r in rows:
        assert 0 < r.length <= seq_len and len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert pad[end] == 0
    want = Counter()
    for doc_id, text in texts:
        ids = [*enc.encode(text or "", add_special_tokens=False).ids, 0]
        want.update((doc_id, len(ids), i, x) for i, x in enumerate(ids))
    docs = Counter((r.doc_id, r.doc_tokens, r.start + i, x) for r in rows for i, x in enumerate(r.ids))
    assert docs == want
    return len(bins)


@pytest.mark.parametrize("seq_len", [1024, 64])
def test_each_id_once_and_nothing_padded(spark, seq_len):
    rows = pack_cutting(awkward(spark), seq_len=seq_len).collect()
    n = whole_check(rows, [r[:2] for r in awkward_rows()], seq_len)
    total = sum(r.length for r in rows)
    assert n <= total // seq_len + bin(total % seq_len).count("1")  # the least without padding


def test_without_ids_the_same_places(spark):
    out = pack_cutting(awkward(spark), seq_len=64, with_ids=False)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    a, b = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in out.collect()), Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in pack_cutting(awkward(spark), seq_len=64).collect())
    assert sum(r * k[2] for k, r in a.items()) == sum(r * k[2] for k, r in b.items())


def test_one_row_and_no_row(spark):
    one = pack_cutting(awkward(spark).where("doc_id = 200")).collect()
    assert [(r.length, r.start, r.offset, r.doc_tokens, list(r.ids)) for r in one] == [(1, 0, 0, 1, [0])]
    assert pack_cutting(empty(spark)).count() == 0


def most_whole(counts, seq_len):
    """The most tokens that whole pieces fill in sequences without padding, by trying all first patterns."""
    pad, seen = padding(seq_len), {}

    def fill(k, left, total):
        if total and not pad[total]:
            yield left, total
        for j in range(k, 0, -1):
            if left[j] and total + j <= seq_len:
                yield from fill(j, tuple(n - (i == j) for i, n in enumerate(left)), total + j)

    def go(left):
        if left not in seen:
            seen[left] = max((t + go(rest) for rest, t in fill(seq_len, left, 0)), default=0)
        return seen[left]

    return go(tuple(counts.get(k, 0) for k in range(seq_len + 1)))


@pytest.mark.parametrize("seed", range(6))
def test_program_streams_no_more_than_the_best_packing(seed):
    r = random.Random(seed)
    counts = dict(Counter(r.randint(2, 11) for _ in range(7)))
    found, total = solve(counts, 12), sum(k * n for k, n in counts.items())
    used = {k: sum(p.get(k, 0) * x for p, x in found) for k in counts}
    assert all(used[k] <= counts[k] + 1e-6 for k in counts)

    def cost(whole, sequences):
        return sequences * SEQUENCE_COST + (total - whole) / 12 * STREAM_COST

    mine = cost(sum(k * x for k, x in used.items()), sum(x for _, x in found))
    whole = most_whole(counts, 12)
    assert mine <= cost(whole, whole / 2) + TOLERANCE * total + GAP * total / 12 * STREAM_COST


def test_plan_uses_no_more_than_there_is():
    r = random.Random(3)
    counts = dict(Counter(16 * min(63, int(r.expovariate(1 / 18)) + 1) for _ in range(20000)))
    used = Counter()
    for p, times in plan(counts, 1024):
        assert not padding(1024)[sum(k * n for k, n in p.items())] and times > 0
        used.update({k: n * times for k, n in p.items()})
    assert all(used[k] <= counts[k] for k in used)
    left = sum(k * (n - used[k]) for k, n in counts.items())
    assert left < 0.05 * sum(k * n for k, n in counts.items())


def test_stream_tail_is_powers_of_two():
    for total in range(200):
        cuts = [*stream_bounds(total, 64), total]
        assert all((b - a) & (b - a - 1) == 0 for a, b in zip(cuts, cuts[1:]))
