"""The registered queries of this package, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm.cutting import pack_cutting
from quiver.llm.lattice import near_duplicates
from quiver.llm.merkle import manifest
from quiver.llm.mixing import REST, mix
from quiver.llm.packing import pack
from quiver.llm.pii import KINDS, find_pii
from quiver.llm.quality import quality, trusted_ids
from quiver.llm.repair import damage, repair
from quiver.llm.simhash import simhash_groups
from quiver.llm.substring import dedup_substrings
from quiver.llm.tokens import token_counts
from quiver.llm.topk import top_k
from quiver.llm.toxicity import Chain, fit_chain, score

THRESHOLD = 0.5
#: Blocks of each source in a period of the mixture; sources without an entry share one block.
WEIGHTS = {"src0": 6, "src1": 4, "src2": 4, "src3": 3, "src4": 3, **{f"src{i}": 2 for i in range(5, 20)}}
REST_WEIGHT = 1
BLOCK_SIZE = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_chain(docs: DataFrame, labels: DataFrame) -> Chain:
    """Low quality, then toxicity."""
    return fit_chain(docs, labels, {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")})


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 20-word passages removed: what is left of each document, as a digest."""
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the chain's categories, and whether the document is rejected as toxic."""
    docs = table(spark, sf_dir, "documents")
    out = score(docs.select("doc_id", "text"), toxicity_chain(docs, table(spark, sf_dir, "labels")), {"toxic": THRESHOLD})
    return out.select("doc_id", "p_junk", "p_toxic", "rejected")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and disclosing terms of each document."""
    out = find_pii(table(spark, sf_dir, "documents"))
    counts = [F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings at cosine 0.9: links, component and whether the vector stays."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of each document under the model of the trusted ones, and whether it stays."""
    trusted = trusted_ids(table(spark, sf_dir, "labels"), F.col("quality") == 1)
    return quality(table(spark, sf_dir, "documents"), trusted)


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot of each document's block in the mixture of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return mix(docs, WEIGHTS, REST_WEIGHT, block_size=BLOCK_SIZE).select("doc_id", "source", "stream", "start", "block", "slot")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of each document: three words, three bits."""
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, and whether they are more than 4096."""
    return token_counts(table(spark, sf_dir, "documents"), limit=4096)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of the documents: each one's proof, and whether it holds after some texts were changed."""
    return manifest(table(spark, sf_dir, "documents"))


def op12_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in sequences of 1024 tokens, none of them padded."""
    return pack_cutting(table(spark, sf_dir, "documents"), with_ids=False)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each damaged conversation, and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    return repair(damage(rows), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_substring_dedup, op2_toxicity, op3_pii, op4_lattice_near_dedup, op5_best_two_fit, op6_quality, op7_pfair_mixing, op8_topk, op9_simhash, op10_token_counts, op11_merkle, op12_cutting_stock, op13_repair)}

_SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS p FROM d)),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM win) WHERE n > 1),
word AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
cover AS (SELECT word.doc_id, i, x, coalesce(i - max(p) OVER (PARTITION BY word.doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) < 20, FALSE) AS gone
          FROM word LEFT JOIN late ON late.doc_id = word.doc_id AND late.p = word.i),
kept AS (SELECT doc_id, count(*) AS n_words, sum(gone::INT) AS n_removed, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM cover GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

_LATTICE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp ON comp.vec_id = v.vec_id"""

_TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INT AS rank, vec_id, score FROM r WHERE n <= 5"""


def _mixing_sql() -> str:
    target = {**WEIGHTS, REST: REST_WEIGHT}
    names = sorted(target)
    w, total = [target[k] for k in names], sum(target.values())
    listed = ", ".join(f"'{k}'" for k in sorted(WEIGHTS))
    return f"""
WITH RECURSIVE c AS (SELECT {names} AS names, {w} AS w),
edf AS (SELECT 0 AS t, {[0] * len(names)} AS i, 0 AS k
  UNION ALL
  SELECT t + 1, list_transform(i, lambda n, j: CASE WHEN j = pick THEN n + 1 ELSE n END), pick FROM (
    SELECT t, i, (list_min(list_transform(range(1, {len(names) + 1}), lambda j: CASE WHEN i[j] * {total} // w[j] <= t
             THEN (((i[j] + 1) * {total} + w[j] - 1) // w[j]) * 1000 + j END)) % 1000)::INT AS pick FROM edf, c WHERE t < {total})),
slots AS (SELECT names[k] AS stream, w[k] AS w, t - 1 AS slot, row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS i FROM edf, c WHERE t > 0),
d AS (SELECT doc_id, source, CASE WHEN source IN ({listed}) THEN source ELSE '{REST}' END AS stream,
             md5(coalesce(doc_id::VARCHAR, '')) AS key, greatest(coalesce(n_chars, 0), 0) AS size FROM documents),
r AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY stream ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
b AS (SELECT *, start // {BLOCK_SIZE} AS block FROM r)
SELECT doc_id, source, b.stream, start, block::BIGINT AS block, (block // w * {total} + slot)::BIGINT AS slot
FROM b JOIN slots ON slots.stream = b.stream AND slots.i = block % w"""


# CRC-32 of the ASCII string {0}, by the table of its 256 remainders
_CRC_TABLE = """crc AS (SELECT list_transform(range(0, 256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS remainders)"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda x: ord(x)::BIGINT)),
  lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])))"""


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    side = "coalesce(string_agg(h, '') OVER (PARTITION BY {0} k, i // 16 ORDER BY i ROWS BETWEEN {1}), '')"
    sides = ", ".join(side.format("{0}", x) for x in ("UNBOUNDED PRECEDING AND 1 PRECEDING", "1 FOLLOWING AND UNBOUNDED FOLLOWING"))
    return f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_CRC.format('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS shown FROM documents, crc),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
lv AS (SELECT source, 0 AS k, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM o
  UNION ALL
  SELECT source, k + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM lv WHERE n > 1 GROUP BY source, k, i // 16),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j FROM lv WHERE n = 1),
tv AS (SELECT 0 AS k, j AS i, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT k + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM tv WHERE n > 1 GROUP BY k, i // 16),
ls AS (SELECT source, k, i, [{sides.format('source,')}] AS side FROM lv WHERE n > 1),
ts AS (SELECT k, i, [{sides.format('')}] AS side FROM tv WHERE n > 1),
path AS (SELECT o.source, o.i, k, side FROM o JOIN ls ON ls.source IS NOT DISTINCT FROM o.source AND ls.i = o.i // (16 ** k)::BIGINT
  UNION ALL
  SELECT o.source, o.i, 1000 + k, side FROM o JOIN s ON s.source IS NOT DISTINCT FROM o.source JOIN ts ON ts.i = s.j // (16 ** k)::BIGINT),
whole AS (SELECT source, i, list(side ORDER BY k) AS sides FROM path GROUP BY source, i),
out AS (SELECT o.doc_id, o.leaf, s.subroot, (SELECT h FROM tv WHERE n = 1) AS root,
    sha256(coalesce(array_to_string(flatten(sides), ''), '')) AS proof_sha256,
    list_reduce(list_prepend([o.shown, ''], coalesce(sides, [])), lambda a, p: [sha256(p[1] || a[1] || p[2]), ''])[1] AS folded_root
  FROM o JOIN s ON s.source IS NOT DISTINCT FROM o.source LEFT JOIN whole ON whole.source IS NOT DISTINCT FROM o.source AND whole.i = o.i)
SELECT *, folded_root = root AS verified FROM out"""


def _repair_sql() -> str:
    space = r"\x20\x09-\x0D"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations, crc),
dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS twin FROM src WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS seen
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM dam)),
r AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^{space}]') THEN 'blank' WHEN seen THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][{space}]*$') THEN 'truncated' ELSE '' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS b FROM o),
push(st, i, nx) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
one AS (SELECT st, nx FROM push WHERE i <> 's'),
ins AS (SELECT DISTINCT st, st AS nx, 0 AS c, '' AS a FROM push UNION ALL SELECT st, nx, 3, 'I' FROM one UNION ALL SELECT x.st, y.nx, 6, 'II' FROM one x JOIN one y ON y.st = x.nx),
mv AS (SELECT st, nx, NULL AS i, c + 4 AS c, a || 'D' AS a FROM ins
  UNION ALL SELECT ins.st, push.nx, i, c, a || 'K' FROM ins JOIN push ON push.st = ins.nx
  UNION ALL SELECT ins.st, push.nx, NULL, c + 3, a || 'R' FROM ins JOIN push ON push.st = ins.nx WHERE i <> 's'),
dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS n, 0 AS st, {{'c': 0, 'a': ''}} AS best FROM r
  UNION ALL
  SELECT dp.conv_id, r.n, mv.nx, min({{'c': best.c + mv.c + CASE WHEN fault = 'truncated' AND mv.a NOT LIKE '%D' THEN 3 ELSE 0 END, 'a': best.a || mv.a}})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.n = dp.n + 1
          JOIN mv ON mv.st = dp.st AND coalesce(mv.i = r.i, TRUE) AND (mv.a LIKE '%D' OR fault NOT IN ('blank', 'duplicate'))
  GROUP BY dp.conv_id, r.n, mv.nx),
len AS (SELECT conv_id, max(n) AS n, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (b || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
done AS (SELECT dp.conv_id, min({{'c': best.c + ins.c, 'a': best.a || ins.a}}) AS best FROM dp JOIN len ON len.conv_id IS NOT DISTINCT FROM dp.conv_id AND len.n = dp.n
         JOIN ins ON ins.st = dp.st AND ins.nx IN (0, 3) GROUP BY dp.conv_id),
ops AS (SELECT conv_id, p, substr(a, p, 1) AS e, count(*) FILTER (substr(a, p, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS n
        FROM (SELECT conv_id, best.a AS a, unnest(range(1, len(best.a) + 1)) AS p FROM done)),
ln AS (SELECT ops.conv_id, p, e, role, i, CASE WHEN e = 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY ops.conv_id ORDER BY p) - 1 AS k
       FROM ops LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM ops.conv_id AND r.n = ops.n WHERE e <> 'D'),
sy AS (SELECT *, max((k = 0 AND e = 'K' AND i = 's')::INT) OVER (PARTITION BY conv_id) AS sys FROM ln),
tx AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS body FROM sy GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN len ON len.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN tx ON tx.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE: dict[str, str] = {"op1_substring_dedup": _SUBSTRING_SQL, "op4_lattice_near_dedup": _LATTICE_SQL, "op7_pfair_mixing": _mixing_sql(), "op8_topk": _TOPK_SQL, "op11_merkle": _merkle_sql(), "op13_repair": _repair_sql()}
