"""DuckDB SQL for the registered queries (the correctness oracle).

The SQL is assembled from CTE fragments that mirror the Spark operators
step by step: same expressions, same evaluation order, same tie rules.
"""

from __future__ import annotations

FEATS = ("open", "high", "low", "close")


def dist(a: str, b: str) -> str:
    """Mean-L1 distance, summed left to right."""
    return f"(list_sum(list_transform(list_zip({a}, {b}), lambda z: abs(z[1] - z[2]))) / len({b}))"


def bars_cte(source: str = "events", amount: int | None = None) -> str:
    if source == "events":
        chosen = "" if amount is None else (
            f" AND CAST(user_id AS VARCHAR) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey < {amount})")
        return f"""bars AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS d,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close
  FROM events WHERE value IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL{chosen}
  GROUP BY 1, 2)"""
    return """bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS d,
         arg_min(l_extendedprice, (l_orderkey, l_linenumber)) AS open, max(l_extendedprice) AS high,
         min(l_extendedprice) AS low, arg_max(l_extendedprice, (l_orderkey, l_linenumber)) AS close
  FROM lineitem WHERE l_shipdate IS NOT NULL
  GROUP BY 1, 2)"""


def latest_ctes(days: int) -> str:
    return f"""lat AS (
  SELECT symbol, d, open, high, low, close,
         row_number() OVER (PARTITION BY symbol ORDER BY d DESC) AS day_index
  FROM bars QUALIFY day_index <= {days}),
fh AS (
  SELECT * FROM lat WHERE symbol IN (SELECT symbol FROM lat GROUP BY symbol HAVING count(*) = {days}))"""


def scaled_cte(degenerate: str = "nan", feats=FEATS) -> str:
    fallback = "CAST('NaN' AS DOUBLE)" if degenerate == "nan" else "CAST(0.0 AS DOUBLE)"
    cols = []
    for f in feats:
        mn, mx = f"min({f}) OVER w", f"max({f}) OVER w"
        cols.append(f"CASE WHEN {mx} = {mn} THEN {fallback} "
                    f"ELSE CAST(0.0 AS DOUBLE) + ({f} - {mn}) * CAST(1.0 AS DOUBLE) / ({mx} - {mn}) END AS {f}")
    return "sc AS (\n  SELECT symbol, d, day_index,\n    " + ",\n    ".join(cols) + \
        "\n  FROM fh WINDOW w AS (PARTITION BY symbol))"


def vectors_ctes(feats=FEATS) -> str:
    nf = len(feats)
    parts = [f"SELECT symbol, CAST((day_index - 1) * {nf} + {i} AS INTEGER) AS pos, {f} AS x FROM sc"
             for i, f in enumerate(feats)]
    return "vl AS (\n  " + "\n  UNION ALL ".join(parts) + "),\n" + \
        "vec AS (SELECT symbol, list(x ORDER BY pos) AS v FROM vl GROUP BY symbol)"


def pipeline_prefix(days: int = 5, degenerate: str = "nan", source: str = "events", amount: int | None = None,
                    feats=FEATS) -> str:
    return ",\n".join([bars_cte(source, amount), latest_ctes(days), scaled_cte(degenerate, feats), vectors_ctes(feats)])


def clusters_ctes(prefix: str, t1: float, k: int, dim: int, seed: str = "42", vec: str = "vec") -> str:
    """prefix (defining ``vec``) -> ... -> cl(cluster_no, symbol) of the converged k-means."""
    return ",\n".join([prefix, canopy_ctes(t1, vec), seats_ctes(k), seeds_ctes(seed), converged_ctes(dim)])


def canopy_ctes(t1: float, vec: str = "vec", p: str = "", order: str = "symbol", group: str | None = None) -> str:
    """Sequential greedy canopy as a recursive walk -> {p}mem(symbol, canopy, v).

    ``order`` is the visiting order; with ``group`` only vectors of the same
    group can join each other (one independent pass per group).
    """
    same = f"a.{group} = b.{group} AND " if group else ""
    cols = f"symbol, v{', ' + group if group else ''}"
    return f"""{p}ord AS (SELECT {cols}, row_number() OVER (ORDER BY {order}) AS pos FROM {vec}),
{p}nearp AS (SELECT a.pos AS ap, b.pos AS bp FROM {p}ord a JOIN {p}ord b
  ON {same}a.pos < b.pos AND {dist('a.v', 'b.v')} < {t1!r}),
{p}walk(pos, centers) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT w.pos + 1,
         CASE WHEN EXISTS (SELECT 1 FROM {p}nearp e WHERE e.bp = w.pos + 1 AND list_contains(w.centers, e.ap))
              THEN w.centers ELSE list_append(w.centers, w.pos + 1) END
  FROM {p}walk w WHERE w.pos < (SELECT max(pos) FROM {p}ord)),
{p}cen AS (SELECT unnest(centers) AS cpos FROM {p}walk WHERE pos = (SELECT max(pos) FROM {p}ord)),
{p}mem0 AS (
  SELECT o.symbol, o.pos, coalesce(min(e.ap), o.pos) AS cpos
  FROM {p}ord o LEFT JOIN (SELECT * FROM {p}nearp WHERE ap IN (SELECT cpos FROM {p}cen)) e
    ON e.bp = o.pos AND o.pos NOT IN (SELECT cpos FROM {p}cen)
  GROUP BY o.symbol, o.pos),
{p}mem AS (SELECT m.symbol, c.symbol AS canopy, o.v FROM {p}mem0 m JOIN {p}ord c ON c.pos = m.cpos
  JOIN {p}ord o ON o.pos = m.pos)"""


def md5_bucket(col: str, buckets: int) -> str:
    return f"CAST(('0x' || substr(md5({col}), 1, 8))::BIGINT % {int(buckets)} AS BIGINT)"


def canopy_bucketed_ctes(t1: float, buckets: int, vec: str = "vec") -> str:
    """Local pass per md5 bucket, then a greedy pass over the local centres -> mem(symbol, canopy, v)."""
    return ",\n".join([
        f"bvec AS (SELECT symbol, v, {md5_bucket('symbol', buckets)} AS bucket FROM {vec})",
        canopy_ctes(t1, "bvec", p="l_", order="bucket, symbol", group="bucket"),
        "lcen AS (SELECT symbol, v FROM l_mem WHERE symbol = canopy)",
        canopy_ctes(t1, "lcen", p="g_"),
        "mem AS (SELECT l.symbol, g.canopy, l.v FROM l_mem l JOIN g_mem g ON g.symbol = l.canopy)",
    ])


def canopy_tree_ctes(t1: float, levels: tuple[int, ...], vec: str = "vec") -> str:
    """A pass per bucket, then per bucket of the next level over the centres left -> mem(symbol, canopy, v)."""
    parts, seen, follow = [], vec, ""
    for i, buckets in enumerate(levels):
        parts += [f"t{i}_in AS (SELECT symbol, v, {md5_bucket('symbol', buckets)} AS bucket FROM {seen})",
                  canopy_ctes(t1, f"t{i}_in", p=f"t{i}_", order="bucket, symbol", group="bucket"),
                  f"t{i}_left AS (SELECT symbol, v FROM t{i}_mem WHERE symbol = canopy)"]
        seen = f"t{i}_left"
        if i:
            follow += f" JOIN t{i}_mem ON t{i}_mem.symbol = t{i - 1}_mem.canopy"
    parts.append(f"mem AS (SELECT t0_mem.symbol, t{len(levels) - 1}_mem.canopy, t0_mem.v FROM t0_mem{follow})")
    return ",\n".join(parts)


def seats_ctes(k: int) -> str:
    return f"""sz AS (SELECT canopy, count(*) AS n FROM mem GROUP BY canopy),
tt AS (SELECT *, sum(n) OVER () AS nn, count(*) OVER () AS cc FROM sz),
tk AS (SELECT *, least(nn, greatest({k}, cc)) AS kk FROM tt),
b1 AS (SELECT *,
         CASE WHEN nn = cc THEN 1 ELSE CAST(1 + ((kk - cc) * (n - 1)) // (nn - cc) AS BIGINT) END AS base,
         CASE WHEN nn = cc THEN 0 ELSE ((kk - cc) * (n - 1)) % (nn - cc) END AS rem FROM tk),
seats AS (SELECT canopy, n,
         CAST(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, canopy) <= kk - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS k
       FROM b1)"""


def seeds_ctes(seed: str = "42") -> str:
    return f"""sd AS (SELECT canopy, symbol, v,
         row_number() OVER (PARTITION BY canopy ORDER BY md5('{seed}:' || symbol), symbol) AS r FROM mem),
c0 AS (SELECT row_number() OVER (ORDER BY canopy, r) AS cid, canopy, symbol, v
       FROM sd JOIN seats USING (canopy) WHERE r <= k)"""


def snap(x: str) -> str:
    """floor(x * 1e12 + 0.5) / 1e12 in doubles (the near-tie guard of every engine)."""
    return f"(floor({x} * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1e12 AS DOUBLE))"


def round_ctes(i: int, dim: int) -> str:
    """Round i: a_i = nearest centre of c_(i-1) in the own canopy; c_i = member means (old if empty)."""
    return f"""a{i} AS (
  SELECT m.symbol, m.canopy, arg_min(s.cid, ({snap(dist('s.v', 'm.v'))}, s.cid)) AS cid,
         min({snap(dist('s.v', 'm.v'))}) AS dd
  FROM mem m JOIN c{i - 1} s USING (canopy) GROUP BY m.symbol, m.canopy),
e{i} AS (
  SELECT a.cid, gs.p, avg(m.v[gs.p]) AS x
  FROM a{i} a JOIN mem m USING (symbol) CROSS JOIN generate_series(1, {dim}) gs(p)
  GROUP BY a.cid, gs.p),
c{i} AS (
  SELECT o.cid, o.canopy, coalesce(n.v, o.v) AS v
  FROM c{i - 1} o LEFT JOIN (SELECT cid, list(x ORDER BY p) AS v FROM e{i} GROUP BY cid) n USING (cid))"""


def kmeans_ctes(rounds: int, dim: int) -> str:
    return ",\n".join(round_ctes(i, dim) for i in range(1, rounds + 1))


def converged_ctes(dim: int) -> str:
    """k-means rounds from c0 until no centre moves -> af (last assignment), cl(cluster_no, symbol)."""
    d = snap(dist("s.v", "m.v"))
    same = "list_transform({0}, lambda x: round(x, 10))"
    return f"""rounds(it, cid, canopy, v, moving) AS (
  SELECT 0, cid, canopy, v, true FROM c0
  UNION ALL
  SELECT it + 1, cid, canopy, nv, bool_or({same.format("v")} IS DISTINCT FROM {same.format("nv")}) OVER ()
  FROM (
    SELECT o.it, o.cid, o.canopy, o.v, coalesce(n.v, o.v) AS nv
    FROM rounds o LEFT JOIN (
      SELECT cid, list(x ORDER BY p) AS v FROM (
        SELECT a.cid, gs.p, avg(a.v[gs.p]) AS x
        FROM (SELECT m.symbol, any_value(m.v) AS v, arg_min(s.cid, ({d}, s.cid)) AS cid
              FROM mem m JOIN rounds s ON s.canopy = m.canopy GROUP BY m.symbol) a
        CROSS JOIN generate_series(1, {dim}) gs(p) GROUP BY a.cid, gs.p)
      GROUP BY cid) n ON n.cid = o.cid
    WHERE o.moving)),
fixed_c AS (SELECT cid, canopy, v FROM rounds WHERE it = (SELECT max(it) FROM rounds)),
af AS (SELECT m.symbol, m.canopy, arg_min(s.cid, ({d}, s.cid)) AS cid, min({d}) AS dd
  FROM mem m JOIN fixed_c s ON s.canopy = m.canopy GROUP BY m.symbol, m.canopy),
cl AS (SELECT CAST(dense_rank() OVER (ORDER BY cid) AS INTEGER) AS cluster_no, symbol FROM af)"""


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE\n" + ",\n".join(ctes) + "\n"
