"""Mixing sources to target weights by Pfair scheduling.

A source with weight ``w`` of a total ``W`` gets its ``i``-th block (from 0) released at ``floor(i * W / w)``
and due by ``ceil((i + 1) * W / w)``; earliest deadline first, one block a slot, then keeps every source
within less than one block of ``slots * w / W`` at any slot. All windows repeat after ``W`` slots, where
every source is exactly on target, so the schedule of one period, a fold over its slots in SQL, places any
number of blocks: block ``i`` has slot ``floor(i / w) * W + slot in the period of block (i mod w)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

REST = "*"  # the stream of every source without a weight of its own
LANE_DIGITS = 2  # leading hex digits of the order key that name a lane of a stream


def schedule(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """``(stream, weight, i, slot, period)``: one period of the EDF schedule; equal deadlines go by name.

    ``weights`` are whole numbers of blocks in each period, at least 1. The fold holds one entry per
    stream and makes ``sum(weights)`` steps, both set by the parameter and not by the data."""
    if any(w < 1 or w != int(w) for w in weights.values()):
        raise ValueError("weights are whole numbers of at least 1")
    entries = F.array(*[F.struct(F.lit(int(weights[k])).cast("long").alias("weight"), F.lit(k).alias("name")) for k in sorted(weights)])
    state = spark.range(1).select(entries.alias("s"), F.lit(sum(weights.values())).cast("long").alias("period"))
    fold = """
      aggregate(sequence(0L, period - 1),
        named_struct('i', transform(s, x -> 0L), 'out', cast(array() as array<int>)),
        (acc, t) -> aggregate(array(array_min(filter(transform(s, (x, k) -> named_struct(
              'due', (acc.i[k] + 1) * period div x.weight + if((acc.i[k] + 1) * period % x.weight > 0, 1L, 0L),
              'k', k, 'free', acc.i[k] * period div x.weight <= t)), y -> y.free)).k), acc,
            (a, p) -> named_struct('i', transform(a.i, (n, k) -> if(k = p, n + 1, n)), 'out', array_append(a.out, p)))).out"""
    slots = state.selectExpr("s", "period", f"posexplode({fold}) as (slot, k)").select(
        F.expr("s[k].name").alias("stream"), F.expr("s[k].weight").alias("weight"), F.col("slot").cast("long"), "period", "k")
    return (slots.withColumn("i", (F.row_number().over(Window.partitionBy("k").orderBy("slot")) - 1).cast("long"))
            .select("stream", "weight", "i", "slot", "period"))


def mix(docs: DataFrame, weights: dict[str, int], rest: int = 1, id_col: str = "doc_id", source_col: str = "source",
        size_col: str = "n_chars", block_size: int = 65_536) -> DataFrame:
    """All rows of ``docs`` with ``stream``, ``start``, ``block`` and ``slot``; the mixture is in slot order.

    ``weights`` holds the target weight of each source as a whole number; sources without one, null among
    them, share the stream ``"*"`` of weight ``rest``. Rows of a stream follow one another by the MD5 of
    their id, then id and size; ``start`` is the size of the rows before, ``block`` counts ``block_size`` of it, and
    ``slot`` is the block's place in the schedule. Slots of a stream that has run out stay empty, so the
    others keep their relative rates and no row is dropped or repeated.

    Null or negative sizes count as 0, null ids come first by an empty key, repeated rows each get a place.
    Input columns named like a result column are replaced. An empty table gives an empty result. A stream is
    ranked in 256 lanes of its key, whose sizes are summed up front, so a hot source is never in one task.
    """
    target = {**weights, REST: rest}
    own = docs.drop("stream", "start", "block", "slot")
    source = F.col(source_col).cast("string")
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    listed = [k for k in sorted(weights) if k != REST]
    stream = F.when(source.isin(*listed), source).otherwise(F.lit(REST)) if listed else F.lit(REST)
    rows = (own.withColumn("stream", stream).withColumn("__mix_key", key)
            .withColumn("__mix_lane", F.substring("__mix_key", 1, LANE_DIGITS))
            .withColumn("__mix_size", F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0))))
    ahead = Window.partitionBy("stream", "__mix_lane").orderBy("__mix_key", id_col, "__mix_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__mix_ahead", F.coalesce(F.sum("__mix_size").over(ahead), F.lit(0)))
    lanes = (own.select(stream.alias("stream"), F.substring(key, 1, LANE_DIGITS).alias("__mix_lane"),
                        F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0)).alias("__mix_size"))
             .groupBy("stream", "__mix_lane").agg(F.sum("__mix_size").alias("__mix_size")))
    before = Window.partitionBy("stream").orderBy("__mix_lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.select("stream", "__mix_lane", F.coalesce(F.sum("__mix_size").over(before), F.lit(0)).alias("__mix_before"))
    # at most 16 ** LANE_DIGITS rows per stream, and one row per slot of the period: bounded by the parameters
    rows = rows.join(F.broadcast(lanes), ["stream", "__mix_lane"]).withColumn("start", F.col("__mix_ahead") + F.col("__mix_before"))
    plan = schedule(docs.sparkSession, target)
    share = F.create_map(*[F.lit(x) for k in sorted(target) for x in (k, int(target[k]))])
    rows = (rows.withColumn("block", F.expr(f"start div {int(block_size)}L"))
            .withColumn("__mix_weight", share[F.col("stream")].cast("long")))
    plan = plan.select(F.col("stream").alias("__mix_stream"), F.col("i").alias("__mix_i"), F.col("slot").alias("__mix_slot"), F.col("period").alias("__mix_period"))
    return (rows.join(F.broadcast(plan), (F.col("stream") == F.col("__mix_stream")) & (F.col("block") % F.col("__mix_weight") == F.col("__mix_i")))
            .withColumn("slot", F.expr("block div __mix_weight * __mix_period + __mix_slot"))
            .drop("__mix_key", "__mix_lane", "__mix_size", "__mix_ahead", "__mix_before", "__mix_weight", "__mix_stream", "__mix_i", "__mix_slot", "__mix_period"))


def interleaved(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """The rows and columns of ``docs`` in the order of the mixture: range-partitioned and sorted by slot."""
    out = mix(docs, *args, **kwargs)
    ordered = out.repartitionByRange("slot", "stream", "start").sortWithinPartitions("slot", "stream", "start")
    return ordered.select(*[c for c in docs.columns])
