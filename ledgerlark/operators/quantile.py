"""Exact median per group without gathering a group into one task.

``F.median`` keeps every value of a group in one aggregation buffer. Here
each target rank (the lower and upper middle element) is found by range
refinement:

1. per group: count, min, max (partial aggregates);
2. each round, the candidate range [lo, hi] of every target is cut into
   ``buckets`` equal-width buckets. Per-bucket counts and exact min/max come
   from one partial aggregate. A window over at most ``buckets`` rows per
   target finds the bucket holding the target rank, which becomes the next
   range (its exact min and max);
3. once a range holds at most ``max_exact`` values, or a single distinct
   value, the element is picked with a window over that bounded slice.

The per-round state (one row per group and target) is tiny; only a
convergence count reaches the driver. The result uses Spark's own
interpolation, ``lower + (upper - lower) * 0.5``, so it equals ``median``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, keys: list[str], value: str, buckets: int = 4096,
                 max_exact: int = 100_000) -> DataFrame:
    """(keys..., median) over the finite ``value`` of each group; NULL, NaN and
    infinities are no values."""
    v = (df.select(*keys, F.col(value).cast("double").alias("_v"))
         .where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < F.lit(float("inf")))))
    stats = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"),
                                 F.max("_v").alias("_hi"))
    # two targets per group: 0-based ranks floor((n-1)/2) and floor(n/2)
    state = stats.select(*keys, "_n", F.explode(F.array(F.lit(0), F.lit(1))).alias("_t"), "_lo", "_hi")
    state = state.select(*keys, "_n", "_t", "_lo", "_hi",
                         F.when(F.col("_t") == 0, F.floor((F.col("_n") - 1) / 2))
                          .otherwise(F.floor(F.col("_n") / 2)).cast("long").alias("_k"),
                         F.lit(0).cast("long").alias("_below"),      # values < _lo
                         F.col("_n").alias("_cnt"))                  # values in [_lo, _hi]
    while True:
        # a range's own minimum and maximum fall into different buckets, so
        # every round leaves out at least one distinct value and it ends
        open_ = state.where((F.col("_cnt") > max_exact) & (F.col("_lo") < F.col("_hi")))
        if open_.isEmpty():
            break
        # halved, so the widest range doesn't overflow; the narrowest has no
        # room between its ends and is cut into those
        half = F.col("_hi") / 2 - F.col("_lo") / 2
        place = F.when(half > 0, F.least(F.floor(
            F.try_divide(F.col("_v") / 2 - F.col("_lo") / 2, half) * buckets).cast("long"), F.lit(buckets - 1)))
        place = place.otherwise(F.when(F.col("_v") > F.col("_lo"), F.lit(buckets - 1)).otherwise(F.lit(0)))
        cand = (v.join(open_.select(*keys, "_t", "_lo", "_hi"), keys)
                .where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
                .withColumn("_b", place))
        hist = cand.groupBy(*keys, "_t", "_b").agg(F.count(F.lit(1)).alias("_c"),
                                                    F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
        w = Window.partitionBy(*keys, "_t").orderBy("_b")   # at most `buckets` rows per target
        hist = hist.withColumn("_cum", F.sum("_c").over(w))
        j = hist.join(open_.select(*keys, "_t", "_k", "_below"), keys + ["_t"])
        # the bucket holding rank k: first bucket whose cumulative count passes k - below
        hit = (j.where(F.col("_below") + F.col("_cum") > F.col("_k"))
               .withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_t").orderBy("_b")))
               .where(F.col("_r") == 1)
               .select(*keys, "_t", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"),
                       (F.col("_below") + F.col("_cum") - F.col("_c")).alias("_below"),
                       F.col("_c").alias("_cnt")))
        done = state.join(open_.select(*keys, "_t"), keys + ["_t"], "left_anti")
        refined = open_.select(*keys, "_n", "_t", "_k").join(hit, keys + ["_t"])
        state = _materialise(done.unionByName(refined.select(*done.columns)))
    # a range holding one distinct value is its own answer (a hot value never
    # reaches a window); other ranges are small and picked with a window
    single = state.where(F.col("_lo") == F.col("_hi")).select(*keys, "_t", F.col("_lo").alias("_x"))
    many = state.where(F.col("_lo") < F.col("_hi"))
    final = (v.join(many.select(*keys, "_t", "_lo", "_hi", "_k", "_below"), keys)
             .where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))))
    pos = F.row_number().over(Window.partitionBy(*keys, "_t").orderBy("_v")) - 1
    picked = (final.withColumn("_p", pos).where(F.col("_p") == F.col("_k") - F.col("_below"))
              .select(*keys, "_t", F.col("_v").alias("_x")))
    both = single.unionByName(picked).groupBy(*keys).agg(
        F.min(F.when(F.col("_t") == 0, F.col("_x"))).alias("_a"),
        F.min(F.when(F.col("_t") == 1, F.col("_x"))).alias("_b"))
    return both.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.lit(0.5)).alias("median"))


def _materialise(state: DataFrame) -> DataFrame:
    """The per-round state is one row per (group, target): cut its lineage so
    the loop does not grow the plan."""
    from ledgerlark.session import cut_lineage
    return cut_lineage(state, "median_state")
