"""Weather-sensitivity statistics (H1-H10), frozen-window conventions.

Rain day here is strict ``max(precip) > rain_mm`` at store-day grain, and
lifts are medians (exact, computed distributed by ``quantile.exact_median``). NULL precipitation is
neither rain nor dry. Rank correlations use average ranks for ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.stats import pearson, rank_corr_p, two_sided_normal_p
from ledgerlark.operators.global_rank import average_ranks
from ledgerlark.operators.quantile import exact_median
from ledgerlark.session import cut_lineage

RAIN_MM = 1.0
THRESHOLDS = (0.4, 1.0, 5.0, 10.0)
ALPHA = 0.05


def store_days(daily: DataFrame) -> DataFrame:
    """H1: (date, store) -> net (cents), max precip, max temp. Includes UNKNOWN."""
    return daily.groupBy("order_date", "store_id").agg(
        F.round(F.sum(F.col("net_revenue").cast("decimal(38,10)")), 2).cast("double").alias("net_revenue"),
        F.max("precipitation_sum").alias("precipitation_sum"),
        F.max("temp_max").alias("temp_max"))


def channel_shift(clean: DataFrame, sd: DataFrame, rain_mm: float = RAIN_MM,
                  channel: str = "pickup") -> DataFrame:
    """H2 + H3: line counts per channel on rain vs dry store-days, shares,
    and the pooled two-proportion z test on ``channel``'s share."""
    flags = sd.select("order_date", "store_id",
                      (F.col("precipitation_sum") > rain_mm).alias("rain"))
    j = clean.select("order_date", "store_id", "sales_channel").join(flags, ["order_date", "store_id"])
    j = j.where(F.col("rain").isNotNull())
    hit = F.col("sales_channel") == channel
    g = j.agg(F.count_if(F.col("rain")).alias("n_rain"), F.count_if(~F.col("rain")).alias("n_dry"),
              F.count_if(F.col("rain") & hit).alias("k_rain"), F.count_if(~F.col("rain") & hit).alias("k_dry"))
    p1 = F.try_divide(F.col("k_rain").cast("double"), F.col("n_rain"))
    p2 = F.try_divide(F.col("k_dry").cast("double"), F.col("n_dry"))
    pool = F.try_divide((F.col("k_rain") + F.col("k_dry")).cast("double"), F.col("n_rain") + F.col("n_dry"))
    se = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1.0), F.col("n_rain"))
                                     + F.try_divide(F.lit(1.0), F.col("n_dry"))))
    z = F.try_divide(p1 - p2, se)
    out = g.select("n_rain", "n_dry", "k_rain", "k_dry",
                   F.round(p1 * 100, 4).alias("share_rain_pct"), F.round(p2 * 100, 4).alias("share_dry_pct"),
                   z.alias("_z"))
    return (out.withColumn("z", F.round("_z", 6))
            .withColumn("p_value", F.round(two_sided_normal_p(F.col("_z")), 6)).drop("_z"))


def channel_counts(clean: DataFrame, sd: DataFrame, rain_mm: float = RAIN_MM) -> DataFrame:
    """H2 table: per channel, lines and share on rain vs dry store-days;
    denominators include every line on that side (NULL channel too)."""
    flags = sd.select("order_date", "store_id", (F.col("precipitation_sum") > rain_mm).alias("rain"))
    j = (clean.select("order_date", "store_id", "sales_channel")
         .join(flags, ["order_date", "store_id"]).where(F.col("rain").isNotNull()))
    per = j.groupBy("sales_channel").agg(F.count_if(F.col("rain")).alias("rain_lines"),
                                         F.count_if(~F.col("rain")).alias("dry_lines"))
    allw = Window.partitionBy()    # over the per-channel aggregate (a bounded frame)
    return per.select("sales_channel", "rain_lines", "dry_lines",
                      F.round(F.try_divide(F.col("rain_lines") * 100.0, F.sum("rain_lines").over(allw)), 4)
                      .alias("rain_pct"),
                      F.round(F.try_divide(F.col("dry_lines") * 100.0, F.sum("dry_lines").over(allw)), 4)
                      .alias("dry_pct"))


def rain_lift_median(sd: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """H4: per threshold, (median rain-day net / median dry-day net - 1) * 100
    over all store-days (strict ``>``), and how many stores have a rainy
    median above their dry median (a store without rain or dry days does not
    count). Medians are exact and distributed (``quantile.exact_median``)."""
    x = (sd.where(F.col("precipitation_sum").isNotNull())
         .withColumn("mm", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
         .withColumn("r", F.col("precipitation_sum") > F.col("mm")))
    # overall (store "*") and per-store medians in one distributed median
    both = (x.select("mm", "r", "net_revenue", F.lit("*").alias("_store"))
            .unionByName(x.select("mm", "r", "net_revenue", F.col("store_id").alias("_store"))))
    m = exact_median(both, ["mm", "_store", "r"], "net_revenue")
    overall = (m.where(F.col("_store") == "*").groupBy("mm")
               .agg(F.max(F.when(F.col("r"), F.col("median"))).alias("_mr"),
                    F.max(F.when(~F.col("r"), F.col("median"))).alias("_md")))
    ms = m.where(F.col("_store") != "*").withColumnRenamed("_store", "store_id")
    per_store = (ms.groupBy("mm", "store_id")
                 .agg(F.max(F.when(F.col("r"), F.col("median"))).alias("_sr"),
                      F.max(F.when(~F.col("r"), F.col("median"))).alias("_sd")))
    # every store in x has a median on at least one side, so per_store lists them all
    agree = per_store.groupBy("mm").agg(
        F.count_if(F.coalesce(F.col("_sr") > F.col("_sd"), F.lit(False))).alias("stores_with_lift"),
        F.count(F.lit(1)).alias("n_stores"))
    lift = F.round((F.try_divide(F.col("_mr"), F.col("_md")) - 1) * 100, 4)
    return (x.select("mm").distinct().join(overall, "mm", "left").join(agree, "mm")
            .select(F.col("mm").alias("threshold_mm"), lift.alias("median_lift_pct"),
                    "stores_with_lift", "n_stores"))


def store_mix(sd: DataFrame, rain_mm: float = RAIN_MM) -> DataFrame:
    """H5: per store: rain days, days, rain share, median daily net (exact,
    distributed)."""
    return _store_mix(sd, rain_mm).withColumn("rain_share", F.round("rain_share", 6))


def _store_mix(sd: DataFrame, rain_mm: float) -> DataFrame:
    counts = sd.groupBy("store_id").agg(
        F.count_if(F.col("precipitation_sum") > rain_mm).alias("rain_days"),
        F.count(F.lit(1)).alias("days"),
        (F.count_if(F.col("precipitation_sum") > rain_mm) / F.count(F.lit(1))).alias("rain_share"))
    med = exact_median(sd, ["store_id"], "net_revenue").withColumnRenamed("median", "median_daily_net")
    return counts.join(med, "store_id", "left")


def average_rank(value: Column, partition: list[str]) -> Column:
    """Average rank of ``value`` within ``partition`` (ties share the mean
    of their positions)."""
    w_order = Window.partitionBy(*partition).orderBy(value)
    w_ties = Window.partitionBy(*partition, value)
    return F.rank().over(w_order) + (F.count(F.lit(1)).over(w_ties) - 1) / 2.0


def spearman(df: DataFrame, x: str, y: str, group: list[str]) -> DataFrame:
    """Spearman rho per group (Pearson on average ranks), n, and the
    two-sided p from t = rho*sqrt((n-2)/(1-rho^2)) with n-2 dof. Rows with a
    NULL on either side are ignored. A constant side gives NULL rho."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    d = d.withColumn("_rx", average_rank(F.col(x), group)).withColumn("_ry", average_rank(F.col(y), group))
    g = d.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                              F.count_distinct(x).alias("_nx"), F.count_distinct(y).alias("_ny"),
                              pearson("_rx", "_ry").alias("_rho"))
    rho = F.when((F.col("_nx") > 1) & (F.col("_ny") > 1), F.col("_rho"))
    return _rho_row(g.withColumn("_rho_ok", rho), group)


def _rho_row(g: DataFrame, group: list[str]) -> DataFrame:
    return g.select(*group, "n", F.round("_rho_ok", 6).alias("rho"),
                    F.round(rank_corr_p(F.col("_rho_ok"), F.col("n")), 6).alias("p_value"))


def spearman_overall(df: DataFrame, x: str, y: str) -> DataFrame:
    """:func:`spearman` over all rows as one group of any size; one row, also of
    an empty table (n 0)."""
    d = cut_lineage(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y), "rank_input")
    g = d.join(average_ranks(d, x, "_rx"), x).join(average_ranks(d, y, "_ry"), y).agg(
        F.count(F.lit(1)).alias("n"), F.min(x).alias("_x0"), F.max(x).alias("_x1"),
        F.min(y).alias("_y0"), F.max(y).alias("_y1"), pearson("_rx", "_ry").alias("_rho"))
    varies = (F.col("_x0") != F.col("_x1")) & (F.col("_y0") != F.col("_y1"))
    return _rho_row(g.withColumn("_rho_ok", F.when(varies, F.col("_rho"))), [])


def share_vs_median(sd: DataFrame, rain_mm: float = RAIN_MM) -> DataFrame:
    """H6: Spearman between store rain-day share (not rounded) and store median daily net
    (one row per store as input, ranked over any number of stores)."""
    return spearman_overall(_store_mix(sd, rain_mm), "rain_share", "median_daily_net")


def spearman_by_store(sd: DataFrame, weathers=("temp_max", "precipitation_sum")) -> DataFrame:
    """H7: per store, rho(net, temp_max) and rho(net, precip). One pass: the
    store-day frame is stacked into one row per (weather, store-day) and
    ranked per (store, weather), so net revenue is ranked within each test's
    own non-NULL rows, exactly as a separate test would."""
    stacked = sd.select("store_id", "net_revenue", F.explode(F.array(*[
        F.struct(F.lit(w).alias("weather"), F.col(w).cast("double").alias("w")) for w in weathers])).alias("t"))
    stacked = stacked.select("store_id", "net_revenue", "t.weather", "t.w")
    return spearman(stacked, "net_revenue", "w", ["store_id", "weather"]).select(
        "store_id", "weather", "n", "rho", "p_value")


def significance_screen(tests: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """H8: tests with p < alpha, with the total number of tests."""
    # tests is one row per test (bounded); the total is a window count
    counted = tests.withColumn("n_tests", F.count(F.lit(1)).over(Window.partitionBy()))
    return counted.where(F.col("p_value") < alpha)


def effective_sample(daily: DataFrame) -> DataFrame:
    """Rows vs independent (date, store) observations."""
    return daily.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_distinct("order_date", "store_id").alias("n_store_days"))
