"""Dashboard analytics (G1-G19), every tile a parameterised DataFrame function.

Two frames feed the board: ``daily`` (daily_sales) and ``lines`` (enriched
clean order lines, :func:`enriched_lines`). ``board_frames`` applies the
UNKNOWN exclusion and the store / category / date slice to both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.stats import pearson
from ledgerlark.functions.text import calendar_day
from ledgerlark.operators.crosswalk import CATEGORY_TO_DEPARTMENT
from ledgerlark.operators.daily import join_catalogs, money_sum, to_cents
from ledgerlark.operators.global_rank import key_ranks
from ledgerlark.session import cut_lineage

UNKNOWN = "UNKNOWN"
# Sensitivity / recommendation thresholds.
SENSITIVITY_R = 0.1
RECOMMEND_T, RECOMMEND_P = 0.10, 0.10


def _cents_sum(c: Column) -> Column:
    return to_cents(money_sum(c))


def enriched_lines(clean: DataFrame, new_products: DataFrame, products: DataFrame,
                   daily: DataFrame, mapping: dict | None = None, few_days: bool = False) -> DataFrame:
    """Clean lines + display name, category fallback chain, gross and
    discount per line (guarded division), and the store-day precipitation.
    ``few_days``: the caller has found that the store-days are few enough to broadcast
    (:func:`few_store_days`), so lines aren't moved for them."""
    mapping = CATEGORY_TO_DEPARTMENT if mapping is None else mapping
    npd = new_products.groupBy("new_product_id").agg(
        F.max_by(F.struct("item_name", "department"), "catalog_pos").alias("_np"))
    pd_ = products.groupBy("product_id").agg(
        F.max_by(F.struct("product_name", "category"), "catalog_pos").alias("_p"))
    precip = daily.groupBy("order_date", "store_id").agg(F.max("precipitation_sum").alias("precipitation_sum"))
    precip = F.broadcast(precip) if few_days else precip
    # before the names, which needn't move with it
    lines = clean.join(precip, ["order_date", "store_id"], "left")
    np_, p_ = F.col("_np"), F.col("_p")
    j = join_catalogs(lines, npd, pd_, np_["item_name"].isNotNull() & np_["department"].isNotNull())
    cat_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return with_money(j.select(
        "order_date", "store_id", "product_key", "legacy_product_id", "quantity", "unit_price",
        "discount_pct", "sales_channel",
        F.coalesce(np_["item_name"], p_["product_name"], F.col("product_key")).alias("product_name"),
        F.coalesce(np_["department"], cat_map[p_["category"]], F.lit(UNKNOWN)).alias("category"),
        F.col("line_revenue").alias("net_revenue"), "precipitation_sum"))


BROADCAST_DAYS = 100_000     # rows of two short texts and a number: at most some 20 MB


def few_store_days(daily: DataFrame) -> bool:
    """Whether a stored ``daily`` has few enough store-days for a broadcast. They grow with
    the calendar and the stores, not with the lines; text that isn't a day or
    a store may add to them, so they are counted."""
    return daily.select("order_date", "store_id").distinct().count() <= BROADCAST_DAYS


def with_money(lines: DataFrame) -> DataFrame:
    """G3 + G4: gross revenue and discount of lines that hold their net revenue."""
    q = F.col("quantity").cast("double")
    denom = F.lit(1.0) - F.coalesce(F.col("discount_pct"), F.lit(0.0)) / 100.0
    gross = q * F.col("unit_price") / F.when(denom > 0, denom).otherwise(F.lit(1.0))
    return lines.select("order_date", "store_id", "product_key", "legacy_product_id", "quantity", "unit_price",
                        "discount_pct", "sales_channel", "product_name", "category", "net_revenue",
                        gross.alias("gross_revenue"), (gross - F.col("net_revenue")).alias("discount_given"),
                        "precipitation_sum")


def board_frames(daily: DataFrame, lines: DataFrame, stores: list[str] | None = None,
                 categories: list[str] | None = None, date_from: str | None = None,
                 date_to: str | None = None):
    """G5 + G6: drop UNKNOWN, then slice (empty selection = everything;
    inclusive date range)."""
    def flt(df: DataFrame) -> DataFrame:
        df = df.where(F.col("category") != UNKNOWN)
        if stores:
            df = df.where(F.col("store_id").isin(stores))
        if categories:
            df = df.where(F.col("category").isin(categories))
        if date_from:
            df = df.where(F.col("order_date") >= date_from)
        if date_to:
            df = df.where(F.col("order_date") <= date_to)
        return df
    return flt(daily), flt(lines)


def kpi_totals(daily: DataFrame, lines: DataFrame) -> DataFrame:
    """Net, gross, discount, units, order lines, kept %, AOV, discount
    share -- one aggregation over the union of the two frames."""
    dbl = "double"
    both = (daily.select(F.col("net_revenue").alias("_n"), F.col("gross_revenue").alias("_g"),
                         F.col("discount_given").alias("_d"), F.col("units_sold").alias("_u"),
                         F.lit(0).alias("_line"))
            .unionByName(lines.select(*[F.lit(None).cast(dbl).alias(c) for c in ("_n", "_g", "_d")],
                                      F.lit(None).cast("long").alias("_u"), F.lit(1).alias("_line"))))
    j = both.agg(F.sum(F.col("_n").cast("decimal(38,10)")).alias("net"),
                 F.sum(F.col("_g").cast("decimal(38,10)")).alias("gross"),
                 F.sum(F.col("_d").cast("decimal(38,10)")).alias("disc"),
                 F.coalesce(F.sum("_u"), F.lit(0)).cast("long").alias("units_sold"),
                 F.sum("_line").cast("long").alias("order_lines"))
    net, gross, disc = (F.coalesce(F.col(c), F.lit(0)) for c in ("net", "gross", "disc"))
    return j.select(
        to_cents(net).alias("net_revenue"), to_cents(gross).alias("gross_revenue"),
        to_cents(disc).alias("discount_given"), "units_sold",
        F.coalesce(F.col("order_lines"), F.lit(0)).cast("long").alias("order_lines"),
        F.round(F.when(gross != 0, net / gross * 100).otherwise(0), 4).cast("double").alias("kept_pct"),
        F.round(F.when(F.col("order_lines") > 0, net / F.col("order_lines")).otherwise(0), 4)
         .cast("double").alias("avg_order_value"),
        F.round(F.when(gross != 0, disc / gross * 100).otherwise(0), 4).cast("double").alias("discount_share_pct"))


def daily_series(daily: DataFrame) -> DataFrame:
    """Net and units by date."""
    return daily.groupBy("order_date").agg(
        _cents_sum(F.col("net_revenue")).alias("net_revenue"),
        F.coalesce(F.sum("units_sold"), F.lit(0)).cast("long").alias("units_sold"))


def week_over_week(daily: DataFrame) -> DataFrame:
    """Last day vs exactly seven calendar days earlier (missing -> 0).
    An equi-join of the daily series with itself on (date - 7) -- not
    ``lag(7)``, dates have gaps -- then the row of the latest date. Texts that
    are no calendar day are neither; with none at all the row is NULL."""
    s = daily_series(daily).withColumn("_d", calendar_day(F.col("order_date")))
    prev = s.select(F.col("_d").alias("_pd"), F.col("net_revenue").alias("_pn"),
                    F.col("units_sold").alias("_pu"))
    j = s.join(prev, F.date_sub(s._d, 7) == prev._pd, "left")
    last = j.agg(F.max_by(F.struct("_d", "net_revenue", "units_sold", "_pn", "_pu"), "_d").alias("r"))
    r = F.col("r")
    return last.select(r._d.cast("string").alias("last_day"), F.date_sub(r._d, 7).cast("string").alias("week_before"),
                       F.round(r.net_revenue, 2).alias("net_last_day"),
                       F.round(F.coalesce(r._pn, F.lit(0.0)), 2).alias("net_week_before"),
                       r.units_sold.cast("long").alias("units_last_day"),
                       F.coalesce(r._pu, F.lit(0)).cast("long").alias("units_week_before"))


def window_label(daily: DataFrame) -> DataFrame:
    """First and last date and number of distinct days."""
    return daily.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"),
                     F.count_distinct("order_date").alias("n_days"))


def weather_corr_all(daily: DataFrame, weathers=("temp_max", "precipitation_sum"),
                     measures=("net_revenue", "units_sold"), min_obs: int = 3) -> DataFrame:
    """G11 + G12 for every (weather, measure) pair in one pass: one store-day
    aggregation per category, one per-category aggregation holding all the
    correlations, then an unpivot to one row per (category, weather, measure).

    Per pair, r is emitted only with >= ``min_obs`` store-days and more than
    one distinct value on both sides."""
    def measure(v):
        return (money_sum(F.col(v)).cast("double") if v != "units_sold"
                else F.coalesce(F.sum(v), F.lit(0)).cast("double"))
    sd = (daily.groupBy("category", "order_date", "store_id")
          .agg(*[measure(v).alias(f"v_{v}") for v in measures],
               *[F.avg(w).alias(f"w_{w}") for w in weathers]))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_distinct(f"v_{v}").alias(f"nv_{v}") for v in measures]
    aggs += [F.count_distinct(f"w_{w}").alias(f"nw_{w}") for w in weathers]
    aggs += [pearson(f"v_{v}", f"w_{w}").alias(f"r_{w}__{v}") for w in weathers for v in measures]
    g = sd.groupBy("category").agg(*aggs)
    pairs = [(w, v) for w in weathers for v in measures]
    stacked = g.select("category", "n", F.explode(F.array(*[
        F.struct(F.lit(w).alias("weather"), F.lit(v).alias("measure"),
                 F.col(f"r_{w}__{v}").alias("_r"), F.col(f"nw_{w}").alias("_nw"), F.col(f"nv_{v}").alias("_nv"))
        for w, v in pairs])).alias("p")).select("category", "n", "p.*")
    r = F.col("_r")   # tags read the raw correlation; rounding is for the report only
    tag = F.when(r >= SENSITIVITY_R, "warm-driven").when(r <= -SENSITIVITY_R, "cool-driven").otherwise("neutral")
    return (stacked.where((F.col("n") >= min_obs) & (F.col("_nw") > 1) & (F.col("_nv") > 1))
            .select("category", F.round(r, 6).alias("r"), "n", tag.alias("sensitivity"), "weather", "measure",
                    r.alias("raw_r")))


def weather_corr(daily: DataFrame, weather_col: str = "temp_max", value_col: str = "net_revenue",
                 min_obs: int = 3) -> DataFrame:
    """G11 + G12 for one (weather, measure) pair."""
    return weather_corr_all(daily, (weather_col,), (value_col,), min_obs).drop("weather", "measure", "raw_r")


# Note texts.
NOTE_WARM = ("leans <b>warm</b> — a modest tilt toward selling more on hot "
             "days; worth testing a pre-heat stock/promo, but expect small effects.")
NOTE_COOL = ("leans <b>cool</b> — a modest tilt toward selling more on cooler "
             "days; worth testing a cool-spell hold/promo, but expect small effects.")
NOTE_WET = " Rain nudges it up slightly too."
NOTE_DRY = " It dips a little in the rain."
NOTE_NEUTRAL = ("no meaningful weather signal in this window — treat demand as a "
                "steady baseline; weather is not a useful lever here.")
NOTE_FLAT = "is flat to temperature (r="


def recommendations(daily: DataFrame, value_col: str = "net_revenue",
                    categories: DataFrame | None = None) -> DataFrame:
    """Per category, temperature and precipitation correlations (missing
    -> 0) turned into a tag and a hedged note; ``priority`` orders by |temp r|
    descending, then category."""
    c = weather_corr_all(daily, ("temp_max", "precipitation_sum"), (value_col,))
    wide = c.groupBy("category").agg(
        F.max(F.when(F.col("weather") == "temp_max", F.col("raw_r"))).alias("temp_r"),
        F.max(F.when(F.col("weather") == "precipitation_sum", F.col("raw_r"))).alias("precip_r"))
    cats = categories if categories is not None else daily.select("category").distinct()
    j = (cats.join(wide, "category", "left")
         .withColumn("temp_r", F.coalesce("temp_r", F.lit(0.0)))
         .withColumn("precip_r", F.coalesce("precip_r", F.lit(0.0))))
    j = cut_lineage(j, "recommended")
    tr, pr = F.col("temp_r"), F.col("precip_r")
    tag = (F.when(tr >= RECOMMEND_T, "leans warm").when(tr <= -RECOMMEND_T, "leans cool")
           .when(pr >= RECOMMEND_P, "leans wet").when(pr <= -RECOMMEND_P, "leans dry")
           .otherwise("weather-neutral"))
    temp_note = F.when(tr >= RECOMMEND_T, NOTE_WARM).when(tr <= -RECOMMEND_T, NOTE_COOL)
    rain_note = F.when(pr >= RECOMMEND_P, NOTE_WET).when(pr <= -RECOMMEND_P, NOTE_DRY)
    flat = F.concat(F.lit(NOTE_FLAT), F.format_string("%+.2f", tr), F.lit(")."))
    note = (F.when(temp_note.isNull() & rain_note.isNull(), NOTE_NEUTRAL)
            .otherwise(F.concat(F.coalesce(temp_note, flat), F.coalesce(rain_note, F.lit("")))))
    # strongest temperature signal first
    order = key_ranks(j, {"_strength": F.abs(tr), "_cat": F.col("category")}, descending=("_strength",))
    return (j.join(order, F.col("category").eqNullSafe(F.col("_cat")))
            .select("category", F.round(tr, 6).alias("temp_r"), F.round(pr, 6).alias("precip_r"), tag.alias("tag"),
                    note.alias("note"), (F.col("n_before") + 1).cast("int").alias("priority")))


def revenue_by_store(daily: DataFrame) -> DataFrame:
    """G14."""
    return daily.groupBy("store_id").agg(_cents_sum(F.col("net_revenue")).alias("net_revenue"))


def revenue_by_category(daily: DataFrame) -> DataFrame:
    """With percent of the largest category. The max is a window over
    the per-category aggregate (one row per category, a bounded frame)."""
    from pyspark.sql import Window
    g = daily.groupBy("category").agg(_cents_sum(F.col("net_revenue")).alias("net_revenue"))
    mx = F.max("net_revenue").over(Window.partitionBy())
    return g.select("category", "net_revenue",
                    F.round(F.when(mx != 0, F.col("net_revenue") / mx * 100).otherwise(0.0), 4).alias("pct_of_max"))


def top_products(lines: DataFrame, k: int = 6) -> DataFrame:
    """Top-k display names by net revenue (ties by name). The limit is
    the feature; Spark plans it as a distributed TakeOrderedAndProject."""
    g = lines.groupBy("product_name").agg(_cents_sum(F.col("net_revenue")).alias("net_revenue"))
    return g.orderBy(F.desc("net_revenue"), F.asc("product_name")).limit(k)


def _store_day_rain(lines: DataFrame, mm: float) -> DataFrame:
    pc = lines.where(F.col("precipitation_sum").isNotNull())
    return pc.withColumn("rain", F.col("precipitation_sum") >= mm)


def rain_day_counts(lines: DataFrame, mm: float = 1.0) -> DataFrame:
    """Rain (precip >= mm) and dry store-day counts; NULL precip dropped."""
    sd = (_store_day_rain(lines, mm).groupBy("order_date", "store_id")
          .agg(F.max("rain").alias("rain")))
    return sd.agg(F.count_if(F.col("rain")).alias("rain_store_days"),
                  F.count_if(~F.col("rain")).alias("dry_store_days"))


def channel_mix(lines: DataFrame, mm: float = 1.0) -> DataFrame:
    """Channel share (%) on dry vs rain store-days and the delta in
    points. Lines with NULL channel are excluded from the shares. Side totals
    are window sums over the per-channel aggregate (a bounded frame)."""
    from pyspark.sql import Window
    pc = _store_day_rain(lines, mm).where(F.col("sales_channel").isNotNull())
    g = pc.groupBy("sales_channel").agg(
        F.count_if(~F.col("rain")).alias("dry_lines"), F.count_if(F.col("rain")).alias("rain_lines"))
    allw = Window.partitionBy()
    dry = F.try_divide(F.col("dry_lines") * 100.0, F.sum("dry_lines").over(allw))
    rain = F.try_divide(F.col("rain_lines") * 100.0, F.sum("rain_lines").over(allw))
    return g.select("sales_channel", "dry_lines", "rain_lines",
                    F.round(dry, 4).alias("dry_pct"), F.round(rain, 4).alias("rain_pct"),
                    F.round(rain - dry, 4).alias("delta_pts"))


def rain_lift_mean(lines: DataFrame, thresholds=(1.0, 10.0)) -> DataFrame:
    """Per threshold: mean store-day net on rain vs dry days (precip >=
    mm), lift %, and how many stores have rain mean > dry mean. NULL when a
    threshold gives no rain/dry contrast."""
    # summed once; store-days, not lines, are repeated for each threshold
    sd = (lines.where(F.col("precipitation_sum").isNotNull()).groupBy("order_date", "store_id")
          .agg(F.sum(F.col("net_revenue").cast("decimal(38,10)")).cast("double").alias("rev"),
               F.max("precipitation_sum").alias("_most"))
          .withColumn("mm", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
          .withColumn("r", F.col("_most") >= F.col("mm")))
    per_store = (sd.groupBy("mm", "store_id")
                 .agg(F.avg(F.when(F.col("r"), F.col("rev"))).alias("_rm"),
                      F.avg(F.when(~F.col("r"), F.col("rev"))).alias("_dm"))
                 .groupBy("mm").agg(F.count_if(F.coalesce(F.col("_rm") > F.col("_dm"), F.lit(False)))
                                    .alias("stores_agree"),
                                    F.count(F.lit(1)).alias("n_stores")))
    overall = sd.groupBy("mm").agg(
        F.avg(F.when(F.col("r"), F.col("rev"))).alias("_rain"),
        F.avg(F.when(~F.col("r"), F.col("rev"))).alias("_dry"),
        F.count_distinct("r").alias("_nr"))
    lift = F.when(F.col("_nr") == 2, F.round((F.col("_rain") / F.col("_dry") - 1) * 100, 4))
    return (overall.join(per_store, "mm")
            .select(F.col("mm").alias("threshold_mm"), lift.alias("mean_lift_pct"),
                    F.when(F.col("_nr") == 2, F.col("stores_agree")).alias("stores_agree"), "n_stores"))
