"""The batch pipeline writes every stage table and re-reads it."""
import os

from ledgerlark.plans.pipeline import FeedPipeline

SF = "/root/testdata/sf0.001"


def test_run_writes_stage_tables(spark, tmp):
    lazy = FeedPipeline(spark, SF, materialize=False)
    want_clean, want_daily = lazy.clean.count(), lazy.daily.count()
    paths = FeedPipeline(spark, SF, materialize=False).run(os.path.join(tmp, "out"))
    from ledgerlark import schemas
    assert set(paths) == {*schemas.TABLES, "tagged_orders", "scored_pairs"}
    assert spark.read.parquet(paths["clean_orders"]).count() == want_clean
    assert spark.read.parquet(paths["daily_sales"]).count() == want_daily
    # full rebuild: running again replaces, never appends
    paths = FeedPipeline(spark, SF, materialize=False).run(os.path.join(tmp, "out"))
    assert spark.read.parquet(paths["clean_orders"]).count() == want_clean
    # month partitions: a one-month slice reads one folder
    d = spark.read.parquet(paths["daily_sales"]).where("order_month = '1996-03'")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert d.count() == lazy.daily.where("order_date like '1996-03-%'").count()


def test_real_files_to_daily_sales(spark, tmp):
    """Small files of every kind, through the command line, every table read back."""
    import json

    from ledgerlark import __main__ as cli

    def put(name, *lines):
        path = os.path.join(tmp, "in", name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        return path

    legacy = "order_id,order_date,store_id,product_id,quantity,unit_price,discount_pct,sales_channel,loyalty_member"
    put("feed/orders_2026-07-01.csv", legacy,
        "a1,2026-07-01,S001,P1,2,10.00,0,pickup,Y", "a2,2026-07-01,S001,P2,1,$ 8.00,20,in_store,N",
        "a1,2026-07-01,S001,P1,2,10.00,0,pickup,Y")                       # repeated
    put("feed/orders_2026-07-02.csv", legacy.replace("product_id", "new_product_id"),
        "b1,2026-07-02,S002,N1,3,11.00,0,pickup,Y", "b2,,S002,N1,1,11.00,0,pickup,Y",   # no date: rejected
        "b3,2026-07-02,S002,N9,1,5.00 $,0,in_store,")                     # unknown product
    put("feed/orders_2026-07-03.csv", legacy)                             # header only
    products = put("products.csv", "product_id,product_name,category,subcategory,brand,base_price,margin_rate,launch_date,active",
                   "P1,Tent One,camping,tents,B,10.00,0.3,2020-01-01,Y", "P2,Stove,camping,stoves,B,10.00,0.3,2020-01-02,Y")
    new = put("new_products.csv", "new_product_id,item_name,department,class,brand_name,msrp,gross_margin,launch_date,active",
              "N1,Tent One,camping,tents,B,11.00,0.3,2020-01-01,Y")
    stores = put("stores.csv", "store_id,store_name,city,state,latitude,longitude,region,store_type,opened_date",
                 "S001,a,b,c,1,2,d,e,f", "S002,a,b,c,1,2,d,e,f")
    for store, rain in (("S001", [0.0, 5.0]), ("S002", [1.0, 7.0])):
        daily = {"time": ["2026-07-01", "2026-07-02"], "temperature_2m_max": [20.0, 21.0],
                 "temperature_2m_min": [10.0, 11.0], "precipitation_sum": rain, "weather_code": [1, 2]}
        put(f"pulls/{store}_2026-07-01_2026-07-02.json", json.dumps({"latitude": 1.0, "daily": daily}))
        put(f"pulls/{store}_2026-07-01_2026-07-31.json", json.dumps({"latitude": 1.0, "daily": {
            **daily, "precipitation_sum": [9.0, 9.0]}}))                   # another range: not this run's
    out = os.path.join(tmp, "out")
    assert cli.main(["run", "--feed", os.path.join(tmp, "in/feed/*.csv"), "--products", products, "--new-products", new,
                     "--stores", stores, "--pulls", os.path.join(tmp, "in/pulls/*.json"), "--out", out]) == 0
    t = lambda n: spark.read.parquet(f"{out}/{n}")
    assert t("raw_orders").count() == 6 and t("stores").count() == 2
    assert {(r.source_date_expected, r.status, r.rows_loaded) for r in t("ingestion_log").collect()} == {
        ("2026-07-01", "success", 3), ("2026-07-02", "success", 3), ("2026-07-03", "empty", 0)}
    flags = {r.file_name: r.flags for r in t("data_quality_log").collect()}
    assert "duplicates" in flags["orders_2026-07-01.csv"] and "orphans" in flags["orders_2026-07-02.csv"]
    assert flags["orders_2026-07-03.csv"] == "empty"
    assert {(r.product_id, r.new_product_id) for r in t("product_crosswalk").collect()} == {("P1", "N1"), ("P2", None)}
    assert {r.order_id for r in t("clean_orders").collect()} >= {"a1", "a2", "b1"}
    assert sorted(r.order_id for r in t("rejected_rows").collect()).count("b2") == 1
    assert t("weather_daily").count() == 4
    sales = {(r.order_date, r.store_id, r.category_source): (r.net_revenue, r.precipitation_sum)
             for r in t("daily_sales").collect()}
    assert sales["2026-07-02", "S002", "new_system"] == (33.0, 7.0)
    assert sum(v for v, _ in sales.values()) == 20.0 + 8.0 + 33.0 + 5.0
