"""A9-A10, F11 on cached JSON pulls; A5 as an availableNow file stream."""
import json
import os

from pyspark.sql import functions as F

from ledgerlark.operators import daily
from ledgerlark.sources import weather_json
from ledgerlark.streaming import incremental


def _pull(path, store, start, end, days, precip):
    doc = {"latitude": 35.9, "longitude": -83.9, "timezone": "America/New_York",
           "daily": {"time": days, "temperature_2m_max": [30.0 + i for i in range(len(days))],
                     "temperature_2m_min": [20.0] * len(days), "precipitation_sum": precip,
                     "weather_code": [3] * len(days)}}
    with open(os.path.join(path, f"{store}_{start}_{end}.json"), "w") as f:
        json.dump(doc, f)


def test_weather_pulls(spark, tmp):
    days = ["2026-07-07", "2026-07-08", "2026-07-09"]
    _pull(tmp, "S001", "2026-07-07", "2026-07-08", days[:2], [0.5, 1.0])
    _pull(tmp, "S001", "2026-07-07", "2026-07-09", days, [0.5, 1.4, None])
    _pull(tmp, "S002", "2026-07-07", "2026-07-09", days, [0.0, 0.0, 2.0])
    pulls = weather_json.read_pulls(spark, tmp)
    assert pulls.count() == 8
    latest = {(r.store_id, r.weather_date): r.precipitation_sum for r in daily.weather_latest(pulls).collect()}
    assert latest[("S001", "2026-07-08")] == 1.4 and latest[("S001", "2026-07-09")] is None
    rev = daily.weather_revisions(pulls).collect()
    assert [(r.weather_date, r.precip_first, r.precip_last, r.crosses_threshold) for r in rev] == \
        [("2026-07-08", 1.0, 1.4, 1)]
    clean = spark.createDataFrame([("2026-07-07",), ("2026-07-09",), ("",)], "order_date string")
    snap = weather_json.select_snapshot(pulls, clean)
    assert snap.select("pull_file").distinct().count() == 2 and snap.count() == 6


def test_incremental_stream(spark, tmp):
    landing, raw = os.path.join(tmp, "landing"), os.path.join(tmp, "raw")
    os.makedirs(landing)
    hdr = "order_id,order_date,store_id,product_id,quantity,unit_price,discount_pct,sales_channel,loyalty_member"

    def put(name, n):
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join([hdr] + [f"{name[7:17]}-{i},{name[7:17]},S001,P1,1,1.00,0,pickup,Y"
                                       for i in range(n)]) + "\n")

    put("orders_2026-07-01.csv", 3)
    put("orders_2026-07-02.csv", 2)
    ckpt = os.path.join(tmp, "ckpt")
    incremental.start(spark, landing, raw, ckpt, ingested_at="t1")
    assert spark.read.parquet(raw).count() == 5
    # a late backfill and a second file for an already-loaded date
    put("orders_2026-06-30.csv", 4)
    put("orders_20260701.csv", 7)
    incremental.start(spark, landing, raw, ckpt, ingested_at="t2")
    got = {str(r.file_date): r["count"] for r in spark.read.parquet(raw).groupBy("file_date").count().collect()}
    assert got == {"2026-06-30": 4, "2026-07-01": 3, "2026-07-02": 2}


def test_replayed_batch_loads_nothing_twice(spark, tmp):
    """foreachBatch may run an epoch again after a failure: loading is
    idempotent by date, so a replay adds no rows."""
    from ledgerlark.sources import feed_csv
    landing, raw = os.path.join(tmp, "landing"), os.path.join(tmp, "raw")
    os.makedirs(landing)
    hdr = "order_id,order_date,store_id,product_id,quantity,unit_price,discount_pct,sales_channel,loyalty_member"
    with open(os.path.join(landing, "orders_2026-07-10.csv"), "w") as f:
        f.write("\n".join([hdr] + [f"a{i},2026-07-10,S001,P1,1,1.00,0,pickup,Y" for i in range(4)]) + "\n")
    batch = feed_csv.file_cells(feed_csv.csv_options(spark.read).csv(landing))
    incremental.load_batch(batch, raw, "t1")
    incremental.load_batch(batch, raw, "t1")          # the replay
    got = spark.read.parquet(raw)
    assert got.count() == 4 and got.select("raw_id").distinct().count() == 4
