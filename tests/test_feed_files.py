"""A1-A6 on real CSV files, then B1 / C gate and D cleaning over them."""
import os

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import cleaning, quality
from ledgerlark.sources import feed_csv

LEGACY = "order_id,order_date,store_id,product_id,quantity,unit_price,discount_pct,sales_channel,loyalty_member"
NEWID = LEGACY.replace("product_id", "new_product_id", 1)
REORDERED = ("order_date,order_id,new_product_id,store_id,sales_channel,loyalty_member,quantity,"
             "discount_pct,unit_price")
MISLABELED = LEGACY + ",product_id_source"


def _rows(date, n, start=1, prod="P1001", price="10.00"):
    return [f"{date.replace('-', '')}-{i:04d},{date},S00{(i % 8) + 1},{prod},2,{price},0,in_store,Y"
            for i in range(start, start + n)]


FILES = {
    "orders_2026-07-07.csv": (LEGACY, _rows("2026-07-07", 3) + ["20260707-0009,2026-07-07,S001,P1002,1,5.00,,pickup,NA"], "\n"),
    "orders_2026-07-16.csv": (LEGACY, _rows("2026-07-16", 3) + _rows("2026-07-16", 2), "\n"),
    "orders_2026-07-23.csv": (LEGACY, _rows("2026-07-23", 4), "\n"),
    "orders_2026-07-24.csv": (LEGACY, _rows("2026-07-23", 4), "\n"),
    "orders_2026-07-28.csv": (NEWID, _rows("2026-07-28", 3, prod="NP5001"), "\r\n"),
    "orders_2026-07-30.csv": (NEWID, _rows("2026-07-30", 2, prod="NP5001") + _rows("2026-07-30", 2, 5, prod="NP9999"), "\n"),
    "orders_2026-08-03.csv": (NEWID, [], "\n"),
    "orders_2026-08-05.csv": (NEWID, _rows("2026-08-05", 3, prod="NP5002", price="$72.70"), "\n"),
    "orders_2026-08-07.csv": (REORDERED, ["2026-08-07,20260807-0001,NP5003,S002,pickup,N,4,10,18.00"], "\n"),
    "orders_2026-08-08.csv": (MISLABELED, [r + ",new_system" for r in _rows("2026-08-08", 2, prod="NP5004")], "\n"),
}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    for name, (hdr, rows, nl) in FILES.items():
        with open(d / name, "w", newline="") as f:
            f.write(nl.join([hdr] + rows) + nl)
    return str(d)


@pytest.fixture(scope="module")
def refs(spark):
    stores = spark.createDataFrame([(f"S00{i}",) for i in range(1, 9)], "store_id string")
    legacy = spark.createDataFrame([(f"P{1000 + i}",) for i in range(1, 11)], "product_id string")
    new = spark.createDataFrame([(f"NP{5000 + i}",) for i in range(1, 11)], "new_product_id string")
    return stores, legacy, new


def test_header_agnostic_read(spark, landing):
    raw = feed_csv.read_orders(spark, landing, ingested_at="2026-08-09T00:00:00Z")
    assert raw.count() == sum(len(r) for _, r, _ in FILES.values())
    r = raw.where(F.col("source_file") == "orders_2026-08-07.csv").first()
    assert (r.order_id, r.new_product_id, r.store_id, r.unit_price, r.discount_pct, r.quantity) == \
        ("20260807-0001", "NP5003", "S002", "18.00", "10", "4")
    assert r.product_id is None
    na = raw.where(F.col("order_id") == "20260707-0009").first()
    assert na.loyalty_member == "NA" and na.discount_pct is None
    crlf = raw.where(F.col("source_file") == "orders_2026-07-28.csv").select("loyalty_member").distinct().collect()
    assert [x[0] for x in crlf] == ["Y"]
    flagged = raw.where(F.col("source_file") == "orders_2026-08-08.csv").first()
    assert flagged.product_id == "NP5004" and flagged.product_id_source == "new_system"


def test_gate_and_classifier(spark, landing, refs):
    raw = feed_csv.read_orders(spark, landing)
    headers = feed_csv.file_headers(spark, landing)
    s, legacy, new = refs
    sids, pids = quality.reference_sets(s, legacy, new)
    stats = quality.file_stats(raw, headers, sids, pids)
    dq = {r.file_name: r for r in quality.dq_report(stats).collect()}
    assert dq["orders_2026-07-16.csv"].dup_rows == 2 and dq["orders_2026-07-16.csv"].dup_order_id == 2
    assert dq["orders_2026-07-16.csv"].flags == "duplicates"
    assert dq["orders_2026-07-24.csv"].flags == "stale(expected=2026-07-24,found=2026-07-23)"
    assert dq["orders_2026-07-30.csv"].flags == "schema_new_product_col;orphans"
    assert dq["orders_2026-07-30.csv"].orphan_product == 2
    e = dq["orders_2026-08-03.csv"]
    assert (e.n_rows, e.product_col, e.flags, e.orphan_store) == (0, "", "empty;schema_new_product_col", None)
    assert dq["orders_2026-08-05.csv"].flags == "schema_new_product_col;nonnumeric(unit_price=3)"
    assert dq["orders_2026-08-05.csv"].na_unit_price == 0
    assert dq["orders_2026-08-08.csv"].flags == "header_mislabeled_product"
    assert dq["orders_2026-08-08.csv"].has_source_flag == 1
    assert dq["orders_2026-07-07.csv"].na_product == 0 and dq["orders_2026-07-07.csv"].na_discount_pct == 1
    st = {r.file_name: r for r in quality.file_status(stats).collect()}
    assert (st["orders_2026-08-03.csv"].status, st["orders_2026-08-03.csv"].found_date) == ("empty", "")
    assert st["orders_2026-07-24.csv"].status == "stale"
    assert st["orders_2026-07-07.csv"].status == "success"


def test_no_refs_flag(spark, landing):
    raw = feed_csv.read_orders(spark, landing)
    stats = quality.file_stats(raw, feed_csv.file_headers(spark, landing))
    r = quality.dq_report(stats).where(F.col("file_name") == "orders_2026-07-07.csv").first()
    assert r.flags == "ref_not_loaded" and r.orphan_store is None


def test_cleaning_over_files(spark, landing):
    raw = feed_csv.read_orders(spark, landing)
    tagged = cleaning.tag_rows(raw)
    # long load sequence -> the natural-key winner is a hash aggregate
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    reasons = {r["reason"]: r["count"] for r in cleaning.rejected_rows(tagged).groupBy("reason").count().collect()}
    # 2 repeated rows in 07-16 and the 4-row stale copy of 07-23 in the 07-24 file
    assert reasons == {"duplicate_natural_key": 6}
    clean = cleaning.clean_orders(tagged)
    winners = clean.where(F.col("order_date") == "2026-07-23").select("source_file").distinct().collect()
    assert [w[0] for w in winners] == ["orders_2026-07-23.csv"]      # first in load order wins
    d = clean.where(F.col("order_id") == "20260805-0001").first()
    assert d.unit_price == 72.70 and d.line_revenue == 145.4
    m = clean.where(F.col("source_file") == "orders_2026-08-08.csv").first()
    assert m.is_new_system == 1 and m.product_key == "NP5004" and m.legacy_product_id is None


def test_bom_header(spark, tmp):
    path = os.path.join(tmp, "orders_2026-09-01.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write(LEGACY + "\n" + _rows("2026-09-01", 1)[0] + "\n")
    r = feed_csv.read_orders(spark, path).first()
    assert r.order_id == "20260901-0001" and r.product_id == "P1001"


def test_failed_records(spark, tmp):
    from ledgerlark.operators import monitor
    good = os.path.join(tmp, "orders_2026-09-02.csv")
    with open(good, "w") as f:
        f.write(LEGACY + "\n" + _rows("2026-09-02", 1)[0] + "\n")
    with open(os.path.join(tmp, "orders_2026-09-03.csv"), "w") as f:   # blank download
        f.write("\n\n")
    bad = feed_csv.unreadable_files(spark, tmp)
    recs = monitor.failed_records(bad, F.lit("2026-09-03T06:00:00Z")).collect()
    assert [(r.source_date_expected, r.status, r.rows_loaded, r.error_message) for r in recs] == \
        [("2026-09-03", "failed", 0, "no header line")]


def test_file_hash(spark, landing):
    h = {r.source_file: r.file_hash for r in feed_csv.file_sha256(spark, landing).collect()}
    import hashlib
    with open(os.path.join(landing, "orders_2026-07-07.csv"), "rb") as f:
        assert h["orders_2026-07-07.csv"] == hashlib.sha256(f.read()).hexdigest()


def test_prices_with_signs_and_spaces(spark, tmp):
    """Every way a price comes dressed: none is a strict number, all parse."""
    prices = {"$ 72.70": 72.7, "72.70 $": 72.7, "\u00a031.05\u00a0": 31.05, "$4": 4.0, " $0.99": 0.99,
              "\"$1,024.50\"": 1024.5, "+$7.5": 7.5}
    path = os.path.join(tmp, "orders_2026-08-09.csv")
    with open(path, "w") as f:
        f.write("\n".join([NEWID] + [f"20260809-{k:04d},2026-08-09,S00{k % 8 + 1},NP{k},1,{p},0,pickup,Y"
                                     for k, p in enumerate(prices)]) + "\n")
    raw = feed_csv.read_orders(spark, path)
    dq = quality.dq_report(quality.file_stats(raw, feed_csv.file_headers(spark, path))).first()
    assert dq.n_rows == len(prices) and dq.na_unit_price == 0
    assert dq.flags == "schema_new_product_col;nonnumeric(unit_price=7);ref_not_loaded"
    from ledgerlark.functions.numeric import to_double
    got = [r[0] for r in raw.orderBy("order_id").select(to_double(F.col("unit_price"))).collect()]
    assert got == list(prices.values())


def test_wide_files_and_lines(spark, tmp):
    """The width comes from the data: 60 columns load by name."""
    names = NEWID.split(",")
    extra = [f"x{i}" for i in range(60 - len(names))]
    path = os.path.join(tmp, "orders_2026-08-10.csv")
    row = dict(zip(names, ["o1", "2026-08-10", "S001", "NP1", "2", "3.50", "0", "pickup", "Y"]))
    with open(path, "w") as f:
        f.write(",".join(extra + names) + "\n" + ",".join(["z"] * len(extra) + [row[n] for n in names]) + "\n")
    got = feed_csv.read_orders(spark, path).first().asDict()
    assert {n: got[n] for n in names} == row


def test_header_only_file_does_not_hide_the_day(spark, tmp):
    """The smaller name is empty: the day's other file loads; an undated file
    is logged, and a day that was empty is loaded when its file comes."""
    from ledgerlark.streaming import incremental
    land, raw = os.path.join(tmp, "land"), os.path.join(tmp, "raw")
    os.makedirs(land)
    line = "o1,{d},S001,NP1,2,3.50,0,pickup,Y\n"

    def put(name, d=None):
        with open(os.path.join(land, name), "w") as f:
            f.write(NEWID + "\n" + (line.format(d=d) if d else ""))

    put("orders_2026-07-01.csv")
    put("orders_20260701.csv", "2026-07-01")
    put("orders_2026-07-02.csv")
    put("orders_latest.csv", "2026-07-03")
    incremental.start(spark, land, raw, os.path.join(tmp, "ck"))
    load = lambda p: spark.read.parquet(os.path.join(tmp, p))
    assert [(str(r.file_date), r.source_file) for r in load("raw").collect()] == [("2026-07-01", "orders_20260701.csv")]
    assert {(r.file_name, r.status) for r in load("raw_log").collect()} == {
        ("orders_2026-07-01.csv", "empty"), ("orders_20260701.csv", "ok"), ("orders_2026-07-02.csv", "empty"),
        ("orders_latest.csv", "failed")}
    put("orders_2026-07-02_late.csv", "2026-07-02")
    incremental.start(spark, land, raw, os.path.join(tmp, "ck"))
    assert {str(r.file_date) for r in load("raw").collect()} == {"2026-07-01", "2026-07-02"}


def test_only_a_missing_table_is_a_first_run(spark, tmp):
    import pytest
    from ledgerlark.session import read_if_present
    assert read_if_present(spark, os.path.join(tmp, "none")) is None
    os.makedirs(os.path.join(tmp, "bad"))
    with open(os.path.join(tmp, "bad", "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        read_if_present(spark, os.path.join(tmp, "bad")).count()


def test_load_sequence_follows_file_order(spark, tmp):
    """raw_id increases with (file name, line position) even when a file is
    split into many blocks read by different tasks."""
    lines = [f"{i:06d},2026-09-04,S001,P1001,1,1.00,0,in_store,Y" for i in range(3000)]
    for name in ("orders_2026-09-04.csv", "orders_2026-09-05.csv"):
        with open(os.path.join(tmp, name), "w") as f:
            f.write("\n".join([LEGACY] + lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = feed_csv.read_orders(spark, tmp)
        assert raw.select(F.spark_partition_id()).distinct().count() > 4    # really split
        got = [(r.source_file, r.order_id) for r in raw.orderBy("raw_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [(n, f"{i:06d}") for n in ("orders_2026-09-04.csv", "orders_2026-09-05.csv") for i in range(3000)]
    assert got == want
    assert raw.select("raw_id").distinct().count() == 6000


def test_monitoring_chain_on_files(spark, tmp):
    """B1 -> B2 -> B5 -> B6 over real files: a gap day, an identical
    re-publish on the next day, and an empty file."""
    from ledgerlark.operators import monitor
    body = _rows("2026-09-10", 3)
    files = {
        "orders_2026-09-10.csv": body,
        "orders_2026-09-11.csv": body,                        # re-published unchanged
        "orders_2026-09-13.csv": _rows("2026-09-13", 2),      # 09-12 missing
        "orders_2026-09-14.csv": [],                          # header only
    }
    for name, rows in files.items():
        with open(os.path.join(tmp, name), "w") as f:
            f.write("\n".join([LEGACY] + rows) + "\n")
    raw = feed_csv.read_orders(spark, tmp)
    stats = quality.file_stats(raw, feed_csv.file_headers(spark, tmp))
    status = quality.file_status(stats)
    st = {r.file_name: (r.status, r.rows_loaded) for r in status.collect()}
    assert st == {"orders_2026-09-10.csv": ("success", 3), "orders_2026-09-11.csv": ("stale", 3),
                  "orders_2026-09-13.csv": ("success", 2), "orders_2026-09-14.csv": ("empty", 0)}
    log = monitor.ingestion_log_new(status, monitor.content_digest(raw, quality.DATA_COLUMNS))
    assert log.count() == 4
    assert [r.missing_date for r in monitor.missing_days(log).collect()] == ["2026-09-12"]
    rep = [(r.date, r.previous_date) for r in monitor.republished(log).collect()]
    assert rep == [("2026-09-11", "2026-09-10")]
