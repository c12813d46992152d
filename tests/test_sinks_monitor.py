"""A7, A8, A11-A16 sinks; B3-B6 / A5 monitor helpers; E22 overrides; G6 slicing."""
import os

from pyspark.sql import functions as F

from ledgerlark.operators import crosswalk, kpi, monitor
from ledgerlark.sources import reference, sinks


def test_tables_and_audit(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ll_test LOCATION '{tmp}/wh'")
    made = sinks.create_tables(spark, "ll_test")
    assert len(made) == 11
    sinks.create_tables(spark, "ll_test")           # re-runnable
    df = spark.createDataFrame([("P1", "NP1", "matched", "high", "exact_name", "n", 0)],
                               "product_id string, new_product_id string, match_status string, "
                               "match_confidence string, match_method string, notes string, needs_review int")
    sinks.replace_table(df, "ll_test.product_crosswalk")
    sinks.append_table(df.drop("notes"), "ll_test.product_crosswalk",
                       sinks.schemas.PRODUCT_CROSSWALK)
    audit = {r.table: (r.present, r.n_rows) for r in
             sinks.table_audit(spark, ["ll_test.product_crosswalk", "ll_test.nope"]).collect()}
    assert audit == {"ll_test.product_crosswalk": (1, 2), "ll_test.nope": (0, None)}
    log_csv = os.path.join(tmp, "ingestion_log.csv")
    with open(log_csv, "w") as f:
        f.write("run_id,run_timestamp,source_url,source_date_expected,source_date_found,status,"
                "rows_loaded,file_hash,error_message\n"
                "a,t,u,2026-08-05,2026-08-05,success,155,h,\nb,t,u,2026-08-06,,failed,x,,boom\n")
    sinks.mirror_log(spark, log_csv, "ll_test.ingestion_log")
    rows = {r.run_id: r.rows_loaded for r in spark.table("ll_test.ingestion_log").collect()}
    assert rows == {"a": 155, "b": None}
    sinks.export_csv(df, os.path.join(tmp, "xw_csv"))
    back = spark.read.option("header", "true").csv(os.path.join(tmp, "xw_csv"))
    assert back.columns[0] == "product_id" and back.count() == 1


def test_reference_and_copy(spark, tmp):
    path = os.path.join(tmp, "stores.csv")
    with open(path, "w") as f:
        f.write("store_id,store_name,latitude\nS001,Main,35.96\nS002,,NA\n")
    df = reference.read_text_csv(spark, path)
    rows = df.orderBy("store_id").collect()
    assert rows[0].latitude == "35.96" and rows[1].store_name is None and rows[1].latitude == "NA"
    assert reference.read_text_csv(spark, os.path.join(tmp, "missing.csv")) is None
    done = reference.load_reference(spark, {"stores": path, "products": os.path.join(tmp, "x.csv")},
                                    os.path.join(tmp, "ref"))
    assert done == {"stores": 2, "products": None}

    def bad(_):
        raise RuntimeError("sink down")
    status = reference.copy_table(df, {"csv": lambda d: sinks.export_csv(d, os.path.join(tmp, "snap")),
                                       "broken": bad})
    assert status["csv"] == "ok" and status["broken"].startswith("failed")


def test_monitor_helpers(spark):
    log = spark.createDataFrame(
        [("2026-07-01", "h1"), ("2026-07-02", "h1"), ("2026-07-04", "h2"), ("2026-07-05", "h3")],
        "source_date_expected string, file_hash string")
    assert [r.missing_date for r in monitor.missing_days(log).collect()] == ["2026-07-03"]
    rep = monitor.republished(log).collect()
    assert [(r.date, r.previous_date) for r in rep] == [("2026-07-02", "2026-07-01")]
    files = spark.createDataFrame([("orders_2026-07-01.csv",), ("orders_20260701.csv",),
                                   ("orders_2026-07-03.csv",), ("notes.csv",)], "file_name string")
    loaded = spark.createDataFrame([("2026-07-03",)], "file_date string")
    got = {(r.file_name, r.action) for r in monitor.pending_files(files, loaded).collect()}
    assert got == {("orders_2026-07-01.csv", "load"), ("notes.csv", "undated")}
    dq_log = spark.createDataFrame([("orders_2026-07-01.csv",)], "file_name string")
    assert monitor.unchecked_files(files, dq_log).count() == 3
    f = spark.range(1).select(*monitor.failed_attempt(F.lit("2026-08-06"), F.lit("404"), F.lit("t"))).first()
    assert (f.status, f.rows_loaded, f.file_hash, f.error_message) == ("failed", 0, "", "404")
    status = spark.createDataFrame(
        [("orders_2026-07-01.csv", "2026-07-01", "success", 3, "2026-07-01"),
         ("orders_20260701.csv", "2026-07-01", "success", 5, "2026-07-01"),
         ("orders_2026-07-02.csv", "2026-07-02", "stale", 2, "2026-07-01")],
        "file_name string, expected_date string, status string, rows_loaded long, found_date string")
    logged = spark.createDataFrame([("2026-07-02",)], "source_date_expected string")
    new = monitor.ingestion_log_new(status, None, logged).collect()
    # first file name per date wins: "-" sorts before "0"
    assert [(r.source_date_expected, r.rows_loaded) for r in new] == [("2026-07-01", 3)]


def test_overrides_and_slices(spark):
    cw = spark.createDataFrame([("P1", None, "unresolved", "low", "none", "n", 1),
                                ("P2", "NP2", "matched", "high", "exact_name", "n", 0)],
                               "product_id string, new_product_id string, match_status string, "
                               "match_confidence string, match_method string, notes string, needs_review int")
    ov = spark.createDataFrame([("P1", "NP9")], "product_id string, new_product_id string")
    out = {r.product_id: (r.new_product_id, r.match_method, r.needs_review)
           for r in crosswalk.apply_overrides(cw, ov).collect()}
    assert out == {"P1": ("NP9", "manual", 0), "P2": ("NP2", "exact_name", 0)}
    daily = spark.createDataFrame(
        [("2026-07-01", "S001", "camping"), ("2026-07-02", "S002", "UNKNOWN"), ("2026-07-03", "S002", "patio")],
        "order_date string, store_id string, category string")
    d, _ = kpi.board_frames(daily, daily, stores=["S002"], date_from="2026-07-02")
    assert [r.category for r in d.collect()] == ["patio"]
    d_all, _ = kpi.board_frames(daily, daily)
    assert d_all.count() == 2


def test_dq_history_reverification(spark):
    """Flag *sets* are compared; a difference is known only when nothing
    was removed and the single added flag is the allowlisted one."""
    from ledgerlark.operators import quality
    cur = spark.createDataFrame([
        ("a.csv", "schema_new_product_col;nonnumeric(unit_price=155)"),
        ("b.csv", "duplicates"),
        ("c.csv", "duplicates;orphans"),
        ("d.csv", "orphans;duplicates"),
    ], "file_name string, flags string")
    log = spark.createDataFrame([
        ("a.csv", "schema_new_product_col"), ("b.csv", "duplicates;stale(expected=x,found=y)"),
        ("c.csv", "duplicates"), ("d.csv", "duplicates;orphans"),
    ], "file_name string, flags string")
    known = spark.createDataFrame([("a.csv", "nonnumeric(unit_price=155)"), ("c.csv", "empty")],
                                  "file_name string, flag string")
    got = {r.file_name: (r.added, r.removed, r.classification)
           for r in quality.dq_flag_diff(cur, log, known).collect()}
    assert got == {"a.csv": ("nonnumeric(unit_price=155)", "", "known"),
                   "b.csv": ("", "stale(expected=x,found=y)", "unexpected"),
                   "c.csv": ("orphans", "", "unexpected")}
