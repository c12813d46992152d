"""Registered queries against their DuckDB oracle on the smallest tables,
and the crosswalk on worked cases and by its properties."""
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
KEYS = ["clean_orders", "rejected_rows", "crosswalk", "daily_sales", "dq_report", "ingestion_log",
        "kpi_totals", "weather_corr", "rain_lift_median", "score_distribution", "dq_flag_diff",
        "incremental_pending", "week_over_week", "channel_mix", "channel_shift_z", "spearman_by_store"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if type(v).__name__ == "Decimal":
        return round(float(v), 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = Counter(tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


LEGACY = "product_id string, product_name string, category string, subcategory string, brand string, " \
         "base_price string, margin_rate string, launch_date string, catalog_pos long"
NEW = "new_product_id string, item_name string, department string, class string, msrp string, gross_margin string, " \
      "launch_date string, catalog_pos long"


def _crosswalk(spark, legacy, new):
    from ledgerlark.operators.crosswalk import build_crosswalk
    L = spark.createDataFrame([(i, n, "camping", sub, "b", price, m, d, k)
                               for k, (i, n, sub, price, m, d) in enumerate(legacy)], LEGACY)
    N = spark.createDataFrame([(i, n, dep, sub, price, m, d, k)
                               for k, (i, n, dep, sub, price, m, d) in enumerate(new)], NEW)
    return {r.product_id: r for r in build_crosswalk(L, N, {"camping": "outdoor"}).collect()}


def test_crosswalk_worked_cases(spark):
    """One small catalog, each row worked by hand."""
    legacy = [
        ("P1", "Alpine Tent 2", "tents", "100.00", "0.30", "2020-01-01"),       # same name after normalising
        ("P2", "Brook Stove", "stoves", "50.00", "0.31", "2020-01-02"),         # one candidate: name 100, price 1
        ("P3", "Cedar Lamp", "lamps", "10.00", "0.32", "2020-01-03"),           # two candidates alike
        ("P4", "Delta Rope", "ropes", "10.00", "0.33", "2020-01-04"),           # nothing in common: under the floor
        ("P5", "Ember Mat", "mats", "10.00", "0.34", "2020-01-05"),             # no candidate shares the block
        ("P6", "Fjord Cup", "cups", "0", "0.35", "2020-01-06"),                 # price 0: 0.6 + 0.2 + 0
    ]
    new = [
        ("N1", "alpine--TENT 2", "other", "x", "1", "0.99", "2021-01-01"),
        ("N1b", "Alpine Tent 2", "outdoor", "tents", "100.00", "0.30", "2020-01-01"),
        ("N2", "Brook Stove Max", "outdoor", "stoves", "50.00", "0.31", "2020-01-02"),
        ("N3", "Cedar Lamp A", "outdoor", "lamps", "10.00", "0.32", "2020-01-03"),
        ("N3b", "Cedar Lamp B", "outdoor", "lamps", "10.40", "0.32", "2020-01-03"),
        ("N4", "zzz", "outdoor", "qqq", "99.00", "0.33", "2020-01-04"),
        ("N5", "Ember Mat Pro", "outdoor", "mats", "10.00", "0.34", "2020-01-09"),
        ("N6", "Fjord Cup Mini", "outdoor", "cups", "5.00", "0.35", "2020-01-06"),
    ]
    got = {k: (r.new_product_id, r.match_status, r.match_confidence, r.match_method, r.needs_review)
           for k, r in _crosswalk(spark, legacy, new).items()}
    assert got == {
        "P1": ("N1", "matched", "high", "exact_name", 0),
        "P2": ("N2", "matched", "high", "attributes_fuzzy", 0),
        "P3": ("N3", "possible_match", "medium", "attributes_fuzzy", 1),
        "P4": (None, "unresolved", "low", "below_threshold", 1),
        "P5": (None, "unresolved", "low", "none", 1),
        "P6": ("N6", "matched", "high", "attributes_fuzzy", 0),
    }


def test_crosswalk_ties_and_edges(spark):
    """Equal best scores keep catalog order; a gap of just 0.05 is clear, and a
    best score of just the floor is accepted."""
    one = [("P1", "Kite", "kites", "100.00", "0.3", "2020-01-01")]
    tie = _crosswalk(spark, one, [("B", "Kite B", "outdoor", "kites", "100.00", "0.3", "2020-01-01"),
                                  ("A", "Kite A", "outdoor", "kites", "100.00", "0.3", "2020-01-01")])["P1"]
    assert (tie.new_product_id, tie.match_status) == ("B", "possible_match")
    # price closeness 1 and 0.5: scores 1.0 and 0.9, a clear gap
    clear = _crosswalk(spark, one, [("A", "Kite A", "outdoor", "kites", "150.00", "0.3", "2020-01-01"),
                                    ("B", "Kite B", "outdoor", "kites", "100.00", "0.3", "2020-01-01")])["P1"]
    assert (clear.new_product_id, clear.match_status) == ("B", "matched")
    # 0.6 * 1 + 0.2 * 0 + 0.2 * 0 is the floor itself
    floor = _crosswalk(spark, one, [("A", "Kite A", "outdoor", "###", "900.00", "0.3", "2020-01-01")])["P1"]
    assert (floor.new_product_id, floor.match_status) == ("A", "matched")


def test_crosswalk_properties(spark):
    """Over the whole catalogs: one row a legacy product, every best score is
    its block's maximum, and status follows from floor and gap."""
    from ledgerlark.operators import crosswalk as X
    from ledgerlark.plans import adapters
    legacy, new = adapters.products(spark, SF), adapters.new_products(spark, SF)
    scored = X.scored_candidates(legacy, new)
    rows = X.build_crosswalk(legacy, new, scored=scored).collect()
    assert len(rows) == legacy.count() == len({r.product_id for r in rows})
    block = {}
    for r in scored.collect():
        block.setdefault(r.product_id, []).append((r.score, r.new_product_id))
    for r in rows:
        if r.match_method in ("attributes_fuzzy", "below_threshold"):
            scores = sorted((s for s, _ in block[r.product_id]), reverse=True)
            assert (scores[0] < X.MIN_SCORE) == (r.match_status == "unresolved")
            if r.new_product_id:
                assert dict((i, s) for s, i in block[r.product_id])[r.new_product_id] == scores[0]
                close = len(scores) > 1 and scores[0] - scores[1] < X.AMBIGUOUS_GAP
                assert (r.match_status == "possible_match") == close
        elif r.match_method == "none":
            assert r.product_id not in block
    assert {r.match_status for r in rows} == {"matched", "possible_match", "unresolved"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["order_date", "store_id", "category", "category_source"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def test_oracle_types_match(spark, con):
    """Every oracled query returns the same column types in both engines
    (e.g. DuckDB's count_if / sum give HUGEINT unless cast)."""
    sqls = entry.oracle_sql()
    bad = {}
    for name, fn in entry.queries().items():
        if name not in sqls:
            continue
        st = {f.name: f.dataType.simpleString() for f in fn(spark, SF).schema.fields}
        rel = con.sql(sqls[name])
        dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
        diff = {c: (t, dt.get(c)) for c, t in st.items() if SPARK_TO_DUCK.get(t, t) != dt.get(c)}
        if diff:
            bad[name] = diff
    assert bad == {}
