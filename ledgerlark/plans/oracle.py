"""DuckDB oracle SQL: an independent statement of every registered query.

The adapter views of ``plans/adapters.py`` are restated as SQL CTEs, then
each query is plain SQL over them (windows where convenient -- the oracle
only has to be right, not scale). The fuzzy similarity is written with
DuckDB list lambdas: the LCS length uses the same bit-parallel recurrence as
the Spark UDF but on HUGEINT masks (strings up to 126 characters, which the
test catalogs respect).
"""

from __future__ import annotations

import re

NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _num(x: str, strip_currency: bool = True) -> str:
    if strip_currency:
        s = f"trim(replace(replace({x}, '$', ''), ',', ''), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160))"
    else:
        s = f"trim({x}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
    return f"(CASE WHEN regexp_full_match({s}, '{NUM_RE}') AND NOT isinf(TRY_CAST({s} AS DOUBLE)) THEN TRY_CAST({s} AS DOUBLE) END)"


def _day(x: str) -> str:
    return f"TRY_CAST(CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN {x} END AS DATE)"


def _long(x: str) -> str:
    d = _num(x)
    return f"(CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS BIGINT) END)"


def _norm(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower(coalesce(CAST({x} AS VARCHAR), '')), "
            f"'[^a-z0-9]+', ' ', 'g'), '^ +| +$', '', 'g')")


def _tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def _lcs(a: str, b: str) -> str:
    full = f"((1::HUGEINT << length({b})) - 1)"
    masks = (f"list_transform(range(length({a})), lambda i: coalesce(list_sum(list_transform("
             f"range(length({b})), lambda j: CASE WHEN substr({b}, j + 1, 1) = substr({a}, i + 1, 1) "
             f"THEN (1::HUGEINT << j) ELSE 0::HUGEINT END)), 0::HUGEINT))")
    v = f"list_reduce({masks}, lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}, {full})"
    return f"(length({b}) - bit_count({v}))"


def _ratio(a: str, b: str) -> str:
    return (f"(CASE WHEN {a} = {b} THEN 100 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 "
            f"ELSE CAST(round_even(100.0::DOUBLE * ((2 * {_lcs(a, b)})::DOUBLE / (length({a}) + length({b}))), 0)"
            f" AS INTEGER) END)")


def _category_map(x: str, default: str = "NULL") -> str:
    # Legacy category -> new-system department rename.
    return (f"coalesce(CASE {x} WHEN 'camping' THEN 'camping' WHEN 'emergency' THEN 'preparedness' "
            f"WHEN 'footwear' THEN 'footwear' WHEN 'hydration' THEN 'drinkware' "
            f"WHEN 'outerwear' THEN 'apparel' WHEN 'patio' THEN 'patio' END, {default})")


LOAD_ORDER = ("copy_no, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
              "l_discount, l_returnflag, o_orderpriority")

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


cte("feed_base", [], """
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_returnflag, o.o_orderpriority, CAST(o.o_orderdate AS DATE) AS d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
cte("feed_rows", ["feed_base"], """
  SELECT b.*, copy_no,
    CAST(d + CASE WHEN copy_no = 1 OR (copy_no = 0 AND dayofyear(d) = 102) THEN 1 ELSE 0 END AS DATE) AS file_d
  FROM feed_base b, (SELECT unnest([0, 1, 2]) AS copy_no)
  WHERE copy_no = 0
     OR (copy_no = 1 AND (dayofyear(d) = 101 OR (l_orderkey % 211 = 0 AND dayofyear(d) NOT IN (100, 102))))
     OR (copy_no = 2 AND l_orderkey % 263 = 0 AND dayofyear(d) NOT IN (100, 101, 102))""")
cte("feed", ["feed_rows"], """
  SELECT
    'orders_' || CASE WHEN l_orderkey % 983 = 0 THEN CAST(year(file_d) AS VARCHAR) || '-13-45' ELSE CAST(file_d AS VARCHAR) END
      || '.csv' AS source_file,
    CAST(file_d AS VARCHAR) || 'T06:00:00Z' AS ingested_at,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
    CASE WHEN l_orderkey % 503 <> 0 THEN CASE WHEN l_orderkey % 601 = 0 THEN strftime(d, '%m/%d/%Y') ELSE CAST(d AS VARCHAR) END
      END AS order_date,
    CASE WHEN l_orderkey % 349 = 0 THEN 'S999' ELSE 'S00' || CAST(l_suppkey % 8 + 1 AS VARCHAR) END AS store_id,
    CASE WHEN year(file_d) < 1998 THEN 'P' || CAST(l_partkey AS VARCHAR)
         WHEN year(file_d) >= 2000 THEN 'NP' || CAST(l_partkey AS VARCHAR) END AS product_id,
    CASE WHEN year(file_d) >= 1998 AND year(file_d) < 2000 THEN 'NP' || CAST(CASE WHEN l_partkey % 97 = 0
         THEN l_partkey + 9000000 ELSE l_partkey END AS VARCHAR) END AS new_product_id,
    CASE WHEN year(file_d) >= 2000 THEN 'new_system' END AS product_id_source,
    CASE WHEN l_orderkey % 419 = 0 THEN 'abc' ELSE CASE WHEN l_orderkey % 401 = 0 THEN '-' ELSE '' END
      || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || CASE WHEN l_orderkey % 409 = 0 THEN '.5' ELSE '' END END AS quantity,
    CASE WHEN l_orderkey % 50 <> 0 THEN price
         ELSE CASE l_orderkey // 50 % 4 WHEN 0 THEN '$' || price WHEN 1 THEN '$ ' || price WHEN 2 THEN price || ' $'
                                        ELSE chr(160) || price || chr(160) END END AS unit_price,
    CASE WHEN l_orderkey % 307 = 0 THEN '150' ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS discount_pct,
    CASE l_returnflag WHEN 'A' THEN 'pickup' WHEN 'N' THEN 'in_store' WHEN 'R' THEN 'ship_from_store' END
      AS sales_channel,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Y'
         WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'N' END AS loyalty_member,
    copy_no, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
    l_returnflag, o_orderpriority, year(file_d) AS file_year
  FROM (SELECT *, CASE WHEN l_orderkey % 701 = 0 THEN '1e15' WHEN l_orderkey % 709 = 0 THEN '1e400' ELSE
          CAST(CASE WHEN dayofyear(d) = 45 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END
               AS DECIMAL(18,2))::VARCHAR END AS price FROM feed_rows)""")
cte("products", [], """
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id,
    concat_ws(' ', p_name, p_brand, CAST(p_partkey AS VARCHAR)) AS product_name,
    CASE WHEN p_partkey % 50 = 7 THEN 'clearance' ELSE CASE p_type WHEN 'ECONOMY' THEN 'camping'
      WHEN 'LARGE' THEN 'emergency' WHEN 'MEDIUM' THEN 'footwear' WHEN 'PROMO' THEN 'hydration'
      WHEN 'SMALL' THEN 'outerwear' WHEN 'STANDARD' THEN 'patio' END END AS category,
    p_name AS subcategory, p_brand AS brand,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS base_price,
    '0.' || CAST(CASE WHEN p_partkey % 100 = 9 THEN 29 ELSE 30 + p_partkey % 7 END AS VARCHAR) AS margin_rate,
    CAST(DATE '2019-01-01' + CAST(p_partkey // 40 AS INTEGER) AS VARCHAR) AS launch_date,
    'Y' AS active, p_partkey AS catalog_pos
  FROM part""")
cte("np_base", [], f"""
  SELECT 'NP' || CAST(p_partkey AS VARCHAR) AS new_product_id,
    CASE WHEN p_partkey % 8 = 1 THEN concat_ws(' ', p_name, 'series', lower(p_type))
         WHEN p_partkey % 8 = 5 THEN concat_ws(' ', p_name, CAST(p_partkey AS VARCHAR), 'pro')
         ELSE concat_ws(' ', p_name, p_brand, CAST(p_partkey AS VARCHAR)) END AS item_name,
    {_category_map("CASE WHEN p_partkey % 50 = 7 THEN 'clearance' ELSE CASE p_type WHEN 'ECONOMY' THEN 'camping' WHEN 'LARGE' THEN 'emergency' WHEN 'MEDIUM' THEN 'footwear' WHEN 'PROMO' THEN 'hydration' WHEN 'SMALL' THEN 'outerwear' WHEN 'STANDARD' THEN 'patio' END END", "'outlet'")} AS department,
    p_name AS class,
    replace(p_brand, 'Brand#', 'Mfr ') AS brand_name,
    CAST(CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(1.05 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2))
      AS VARCHAR) AS msrp,
    '0.' || CAST(CASE WHEN p_partkey % 20 = 9 THEN 28 ELSE 30 + p_partkey % 7 END AS VARCHAR) AS gross_margin,
    CAST(DATE '2019-01-01' + CAST(p_partkey // 40 AS INTEGER) AS VARCHAR) AS launch_date,
    'Y' AS active, p_partkey * 2 AS catalog_pos, p_partkey AS _k,
    CAST(p_retailprice AS DECIMAL(12,2)) AS _retail
  FROM part""")
cte("new_products", ["np_base"], """
  SELECT new_product_id, item_name, department, class, brand_name, msrp, gross_margin, launch_date,
         active, catalog_pos FROM np_base
  UNION ALL
  SELECT 'NP' || CAST(_k + 8000000 AS VARCHAR), item_name || ' alt', department, class, brand_name,
    CAST(CAST(round(_retail * CAST(1.07 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS VARCHAR),
    gross_margin, launch_date, active, catalog_pos + 1
  FROM np_base WHERE _k % 100 = 17""")
cte("stores", [], """
  SELECT DISTINCT 'S00' || CAST(s_suppkey % 8 + 1 AS VARCHAR) AS store_id FROM supplier""")
cte("wx_days", [], """
  SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS d, l.l_suppkey % 8 + 1 AS store_no
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
cte("weather_daily", ["wx_days"], """
  SELECT CAST(d AS VARCHAR) AS weather_date, 'S00' || CAST(store_no AS VARCHAR) AS store_id,
    CAST(100 + (dayofyear(d) * 11 + store_no * 5) % 250 AS DOUBLE) / 10 AS temperature_2m_max,
    CAST(100 + (dayofyear(d) * 11 + store_no * 5) % 250 - 80 AS DOUBLE) / 10 AS temperature_2m_min,
    CAST((dayofyear(d) * 7 + year(d) * 3 + store_no * 13) % 40 AS DOUBLE) * 0.25::DOUBLE AS precipitation_sum,
    CAST((dayofyear(d) + store_no) % 4 AS INTEGER) AS weather_code, 'adapter' AS weather_source
  FROM wx_days WHERE (dayofyear(d) + store_no) % 37 <> 0""")
cte("pulls", ["weather_daily"], """
  SELECT w.*, CAST(year(CAST(weather_date AS DATE)) AS VARCHAR) || '-01-01' AS range_start,
         CAST(year(CAST(weather_date AS DATE)) AS VARCHAR) || '-06-30' AS range_end
  FROM weather_daily w WHERE month(CAST(weather_date AS DATE)) <= 6
  UNION ALL
  SELECT weather_date, store_id, temperature_2m_max, temperature_2m_min,
    CASE WHEN (dayofyear(CAST(weather_date AS DATE)) + CAST(substr(store_id, 4, 1) AS INTEGER)) % 29 = 0
      THEN precipitation_sum + 0.75::DOUBLE ELSE precipitation_sum END,
    weather_code, weather_source,
    CAST(year(CAST(weather_date AS DATE)) AS VARCHAR) || '-01-01',
    CAST(year(CAST(weather_date AS DATE)) AS VARCHAR) || '-12-31'
  FROM weather_daily""")

# ---- crosswalk ---------------------------------------------------------------
cte("xl", ["products"], f"""
  SELECT product_id, brand, base_price, margin_rate AS m, launch_date AS d,
    {_category_map("lower(category)", "''")} AS dept, catalog_pos AS l_pos,
    {_norm("product_name")} AS l_name, {_norm("subcategory")} AS l_sub
  FROM products""")
cte("xn", ["new_products"], f"""
  SELECT new_product_id, msrp, gross_margin AS m, launch_date AS d, department AS dept,
    catalog_pos AS n_pos, {_norm("item_name")} AS n_name, {_norm("class")} AS n_class
  FROM new_products""")
cte("xfirst", ["xn"], """
  SELECT n_name, arg_min(new_product_id, n_pos) AS new_product_id FROM xn GROUP BY n_name""")
cte("xtier1", ["xl", "xfirst"], """
  SELECT xl.product_id, xl.l_pos, f.new_product_id FROM xl JOIN xfirst f ON xl.l_name = f.n_name""")
cte("xpairs", ["xl", "xn", "xfirst"], f"""
  SELECT xl.product_id, xl.l_pos, xn.new_product_id, xn.n_pos,
    xl.l_name AS a1, xn.n_name AS b1, xl.l_sub AS a2, xn.n_class AS b2,
    CASE WHEN {_num("xl.base_price", False)} > 0 AND {_num("xn.msrp", False)} IS NOT NULL
      THEN greatest(0.0::DOUBLE, 1.0::DOUBLE - abs({_num("xn.msrp", False)} - {_num("xl.base_price", False)})
                    / {_num("xl.base_price", False)})
      ELSE 0.0::DOUBLE END AS price_sim
  FROM xl JOIN xn ON xl.d = xn.d AND xl.m = xn.m AND xl.dept = xn.dept
  WHERE NOT EXISTS (SELECT 1 FROM xfirst f WHERE f.n_name = xl.l_name)""")


def _tokset_cols(a: str, b: str, p: str) -> str:
    ta, tb = _tokens(a), _tokens(b)
    inter = f"array_to_string(list_sort(list_intersect({ta}, {tb})), ' ')"
    d1 = f"array_to_string(list_sort(list_filter({ta}, lambda t: NOT list_contains({tb}, t))), ' ')"
    d2 = f"array_to_string(list_sort(list_filter({tb}, lambda t: NOT list_contains({ta}, t))), ' ')"
    return (f"len({ta}) > 0 AND len({tb}) > 0 AS {p}_ok, {inter} AS {p}_i, "
            f"trim({inter} || ' ' || {d1}) AS {p}_x, trim({inter} || ' ' || {d2}) AS {p}_y")


cte("xtok", ["xpairs"], f"""
  SELECT *, {_tokset_cols("a1", "b1", "t1")}, {_tokset_cols("a2", "b2", "t2")} FROM xpairs""")


def _tsr(p: str) -> str:
    return (f"CASE WHEN NOT {p}_ok THEN 0 ELSE greatest({_ratio(p + '_i', p + '_x')}, "
            f"{_ratio(p + '_i', p + '_y')}, {_ratio(p + '_x', p + '_y')}) END")


cte("xscored", ["xtok"], f"""
  SELECT product_id, l_pos, new_product_id, n_pos,
    CAST({_tsr("t1")} AS DOUBLE) / 100.0::DOUBLE AS name_sim,
    CAST({_tsr("t2")} AS DOUBLE) / 100.0::DOUBLE AS subclass_sim, price_sim
  FROM xtok""")
cte("xscore", ["xscored"], """
  SELECT *, 0.6::DOUBLE * name_sim + 0.2::DOUBLE * subclass_sim + 0.2::DOUBLE * price_sim AS score
  FROM xscored""")
cte("xranked", ["xscore"], """
  SELECT *, row_number() OVER (PARTITION BY l_pos ORDER BY score DESC, n_pos ASC) AS rn,
         count(*) OVER (PARTITION BY l_pos) AS n_cands FROM xscore""")
cte("xtop", ["xranked"], """
  SELECT b.product_id, b.l_pos, b.new_product_id AS best_id, b.score AS best, b.name_sim, b.n_cands,
         s.new_product_id AS second_id, s.score AS second
  FROM xranked b LEFT JOIN xranked s ON s.l_pos = b.l_pos AND s.rn = 2 WHERE b.rn = 1""")
cte("crosswalk", ["xl", "xtier1", "xtop"], """
  SELECT product_id, l_pos AS catalog_pos, new_product_id, match_status, match_confidence, match_method, notes,
    CASE WHEN match_status = 'matched' AND match_confidence = 'high' THEN 0 ELSE 1 END AS needs_review
  FROM (
    SELECT product_id, l_pos, new_product_id, 'matched' AS match_status, 'high' AS match_confidence,
           'exact_name' AS match_method, 'exact normalized name match' AS notes FROM xtier1
    UNION ALL
    SELECT product_id, l_pos,
      CASE WHEN best < 0.6 THEN NULL ELSE best_id END,
      CASE WHEN best < 0.6 THEN 'unresolved' WHEN n_cands > 1 AND best - second < 0.05 THEN 'possible_match'
           ELSE 'matched' END,
      CASE WHEN best < 0.6 THEN 'low' WHEN n_cands > 1 AND best - second < 0.05 THEN 'medium'
           WHEN name_sim >= 0.85 THEN 'high' ELSE 'medium' END,
      CASE WHEN best < 0.6 THEN 'below_threshold' ELSE 'attributes_fuzzy' END,
      CASE WHEN best < 0.6 THEN 'best candidate ' || best_id || ' scored ' || printf('%.2f', best)
                                || ', under the 0.6 floor'
           WHEN n_cands > 1 AND best - second < 0.05 THEN 'two close candidates (' || best_id || ' vs '
                                || second_id || '); picked higher name/price score'
           ELSE CASE WHEN n_cands = 1 THEN 'attribute block unique' ELSE 'best of block by name/price' END
                || '; name_sim=' || printf('%.2f', name_sim) END
    FROM xtop
    UNION ALL
    SELECT product_id, l_pos, NULL, 'unresolved', 'low', 'none',
           'no candidate sharing launch_date+margin+department'
    FROM xl WHERE l_pos NOT IN (SELECT l_pos FROM xtier1) AND l_pos NOT IN (SELECT l_pos FROM xtop)
  )""")
# the same matching over catalogs of which a third has a default date and margin
cte("hot_products", ["products"], """
  SELECT * REPLACE (CASE WHEN catalog_pos % 3 = 0 THEN '1900-01-01' ELSE launch_date END AS launch_date,
                    CASE WHEN catalog_pos % 3 = 0 THEN '0.30' ELSE margin_rate END AS margin_rate) FROM products""")
cte("hot_new_products", ["new_products"], """
  SELECT * REPLACE (CASE WHEN catalog_pos // 2 % 3 = 0 THEN '1900-01-01' ELSE launch_date END AS launch_date,
                    CASE WHEN catalog_pos // 2 % 3 = 0 THEN '0.30' ELSE gross_margin END AS gross_margin)
  FROM new_products""")
for _name in ("xl", "xn", "xfirst", "xpairs", "xtok", "xscored", "xscore", "xranked", "xtop"):
    _deps, _sql = CTES[_name]
    cte(f"hot_{_name}", [f"hot_{d}" for d in _deps],
        re.sub(r"\b(xl|xn|xfirst|xpairs|xtok|xscored|xscore|xranked|products|new_products)\b", r"hot_\1", _sql))
cte("xw_map", ["crosswalk"], """
  SELECT product_id, arg_max(new_product_id, catalog_pos) AS mapped
  FROM crosswalk WHERE new_product_id IS NOT NULL GROUP BY product_id""")

# ---- cleaning ------------------------------------------------------------------
cte("resolved", ["feed", "xw_map"], """
  SELECT f.*, coalesce(f.new_product_id, f.product_id) AS raw_val,
    (coalesce(f.product_id_source = 'new_system', false) OR f.new_product_id IS NOT NULL
     OR coalesce(starts_with(coalesce(f.new_product_id, f.product_id), 'NP'), false)) AS is_new,
    m.mapped
  FROM feed f LEFT JOIN xw_map m ON coalesce(f.new_product_id, f.product_id) = m.product_id""")
cte("typed", ["resolved"], f"""
  SELECT source_file, {LOAD_ORDER},
    order_id, order_date, store_id,
    CASE WHEN is_new THEN raw_val ELSE coalesce(mapped, raw_val) END AS product_key,
    CASE WHEN NOT is_new THEN product_id END AS legacy_product_id,
    CAST(is_new AS INTEGER) AS is_new_system,
    {_long("quantity")} AS quantity,
    {_num("unit_price")} AS unit_price,
    {_num("discount_pct")} AS discount_pct,
    CAST({_long("quantity")} AS DOUBLE) * {_num("unit_price")} AS line_revenue,
    sales_channel,
    CASE WHEN loyalty_member = 'Y' THEN 1 WHEN loyalty_member = 'N' THEN 0 END AS loyalty_member
  FROM resolved""")
cte("tagged", ["typed"], f"""
  SELECT *, CASE WHEN order_date IS NULL OR order_date = '' THEN 'missing_or_bad_order_date'
                 WHEN absurd THEN 'amount_out_of_range'
                 WHEN rn > 1 THEN 'duplicate_natural_key' END AS reject_reason
  FROM (SELECT *, CASE WHEN order_date IS NULL OR order_date = '' OR absurd THEN NULL ELSE
          row_number() OVER (PARTITION BY order_id, order_date, store_id, product_key,
                             (order_date IS NULL OR order_date = '' OR absurd)
                             ORDER BY source_file, {LOAD_ORDER}) END AS rn
        FROM (SELECT *, coalesce(abs(unit_price) >= 1e15, false) OR coalesce(abs(line_revenue) >= 1e15, false)
                OR coalesce(abs(discount_pct) >= 1e15, false)
                OR coalesce(discount_pct < 100 AND 1.0::DOUBLE - discount_pct / 100.0::DOUBLE < 1e-6, false) AS absurd FROM typed))""")
CLEAN_COLS = ("order_id, order_date, store_id, product_key, legacy_product_id, is_new_system, quantity, "
              "unit_price, discount_pct, line_revenue, sales_channel, loyalty_member, source_file")
cte("clean_orders", ["tagged"], f"SELECT {CLEAN_COLS} FROM tagged WHERE reject_reason IS NULL")

# ---- daily ---------------------------------------------------------------------
cte("catres", ["clean_orders", "new_products", "products"], f"""
  SELECT c.*,
    CASE WHEN nd.new_product_id IS NOT NULL THEN nd.department
         WHEN lc.product_id IS NOT NULL THEN {_category_map("lower(lc.category)", "'UNKNOWN'")}
         ELSE 'UNKNOWN' END AS category,
    CASE WHEN nd.new_product_id IS NOT NULL THEN 'new_system'
         WHEN lc.product_id IS NOT NULL THEN 'legacy_recovered' ELSE 'unknown' END AS category_source
  FROM clean_orders c
  LEFT JOIN (SELECT new_product_id, arg_max(department, catalog_pos) AS department FROM new_products
             GROUP BY new_product_id) nd ON c.product_key = nd.new_product_id
  LEFT JOIN (SELECT product_id, arg_max(category, catalog_pos) AS category FROM products
             GROUP BY product_id) lc ON c.legacy_product_id = lc.product_id""")
cte("money", ["catres"], """
  SELECT *, CAST(quantity AS DOUBLE) * unit_price AS net,
    CAST(quantity AS DOUBLE) * unit_price / (CASE WHEN 1.0::DOUBLE - coalesce(discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE > 0
         THEN 1.0::DOUBLE - coalesce(discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE ELSE 1.0::DOUBLE END) AS gross
  FROM catres""")
cte("daily_agg", ["money"], """
  SELECT order_date, store_id, category, category_source,
    CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units_sold,
    CAST(round(coalesce(sum(CAST(CAST(net AS VARCHAR) AS DECIMAL(38,10))), 0), 2) AS DOUBLE) AS net_revenue,
    CAST(round(coalesce(sum(CAST(CAST(gross AS VARCHAR) AS DECIMAL(38,10))), 0), 2) AS DOUBLE) AS gross_revenue,
    CAST(round(coalesce(sum(CAST(CAST(gross - net AS VARCHAR) AS DECIMAL(38,10))), 0), 2) AS DOUBLE) AS discount_given
  FROM money GROUP BY order_date, store_id, category, category_source""")
cte("daily_sales", ["daily_agg", "weather_daily"], """
  SELECT a.*, w.temperature_2m_max AS temp_max, w.temperature_2m_min AS temp_min, w.precipitation_sum,
         CAST(w.weather_code AS INTEGER) AS weather_code
  FROM daily_agg a LEFT JOIN weather_daily w ON a.order_date = w.weather_date AND a.store_id = w.store_id""")

# ---- board ---------------------------------------------------------------------
cte("lines", ["clean_orders", "new_products", "products", "daily_sales"], f"""
  SELECT c.order_date, c.store_id, c.product_key, c.legacy_product_id, c.quantity, c.unit_price,
    c.discount_pct, c.sales_channel,
    coalesce(np.item_name, p.product_name, c.product_key) AS product_name,
    coalesce(np.department, {_category_map("p.category")}, 'UNKNOWN') AS category,
    c.line_revenue AS net_revenue,
    CAST(c.quantity AS DOUBLE) * c.unit_price / (CASE WHEN 1.0::DOUBLE - coalesce(c.discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE > 0
         THEN 1.0::DOUBLE - coalesce(c.discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE ELSE 1.0::DOUBLE END) AS gross_revenue,
    pr.precipitation_sum
  FROM clean_orders c
  LEFT JOIN (SELECT new_product_id, arg_max(item_name, catalog_pos) AS item_name,
                    arg_max(department, catalog_pos) AS department FROM new_products GROUP BY new_product_id) np
    ON c.product_key = np.new_product_id
  LEFT JOIN (SELECT product_id, arg_max(product_name, catalog_pos) AS product_name,
                    arg_max(category, catalog_pos) AS category FROM products GROUP BY product_id) p
    ON c.legacy_product_id = p.product_id
  LEFT JOIN (SELECT order_date, store_id, max(precipitation_sum) AS precipitation_sum FROM daily_sales
             GROUP BY order_date, store_id) pr ON c.order_date = pr.order_date AND c.store_id = pr.store_id""")
cte("bdaily", ["daily_sales"], "SELECT * FROM daily_sales WHERE category <> 'UNKNOWN'")
cte("blines", ["lines"], "SELECT * FROM lines WHERE category <> 'UNKNOWN'")
cte("sd", ["daily_sales"], """
  SELECT order_date, store_id, CAST(round(sum(CAST(CAST(net_revenue AS VARCHAR) AS DECIMAL(38,10))), 2) AS DOUBLE) AS net_revenue,
         max(precipitation_sum) AS precipitation_sum, max(temp_max) AS temp_max
  FROM daily_sales GROUP BY order_date, store_id""")

# ---- quality -------------------------------------------------------------------
cte("fpos", ["feed"], f"""
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY {LOAD_ORDER}) AS pos,
    file_year >= 1998 AND file_year < 2000 AS has_new, file_year >= 2000 AS has_src,
    CASE WHEN file_year >= 1998 AND file_year < 2000 THEN new_product_id ELSE product_id END AS prod
  FROM feed""")
cte("found", ["fpos"], """
  SELECT source_file, string_agg(order_date, ';' ORDER BY p) AS found
  FROM (SELECT source_file, order_date, min(pos) AS p FROM fpos WHERE order_date IS NOT NULL
        GROUP BY source_file, order_date) GROUP BY source_file""")
cte("pids", ["products", "new_products"], """
  SELECT DISTINCT product_id AS id FROM products WHERE product_id IS NOT NULL
  UNION SELECT DISTINCT new_product_id FROM new_products WHERE new_product_id IS NOT NULL""")
cte("fstats", ["fpos", "stores", "pids"], f"""
  SELECT f.source_file, any_value(has_new) AS has_new, any_value(has_src) AS has_src,
    count(*) AS n_rows,
    CAST(count_if(coalesce(order_id IS NULL, false)) AS BIGINT) AS na_order_id, CAST(count_if(coalesce(order_date IS NULL, false)) AS BIGINT) AS na_order_date,
    CAST(count_if(coalesce(f.store_id IS NULL, false)) AS BIGINT) AS na_store_id, CAST(count_if(coalesce(prod IS NULL, false)) AS BIGINT) AS na_product,
    CAST(count_if(coalesce(quantity IS NULL, false)) AS BIGINT) AS na_quantity, CAST(count_if(coalesce(unit_price IS NULL, false)) AS BIGINT) AS na_unit_price,
    CAST(count_if(coalesce(discount_pct IS NULL, false)) AS BIGINT) AS na_discount_pct, CAST(count_if(coalesce(sales_channel IS NULL, false)) AS BIGINT) AS na_sales_channel,
    CAST(count_if(coalesce(loyalty_member IS NULL, false)) AS BIGINT) AS na_loyalty,
    CAST(count_if(coalesce({_num("quantity", False)} < 0, false)) AS BIGINT) AS neg_quantity,
    CAST(count_if(coalesce({_num("unit_price", False)} < 0, false)) AS BIGINT) AS neg_unit_price,
    CAST(count_if(coalesce({_num("discount_pct", False)} < 0 OR {_num("discount_pct", False)} > 100, false)) AS BIGINT) AS bad_discount,
    CAST(count_if(coalesce(unit_price IS NOT NULL AND {_num("unit_price", False)} IS NULL, false)) AS BIGINT) AS nn_unit_price,
    CAST(count_if(coalesce(quantity IS NOT NULL AND {_num("quantity", False)} IS NULL, false)) AS BIGINT) AS nn_quantity,
    CAST(count_if(coalesce(discount_pct IS NOT NULL AND {_num("discount_pct", False)} IS NULL, false)) AS BIGINT) AS nn_discount_pct,
    CAST(count_if(coalesce(s.store_id IS NULL, false)) AS BIGINT) AS orphan_store, CAST(count_if(coalesce(pid.id IS NULL, false)) AS BIGINT) AS orphan_product
  FROM fpos f LEFT JOIN stores s ON f.store_id = s.store_id LEFT JOIN pids pid ON f.prod = pid.id
  GROUP BY f.source_file""")
cte("fdup", ["feed"], """
  SELECT source_file, sum(c - 1) AS dup_rows FROM (
    SELECT source_file, count(*) AS c FROM feed GROUP BY source_file, order_id, order_date, store_id,
      product_id, new_product_id, product_id_source, quantity, unit_price, discount_pct, sales_channel,
      loyalty_member) GROUP BY source_file""")
cte("fdupid", ["feed"], """
  SELECT source_file, sum(c - 1) AS dup_order_id FROM (
    SELECT source_file, count(*) AS c FROM feed GROUP BY source_file, order_id) GROUP BY source_file""")
cte("fall", ["fstats", "fdup", "fdupid", "found"], """
  SELECT s.*, CAST(d.dup_rows AS BIGINT) AS dup_rows, CAST(i.dup_order_id AS BIGINT) AS dup_order_id,
    coalesce(fo.found, '') AS found, regexp_extract(s.source_file, '\\d{4}-\\d{2}-\\d{2}') AS expected
  FROM fstats s JOIN fdup d USING (source_file) JOIN fdupid i USING (source_file)
  LEFT JOIN found fo USING (source_file)""")
cte("dq", ["fall"], """
  SELECT expected AS run_date, source_file AS file_name, CAST(n_rows AS BIGINT) AS n_rows,
    CASE WHEN has_new THEN 'new_product_id' ELSE 'product_id' END AS product_col,
    CAST(has_src AS INTEGER) AS has_source_flag,
    CAST(na_order_id AS BIGINT) AS na_order_id, CAST(na_order_date AS BIGINT) AS na_order_date,
    CAST(na_store_id AS BIGINT) AS na_store_id, CAST(na_product AS BIGINT) AS na_product,
    CAST(na_quantity AS BIGINT) AS na_quantity, CAST(na_unit_price AS BIGINT) AS na_unit_price,
    CAST(na_discount_pct AS BIGINT) AS na_discount_pct, CAST(na_sales_channel AS BIGINT) AS na_sales_channel,
    CAST(na_loyalty AS BIGINT) AS na_loyalty, dup_rows, dup_order_id,
    CAST(neg_quantity AS BIGINT) AS neg_quantity, CAST(neg_unit_price AS BIGINT) AS neg_unit_price,
    CAST(bad_discount AS BIGINT) AS bad_discount,
    CAST(orphan_store AS BIGINT) AS orphan_store, CAST(orphan_product AS BIGINT) AS orphan_product,
    concat_ws(';',
      CASE WHEN has_new THEN 'schema_new_product_col' END,
      CASE WHEN has_src THEN 'header_mislabeled_product' END,
      CASE WHEN found <> '' AND found <> expected THEN 'stale(expected=' || expected || ',found=' || found || ')' END,
      CASE WHEN dup_rows > 0 OR dup_order_id > 0 THEN 'duplicates' END,
      CASE WHEN neg_quantity > 0 OR neg_unit_price > 0 OR bad_discount > 0 THEN 'out_of_range' END,
      CASE WHEN nn_unit_price + nn_quantity + nn_discount_pct > 0 THEN 'nonnumeric(' || concat_ws(',',
        CASE WHEN nn_unit_price > 0 THEN 'unit_price=' || CAST(nn_unit_price AS VARCHAR) END,
        CASE WHEN nn_quantity > 0 THEN 'quantity=' || CAST(nn_quantity AS VARCHAR) END,
        CASE WHEN nn_discount_pct > 0 THEN 'discount_pct=' || CAST(nn_discount_pct AS VARCHAR) END) || ')' END,
      CASE WHEN orphan_store > 0 OR orphan_product > 0 THEN 'orphans' END) AS flags,
    found, expected
  FROM fall""")
cte("fstatus", ["dq"], """
  SELECT file_name, expected AS expected_date,
    CASE WHEN n_rows = 0 THEN 'empty' WHEN expected IS NOT NULL AND found <> expected THEN 'stale'
         ELSE 'success' END AS status, n_rows AS rows_loaded, found AS found_date
  FROM dq""")
cte("fhash", ["feed"], """
  SELECT source_file, CAST(sum(CAST(('0x' || substr(m, 1, 16))::UBIGINT AS DECIMAL(38,0))) AS VARCHAR) || '-'
      || CAST(sum(CAST(('0x' || substr(m, 17, 16))::UBIGINT AS DECIMAL(38,0))) AS VARCHAR) AS file_hash
  FROM (SELECT source_file, md5(concat_ws(chr(1),
      coalesce(order_id, chr(0)), coalesce(order_date, chr(0)), coalesce(store_id, chr(0)),
      coalesce(product_id, chr(0)), coalesce(new_product_id, chr(0)), coalesce(product_id_source, chr(0)),
      coalesce(quantity, chr(0)), coalesce(unit_price, chr(0)), coalesce(discount_pct, chr(0)),
      coalesce(sales_channel, chr(0)), coalesce(loyalty_member, chr(0)))) AS m FROM feed)
  GROUP BY source_file""")
cte("ilog", ["fstatus", "fhash"], """
  SELECT substr(sha256(concat_ws('|', s.file_name, coalesce(h.file_hash, ''))), 1, 32) AS run_id,
    s.expected_date || 'T06:00:00Z' AS run_timestamp, 'feed://orders.csv' AS source_url,
    s.expected_date AS source_date_expected, s.found_date AS source_date_found, s.status,
    CAST(s.rows_loaded AS INTEGER) AS rows_loaded, h.file_hash, '' AS error_message
  FROM fstatus s LEFT JOIN fhash h ON s.file_name = h.source_file
  WHERE s.file_name IN (SELECT min(file_name) FROM fstatus GROUP BY expected_date)""")


def with_ctes(needed: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in order]
    b = body.lstrip()
    if b.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + b[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


Q: dict[str, tuple[list[str], str]] = {}


def q(name: str, needed: list[str], body: str) -> None:
    Q[name] = (needed, body)


def _dec(x: str) -> str:
    """Double -> DECIMAL(38,10) through the shortest decimal text, which is
    how Spark converts a double to a decimal."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))"


def _cents(x: str) -> str:
    return f"CAST(round(coalesce(sum({_dec(x)}), 0), 2) AS DOUBLE)"


# D
q("numeric_normalise", ["feed"], f"""
SELECT source_file, order_id, unit_price AS unit_price_text, {_long("quantity")} AS quantity,
  {_num("unit_price")} AS unit_price, {_num("discount_pct")} AS discount_pct FROM feed""")
q("product_resolution", ["typed", "resolved"], """
SELECT source_file, order_id, coalesce(new_product_id, product_id) AS raw_val, CAST(is_new AS INTEGER) AS is_new_system,
  CASE WHEN is_new THEN coalesce(new_product_id, product_id) ELSE coalesce(mapped, coalesce(new_product_id, product_id)) END
    AS product_key,
  CASE WHEN NOT is_new THEN product_id END AS legacy_product_id
FROM resolved""")
q("clean_orders", ["clean_orders"], "SELECT * FROM clean_orders")
q("rejected_rows", ["tagged"], """
SELECT source_file, reject_reason AS reason, order_id,
  CAST(to_json({'order_id': order_id, 'order_date': order_date, 'store_id': store_id, 'product_key': product_key,
           'legacy_product_id': legacy_product_id, 'is_new_system': CAST(is_new_system AS VARCHAR),
           'quantity': CAST(quantity AS VARCHAR),
           'unit_price': CASE WHEN unit_price IS NOT NULL THEN printf('%.4f', unit_price) END,
           'discount_pct': CASE WHEN discount_pct IS NOT NULL THEN printf('%.4f', discount_pct) END,
           'line_revenue': CASE WHEN line_revenue IS NOT NULL THEN printf('%.4f', line_revenue) END,
           'sales_channel': sales_channel, 'loyalty_member': CAST(loyalty_member AS VARCHAR),
           'source_file': source_file}) AS VARCHAR) AS raw_json
FROM tagged WHERE reject_reason IS NOT NULL""")
q("line_revenue_by_channel", ["clean_orders"], f"""
SELECT sales_channel, loyalty_member, count(*) AS n_lines, {_cents("line_revenue")} AS line_revenue
FROM clean_orders GROUP BY sales_channel, loyalty_member""")

# E
q("normalised_names", ["products"], f"""
SELECT product_id, {_norm("product_name")} AS norm_name, {_norm("subcategory")} AS norm_subcategory FROM products""")
q("edit_similarity", ["xpairs"], f"""
SELECT product_id, new_product_id, {_ratio("a1", "b1")} / 100.0::DOUBLE AS similarity FROM xpairs""")
q("best_window_similarity", ["xpairs", "xl"], f"""
WITH p AS (SELECT *, {_norm("subcategory")} AS s1 FROM xpairs JOIN (SELECT product_id, subcategory FROM products) USING (product_id)),
named AS (SELECT product_id, new_product_id, 'n' AS w, a1 AS x, b1 AS y FROM p
         UNION ALL SELECT product_id, new_product_id, 's', s1, b1 FROM p),
sides AS (SELECT product_id, new_product_id, w, x AS a, y AS b FROM named WHERE length(x) <= length(y)
          UNION ALL SELECT product_id, new_product_id, w, y, x FROM named WHERE length(y) <= length(x)),
cuts AS (SELECT product_id, new_product_id, w, a, CASE WHEN a = b THEN b ELSE
           substr(b, greatest(e - length(a), 0) + 1, least(e, length(b)) - greatest(e - length(a), 0)) END AS b
         FROM (SELECT *, unnest(range(1, greatest(length(a) + length(b), 2))) AS e FROM sides)),
best AS (SELECT product_id, new_product_id, w, max(r) / 100.0::DOUBLE AS s
         FROM (SELECT product_id, new_product_id, w, {_ratio("a", "b")} AS r FROM cuts) GROUP BY ALL)
SELECT product_id, new_product_id, max(s) FILTER (w = 'n') AS name_window, max(s) FILTER (w = 's') AS subclass_window
FROM best GROUP BY product_id, new_product_id""")
q("token_overlap", ["xpairs"], f"""
SELECT product_id, new_product_id, len(list_intersect({_tokens("a1")}, {_tokens("b1")})) AS overlap,
  round(CAST(len(list_intersect({_tokens("a1")}, {_tokens("b1")})) AS DOUBLE)
        / greatest(len({_tokens("a1")}), len({_tokens("b1")}), 1), 6) AS similarity
FROM xpairs""")
q("token_set_similarity", ["xscore"], """
SELECT product_id, new_product_id, name_sim, subclass_sim, round(price_sim, 6) AS price_sim,
  round(score, 6) AS score FROM xscore""")
q("crosswalk_exact", ["xtier1"], "SELECT product_id, new_product_id FROM xtier1")
CW_COLS = "product_id, new_product_id, match_status, match_confidence, match_method, notes, needs_review"
q("crosswalk", ["crosswalk"], f"SELECT {CW_COLS} FROM crosswalk")
q("crosswalk_review", ["crosswalk"], f"SELECT {CW_COLS} FROM crosswalk WHERE needs_review = 1")
q("crosswalk_overrides", ["crosswalk"], """
SELECT product_id, CASE WHEN o THEN 'N' || product_id ELSE new_product_id END AS new_product_id,
  CASE WHEN o THEN 'matched' ELSE match_status END AS match_status,
  CASE WHEN o THEN 'high' ELSE match_confidence END AS match_confidence,
  CASE WHEN o THEN 'manual' ELSE match_method END AS match_method, notes,
  CASE WHEN o THEN 0 ELSE needs_review END AS needs_review
FROM (SELECT *, needs_review = 1 AND CAST(substr(product_id, 2) AS BIGINT) % 3 = 0 AS o FROM crosswalk)""")
q("crosswalk_hot_blocks", ["hot_xtop"], """
SELECT product_id, n_cands, best_id, round(best, 6) AS best_score, second_id, round(second, 6) AS second_score
FROM hot_xtop""")
q("crosswalk_validation", ["crosswalk"], """
SELECT count(*) AS n_rows, count(new_product_id) AS n_mapped,
  count(DISTINCT new_product_id) AS n_distinct_new,
  count(new_product_id) - count(DISTINCT new_product_id) AS n_double_assigned,
  CAST(count_if(coalesce(match_confidence = 'high', false)) AS BIGINT) AS n_high, CAST(count_if(coalesce(match_confidence = 'medium', false)) AS BIGINT) AS n_medium,
  CAST(count_if(coalesce(match_confidence = 'low', false)) AS BIGINT) AS n_low, CAST(count_if(coalesce(needs_review = 1, false)) AS BIGINT) AS n_review,
  CAST(count_if(coalesce(needs_review = 1 AND match_status = 'matched', false)) AS BIGINT) AS n_review_matched_medium,
  CAST(count_if(coalesce(needs_review = 1 AND match_status = 'possible_match', false)) AS BIGINT) AS n_review_possible,
  CAST(count_if(coalesce(needs_review = 1 AND match_status = 'unresolved', false)) AS BIGINT) AS n_review_unresolved
FROM crosswalk""")
q("crosswalk_status", ["crosswalk"], """
SELECT match_status, match_method, count(*) AS n_rows FROM crosswalk GROUP BY match_status, match_method""")
q("score_distribution", ["xranked"], """
WITH lab AS (
  SELECT score, CASE WHEN rn > 1 OR best < 0.6 THEN 'rejected'
                     WHEN n_cands > 1 AND best - second < 0.05 THEN 'accepted_possible'
                     ELSE 'accepted_matched' END AS population
  FROM (SELECT r.*, max(score) OVER (PARTITION BY l_pos) AS best,
               max(CASE WHEN rn = 2 THEN score END) OVER (PARTITION BY l_pos) AS second FROM xranked r)),
b AS (SELECT min(CASE WHEN population <> 'rejected' THEN score END) AS a_min,
             max(CASE WHEN population <> 'rejected' THEN score END) AS a_max,
             min(CASE WHEN population = 'rejected' THEN score END) AS r_min,
             max(CASE WHEN population = 'rejected' THEN score END) AS r_max FROM lab)
SELECT population, count(*) AS n, round(min(score), 3) AS min_score, round(max(score), 3) AS max_score,
  round(any_value(CASE WHEN r_max > a_min THEN greatest(a_min, r_min) END), 3) AS overlap_lo,
  round(any_value(CASE WHEN r_max > a_min THEN least(a_max, r_max) END), 3) AS overlap_hi,
  CAST(count_if(coalesce(r_max > a_min AND score >= greatest(a_min, r_min) AND score <= least(a_max, r_max), false)) AS BIGINT) AS n_in_overlap
FROM lab, b GROUP BY population""")
q("crosswalk_fidelity", ["crosswalk", "xranked"], """
WITH best AS (SELECT product_id, score, name_sim, new_product_id AS best_id FROM xranked WHERE rn = 1),
pers AS (SELECT product_id, CAST(regexp_extract(notes, 'name_sim=([0-9.]+)', 1) AS DOUBLE) AS persisted
         FROM crosswalk WHERE match_method = 'attributes_fuzzy' AND match_status = 'matched'
           AND contains(notes, 'name_sim=')),
j AS (SELECT p.*, b.score, b.name_sim, b.best_id FROM pers p LEFT JOIN best b ON p.product_id = b.product_id)
SELECT count(*) AS n_persisted, CAST(count_if(coalesce(round(name_sim, 2) = persisted, false)) AS BIGINT) AS n_agree,
  arg_min(product_id, (score, product_id)) AS weakest_product_id,
  arg_min(best_id, (score, product_id)) AS weakest_new_product_id, round(min(score), 3) AS weakest_score
FROM j""")
q("brand_bijection", ["crosswalk", "products", "new_products"], """
SELECT count(*) AS n_pairs, CAST(count_if(coalesce(p.brand IS DISTINCT FROM n.brand_name, false)) AS BIGINT) AS n_brand_differs,
  count(DISTINCT p.brand) AS n_brands, count(DISTINCT n.brand_name) AS n_brand_names,
  count(DISTINCT (p.brand, n.brand_name)) AS n_brand_pairs
FROM crosswalk c JOIN products p ON c.product_id = p.product_id
JOIN new_products n ON c.new_product_id = n.new_product_id
WHERE c.new_product_id IS NOT NULL""")

cte("kept_brands", ["new_products"], """
  SELECT * REPLACE (CASE WHEN CAST(regexp_extract(new_product_id, '[0-9]+') AS BIGINT) % 2 = 0
    THEN replace(brand_name, 'Mfr ', 'Brand#') ELSE brand_name END AS brand_name) FROM new_products""")
q("brand_bijection_kept", ["crosswalk", "products", "kept_brands"],
  Q["brand_bijection"][1].replace("JOIN new_products", "JOIN kept_brands"))

# F
q("category_resolution", ["catres"], """
SELECT category, category_source, count(*) AS n_lines, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units
FROM catres GROUP BY category, category_source""")
q("daily_sales", ["daily_sales"], "SELECT * FROM daily_sales")
q("grain_check", ["daily_sales"], """
SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT order_date, store_id, category, category_source
  FROM daily_sales)) AS n_keys,
  CAST(count(*) = (SELECT count(*) FROM (SELECT DISTINCT order_date, store_id, category, category_source
  FROM daily_sales)) AS INTEGER) AS grain_unique FROM daily_sales""")
q("reconcile", ["daily_sales", "clean_orders"], """
SELECT CAST(d AS DOUBLE) AS daily_net, CAST(c AS DOUBLE) AS clean_net, CAST(abs(d - c) < 0.01 AS INTEGER) AS reconciles
FROM (SELECT round(sum(CAST(CAST(net_revenue AS VARCHAR) AS DECIMAL(38,10))), 2) AS d FROM daily_sales),
     (SELECT round(coalesce(sum(CAST(CAST(line_revenue AS VARCHAR) AS DECIMAL(38,10))), 0), 2) AS c FROM clean_orders)""")
q("raw_reconcile", ["feed", "daily_sales"], f"""
SELECT coalesce(r.order_date, d.order_date) AS order_date, coalesce(r.raw_lines, 0) AS raw_lines,
  r.raw_net, d.daily_net, round(coalesce(r.raw_net, 0.0) - coalesce(d.daily_net, 0.0), 2) AS difference
FROM (SELECT order_date, count(*) AS raw_lines,
        {_cents("CASE WHEN abs(amount) < 1e15 THEN amount END")} AS raw_net
      FROM (SELECT order_date, CAST({_long('quantity')} AS DOUBLE) * {_num('unit_price')} AS amount FROM feed)
      WHERE order_date IS NOT NULL AND order_date <> '' GROUP BY order_date) r
FULL OUTER JOIN (SELECT order_date, CAST(round(sum(CAST(CAST(net_revenue AS VARCHAR) AS DECIMAL(38,10))), 2) AS DOUBLE) AS daily_net
      FROM daily_sales GROUP BY order_date) d ON r.order_date = d.order_date""")
q("price_identity", ["clean_orders", "products", "new_products"], f"""
SELECT is_new_system, count(*) AS n_lines, CAST(count_if(coalesce(lp IS NULL, false)) AS BIGINT) AS n_no_list_price,
  CAST(count_if(coalesce(abs(unit_price - lp * (1.0::DOUBLE - coalesce(discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE)) < 0.011, false)) AS BIGINT) AS n_consistent,
  CAST(count_if(coalesce(lp IS NOT NULL AND NOT (abs(unit_price - lp * (1.0::DOUBLE - coalesce(discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE))
           < 0.011), false)) AS BIGINT) AS n_inconsistent
FROM (SELECT c.*, CASE WHEN is_new_system = 1 THEN {_num("np.msrp", False)} ELSE {_num("p.base_price", False)} END AS lp
      FROM clean_orders c
      LEFT JOIN (SELECT product_id, arg_max(base_price, catalog_pos) AS base_price FROM products GROUP BY product_id) p
        ON c.legacy_product_id = p.product_id
      LEFT JOIN (SELECT new_product_id, arg_max(msrp, catalog_pos) AS msrp FROM new_products GROUP BY new_product_id) np
        ON c.product_key = np.new_product_id)
GROUP BY is_new_system""")
cte("listed_orders", ["clean_orders", "products", "new_products"], f"""
  SELECT * EXCLUDE (lp) REPLACE (CASE WHEN CAST(split_part(order_id, '-', 1) AS BIGINT) % 2 = 0 AND lp IS NOT NULL
    THEN round(lp * (1.0::DOUBLE - coalesce(discount_pct, 0.0::DOUBLE) / 100.0::DOUBLE), 2) ELSE unit_price END AS unit_price)
  FROM (SELECT c.*, CASE WHEN c.is_new_system = 1 THEN {_num("np.msrp", False)} ELSE {_num("p.base_price", False)} END AS lp
        FROM clean_orders c LEFT JOIN products p ON c.legacy_product_id = p.product_id
        LEFT JOIN new_products np ON c.product_key = np.new_product_id)""")
q("price_identity_listed", ["listed_orders", "products", "new_products"], Q["price_identity"][1].replace("clean_orders", "listed_orders"))
q("weather_coverage", ["daily_sales"], """
SELECT count(*) AS n_rows, count(temp_max) AS n_with_weather, round(count(temp_max) / count(*), 6) AS coverage
FROM daily_sales""")
q("anomaly_days", ["daily_sales"], """
SELECT * FROM (SELECT order_date, CAST(sum(units_sold) AS BIGINT) AS units,
  CAST(round(sum(CAST(CAST(net_revenue AS VARCHAR) AS DECIMAL(38,10))), 2) AS DOUBLE) AS net FROM daily_sales GROUP BY order_date)
WHERE units > 0 AND net = 0""")
q("weather_latest", ["pulls"], """
SELECT weather_date, store_id, temperature_2m_max, temperature_2m_min, precipitation_sum, weather_code, range_end
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, weather_date ORDER BY range_end DESC, range_start DESC) AS rn
      FROM pulls) WHERE rn = 1""")
q("weather_unpack", ["pulls"], """
SELECT weather_date, store_id, temperature_2m_max, temperature_2m_min, precipitation_sum,
  CAST(weather_code AS INTEGER) AS weather_code, range_start, range_end FROM pulls""")
q("weather_revisions", ["pulls"], """
SELECT store_id, weather_date, n_pulls, precip_min, precip_max, precip_first, precip_last,
  CAST((precip_first > 1.0) <> (precip_last > 1.0) AS INTEGER) AS crosses_threshold
FROM (SELECT store_id, weather_date, count(*) AS n_pulls, min(precipitation_sum) AS precip_min,
        max(precipitation_sum) AS precip_max, arg_min(precipitation_sum, range_end || range_start) AS precip_first,
        arg_max(precipitation_sum, range_end || range_start) AS precip_last
      FROM pulls GROUP BY store_id, weather_date)
WHERE n_pulls > 1 AND precip_min <> precip_max""")

# A
q("feed_file_records", ["feed"], """
SELECT order_id, order_date, store_id, product_id, new_product_id, product_id_source, quantity, unit_price, discount_pct,
  sales_channel || CASE WHEN l_orderkey % 13 = 0 THEN chr(10) || '"gift", ' || order_id ELSE '' END AS sales_channel,
  loyalty_member FROM feed""")

q("ledger_load", ["feed", "fhash"], """
WITH files AS (SELECT substr(source_file, 8, 7) || '-01' AS m, count(*) AS n, count(DISTINCT order_date) AS n_dates, min(order_date) AS d
               FROM feed GROUP BY 1),
hashes AS (SELECT substr(source_file, 8, 7) || '-01' AS m,
             CAST(sum(CAST(split_part(file_hash, '-', 1) AS DECIMAL(38,0))) AS VARCHAR) || '-'
               || CAST(sum(CAST(split_part(file_hash, '-', 2) AS DECIMAL(38,0))) AS VARCHAR) AS file_hash
           FROM fhash GROUP BY 1)
SELECT CASE WHEN m < '2000' THEN 0 ELSE 1 END AS epoch, m AS source_date_expected,
  CASE WHEN n_dates = 1 AND d = m THEN 'success' ELSE 'stale' END AS status, CAST(n AS INTEGER) AS rows_loaded,
  file_hash, '' AS error_message
FROM files JOIN hashes USING (m)""")

# B / C
DQ_COLS = ("run_date, file_name, n_rows, product_col, has_source_flag, na_order_id, na_order_date, na_store_id, "
           "na_product, na_quantity, na_unit_price, na_discount_pct, na_sales_channel, na_loyalty, dup_rows, "
           "dup_order_id, neg_quantity, neg_unit_price, bad_discount, orphan_store, orphan_product, flags")
q("dq_report", ["dq"], f"SELECT {DQ_COLS} FROM dq")
q("file_status", ["fstatus"], "SELECT * FROM fstatus")
q("stale_files", ["dq"], "SELECT file_name, flags FROM dq WHERE contains(flags, 'stale(')")
q("ingestion_log", ["ilog"], "SELECT * FROM ilog")
q("missing_days", ["fstatus"], f"""
SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS missing_date, 'missing' AS status
FROM (SELECT unnest(generate_series(min({_day("expected_date")}), max({_day("expected_date")}), INTERVAL 1 DAY)) AS day FROM fstatus)
WHERE CAST(day AS DATE) NOT IN (SELECT {_day("expected_date")} FROM fstatus WHERE {_day("expected_date")} IS NOT NULL)""")
q("republished", ["ilog"], f"""
SELECT c.source_date_expected AS date, p.source_date_expected AS previous_date, c.file_hash
FROM ilog c JOIN ilog p ON {_day("c.source_date_expected")} - 1 = {_day("p.source_date_expected")}
  AND c.file_hash = p.file_hash""")
q("unchecked_files", ["feed"], """
SELECT DISTINCT source_file AS file_name FROM feed WHERE substr(source_file, 8, 10) > '1999-12-31'""")
q("incremental_pending", ["feed"], """
SELECT min(source_file) AS file_name, substr(source_file, 8, 10) AS file_date, 'load' AS action
FROM (SELECT DISTINCT source_file FROM feed) WHERE substr(source_file, 8, 10) > '1999-12-31'
GROUP BY substr(source_file, 8, 10)""")
q("dq_flag_diff", ["dq"], """
WITH cur AS (SELECT file_name, flags FROM dq),
nn AS (SELECT file_name, regexp_extract(flags, 'nonnumeric\\([^)]*\\)', 0) AS flag FROM cur),
known AS (SELECT arg_min(flag, file_name) AS flag, min(file_name) AS file_name FROM nn WHERE flag <> '')
SELECT c.file_name, regexp_extract(c.flags, 'nonnumeric\\([^)]*\\)', 0) AS added, '' AS removed,
  CASE WHEN c.file_name = k.file_name THEN 'known' ELSE 'unexpected' END AS classification
FROM cur c LEFT JOIN known k ON c.file_name = k.file_name
WHERE regexp_extract(c.flags, 'nonnumeric\\([^)]*\\)', 0) <> ''""")

q("dq_flag_history", ["dq"], """
SELECT file_name, '' AS added, 'retired_check' AS removed, 'unexpected' AS classification
FROM dq WHERE substr(file_name, 16, 2) = '07'""")

# A, B3: tables written and read back
q("clean_orders_table", ["clean_orders"], f"SELECT {CLEAN_COLS} FROM clean_orders")
q("table_audit", ["clean_orders", "daily_sales", "crosswalk"], """
SELECT table_name, 1 AS present, CAST(0 AS BIGINT) AS n_rows FROM (SELECT unnest(['raw_orders', 'ingestion_log',
  'data_quality_log', 'stores', 'products', 'new_products', 'weather_daily', 'rejected_rows']) AS table_name)
UNION ALL SELECT 'no_such_table', 0, NULL
UNION ALL SELECT 'clean_orders', 1, count(*) FROM clean_orders
UNION ALL SELECT 'daily_sales', 1, count(*) FROM daily_sales
UNION ALL SELECT 'product_crosswalk', 1, count(*) FROM crosswalk""")
# an empty field of the CSV is NULL in the table
q("ingestion_log_mirror", ["ilog"], """
SELECT run_id, run_timestamp, source_url, source_date_expected, nullif(source_date_found, '') AS source_date_found,
  status, rows_loaded, file_hash, nullif(error_message, '') AS error_message FROM ilog""")
q("reference_tables", ["new_products"], """
SELECT new_product_id, item_name, department, class, brand_name, msrp, gross_margin, launch_date, active,
  CAST(2 AS BIGINT) AS n_copies FROM new_products""")
q("failed_files", ["feed"], f"""
SELECT substr(sha256(file_date || '|no such day: ' || file_date), 1, 32) AS run_id,
  file_date || 'T06:00:00Z' AS run_timestamp, 'feed://orders.csv' AS source_url, file_date AS source_date_expected,
  '' AS source_date_found, 'failed' AS status, 0 AS rows_loaded, '' AS file_hash, 'no such day: ' || file_date AS error_message
FROM (SELECT DISTINCT substr(source_file, 8, 10) AS file_date FROM feed) WHERE {_day("file_date")} IS NULL""")

# G
q("enriched_lines", ["blines"], """
SELECT order_date, store_id, product_key, product_name, category, sales_channel, quantity,
  round(net_revenue, 4) AS net_revenue, round(gross_revenue, 4) AS gross_revenue, precipitation_sum FROM blines""")
KPI_TOTALS = """
SELECT CAST(round(net, 2) AS DOUBLE) AS net_revenue, CAST(round(gross, 2) AS DOUBLE) AS gross_revenue,
  CAST(round(disc, 2) AS DOUBLE) AS discount_given, units_sold, order_lines,
  CAST(round(CASE WHEN gross <> 0 THEN net / gross * 100 ELSE 0 END, 4) AS DOUBLE) AS kept_pct,
  CAST(round(CASE WHEN order_lines > 0 THEN net / order_lines ELSE 0 END, 4) AS DOUBLE) AS avg_order_value,
  CAST(round(CASE WHEN gross <> 0 THEN disc / gross * 100 ELSE 0 END, 4) AS DOUBLE) AS discount_share_pct
FROM (SELECT coalesce(sum(CAST(CAST(net_revenue AS VARCHAR) AS DECIMAL(38,10))), 0) AS net,
        coalesce(sum(CAST(CAST(gross_revenue AS VARCHAR) AS DECIMAL(38,10))), 0) AS gross,
        coalesce(sum(CAST(CAST(discount_given AS VARCHAR) AS DECIMAL(38,10))), 0) AS disc,
        CAST(coalesce(sum(units_sold), 0) AS BIGINT) AS units_sold FROM bdaily),
     (SELECT count(*) AS order_lines FROM blines)"""
q("kpi_totals", ["bdaily", "blines"], KPI_TOTALS)
SLICE = ("(SELECT * FROM {} WHERE store_id IN ('S001', 'S003') AND category IN ('footwear', 'patio') "
         "AND order_date BETWEEN '1996-01-01' AND '1996-12-31')")
q("kpi_totals_slice", ["bdaily", "blines"], KPI_TOTALS.replace("FROM bdaily", "FROM " + SLICE.format("bdaily"))
  .replace("FROM blines", "FROM " + SLICE.format("blines")))
q("daily_series", ["bdaily"], f"""
SELECT order_date, {_cents("net_revenue")} AS net_revenue, CAST(coalesce(sum(units_sold), 0) AS BIGINT) AS units_sold
FROM bdaily GROUP BY order_date""")
q("week_over_week", ["bdaily"], f"""
WITH s AS (SELECT {_day("order_date")} AS d, {_cents("net_revenue")} AS net,
             CAST(coalesce(sum(units_sold), 0) AS BIGINT) AS units FROM bdaily GROUP BY order_date),
l AS (SELECT max(d) AS last_day FROM s)
SELECT CAST(last_day AS VARCHAR) AS last_day, CAST(CAST(last_day - 7 AS DATE) AS VARCHAR) AS week_before,
  round(sum(CASE WHEN d = last_day THEN net END), 2) AS net_last_day,
  round(coalesce(sum(CASE WHEN d = last_day - 7 THEN net END), 0.0), 2) AS net_week_before,
  CAST(sum(CASE WHEN d = last_day THEN units END) AS BIGINT) AS units_last_day,
  CAST(coalesce(sum(CASE WHEN d = last_day - 7 THEN units END), 0) AS BIGINT) AS units_week_before
FROM s, l GROUP BY last_day""")
q("window_label", ["bdaily"], """
SELECT min(order_date) AS first_day, max(order_date) AS last_day, count(DISTINCT order_date) AS n_days FROM bdaily""")


def _corr_sql(w: str, v: str, r: str = "round(corr(val, w), 6)") -> str:
    val = (f"CAST(coalesce(sum({_dec(v)}), 0) AS DOUBLE)" if v != "units_sold"
           else f"CAST(coalesce(sum({v}), 0) AS DOUBLE)")
    return f"""
SELECT category, {r} AS r, count(*) AS n,
  CASE WHEN corr(val, w) >= 0.1 THEN 'warm-driven' WHEN corr(val, w) <= -0.1 THEN 'cool-driven'
       ELSE 'neutral' END AS sensitivity, '{w}' AS weather, '{v}' AS measure
FROM (SELECT category, order_date, store_id, {val} AS val, avg({w}) AS w FROM bdaily
      GROUP BY category, order_date, store_id)
GROUP BY category HAVING count(*) >= 3 AND count(DISTINCT w) > 1 AND count(DISTINCT val) > 1"""


q("weather_corr", ["bdaily"], "\nUNION ALL\n".join(
    _corr_sql(w, v) for w in ("temp_max", "precipitation_sum") for v in ("net_revenue", "units_sold")))
NOTE_SQL = """CASE WHEN abs(temp_r) < 0.1 AND abs(precip_r) < 0.1
    THEN 'no meaningful weather signal in this window — treat demand as a steady baseline; weather is not a useful lever here.'
    ELSE CASE WHEN temp_r >= 0.1 THEN 'leans <b>warm</b> — a modest tilt toward selling more on hot days; worth testing a pre-heat stock/promo, but expect small effects.'
              WHEN temp_r <= -0.1 THEN 'leans <b>cool</b> — a modest tilt toward selling more on cooler days; worth testing a cool-spell hold/promo, but expect small effects.'
              ELSE 'is flat to temperature (r=' || printf('%+.2f', temp_r) || ').' END
      || CASE WHEN precip_r >= 0.1 THEN ' Rain nudges it up slightly too.'
              WHEN precip_r <= -0.1 THEN ' It dips a little in the rain.' ELSE '' END END"""
RECOMMEND_SQL = f"""
WITH t AS ({_corr_sql("temp_max", "net_revenue", "corr(val, w)")}),
p AS ({_corr_sql("precipitation_sum", "net_revenue", "corr(val, w)")}),
j AS (SELECT c.category, coalesce(t.r, 0.0) AS temp_r, coalesce(p.r, 0.0) AS precip_r
      FROM (SELECT DISTINCT category FROM bdaily) c LEFT JOIN t ON c.category = t.category
      LEFT JOIN p ON c.category = p.category)
SELECT category, round(temp_r, 6) AS temp_r, round(precip_r, 6) AS precip_r,
  CASE WHEN temp_r >= 0.1 THEN 'leans warm' WHEN temp_r <= -0.1 THEN 'leans cool'
       WHEN precip_r >= 0.1 THEN 'leans wet' WHEN precip_r <= -0.1 THEN 'leans dry' ELSE 'weather-neutral' END AS tag,
  {NOTE_SQL} AS note,
  CAST(row_number() OVER (ORDER BY abs(temp_r) DESC, category) AS INTEGER) AS priority
FROM j"""
q("recommendations", ["bdaily"], RECOMMEND_SQL)
cte("tagdaily", ["bdaily"], """
  SELECT * REPLACE (
    CASE category WHEN 'footwear' THEN net_revenue WHEN 'apparel' THEN -CAST(units_sold AS DOUBLE) ELSE temp_max END AS temp_max,
    CASE category WHEN 'camping' THEN net_revenue WHEN 'apparel' THEN net_revenue WHEN 'drinkware' THEN -net_revenue
         ELSE precipitation_sum END AS precipitation_sum) FROM bdaily""")
q("recommendation_tags", ["tagdaily"], RECOMMEND_SQL.replace("bdaily", "tagdaily"))
q("revenue_by_store", ["bdaily"], f"SELECT store_id, {_cents('net_revenue')} AS net_revenue FROM bdaily GROUP BY store_id")
q("revenue_by_category", ["bdaily"], f"""
SELECT category, net_revenue, round(CASE WHEN mx <> 0 THEN net_revenue / mx * 100 ELSE 0.0 END, 4) AS pct_of_max
FROM (SELECT category, {_cents('net_revenue')} AS net_revenue FROM bdaily GROUP BY category),
     (SELECT max(net_revenue) AS mx FROM (SELECT {_cents('net_revenue')} AS net_revenue FROM bdaily GROUP BY category))""")
q("top_products", ["blines"], f"""
SELECT product_name, {_cents('net_revenue')} AS net_revenue FROM blines GROUP BY product_name
ORDER BY net_revenue DESC, product_name ASC LIMIT 6""")
q("rain_day_counts", ["blines"], """
SELECT CAST(count_if(coalesce(rain, false)) AS BIGINT) AS rain_store_days, CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) AS dry_store_days
FROM (SELECT order_date, store_id, max(precipitation_sum >= 1.0) AS rain FROM blines
      WHERE precipitation_sum IS NOT NULL GROUP BY order_date, store_id)""")
q("channel_mix", ["blines"], """
WITH pc AS (SELECT sales_channel, precipitation_sum >= 1.0 AS rain FROM blines
            WHERE precipitation_sum IS NOT NULL AND sales_channel IS NOT NULL),
t AS (SELECT CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) AS nd, CAST(count_if(coalesce(rain, false)) AS BIGINT) AS nr FROM pc)
SELECT sales_channel, CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) AS dry_lines, CAST(count_if(coalesce(rain, false)) AS BIGINT) AS rain_lines,
  round(CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) * 100.0 / any_value(nd), 4) AS dry_pct,
  round(CAST(count_if(coalesce(rain, false)) AS BIGINT) * 100.0 / any_value(nr), 4) AS rain_pct,
  round(CAST(count_if(coalesce(rain, false)) AS BIGINT) * 100.0 / any_value(nr) - CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) * 100.0 / any_value(nd), 4) AS delta_pts
FROM pc, t GROUP BY sales_channel""")
q("rain_lift_mean", ["blines"], """
WITH sd AS (SELECT mm, order_date, store_id, CAST(sum(CAST(CAST(net_revenue AS VARCHAR) AS DECIMAL(38,10))) AS DOUBLE) AS rev,
                   max(precipitation_sum >= mm) AS r
            FROM blines, (SELECT unnest([0.4, 1.0, 5.0, 10.0]::DOUBLE[]) AS mm)
            WHERE precipitation_sum IS NOT NULL GROUP BY mm, order_date, store_id),
ps AS (SELECT mm, CAST(count_if(coalesce(coalesce(rm > dm, false), false)) AS BIGINT) AS stores_agree, count(*) AS n_stores
       FROM (SELECT mm, store_id, avg(CASE WHEN r THEN rev END) AS rm, avg(CASE WHEN NOT r THEN rev END) AS dm
             FROM sd GROUP BY mm, store_id) GROUP BY mm),
ov AS (SELECT mm, avg(CASE WHEN r THEN rev END) AS rain, avg(CASE WHEN NOT r THEN rev END) AS dry,
              count(DISTINCT r) AS nr FROM sd GROUP BY mm)
SELECT ov.mm AS threshold_mm, CASE WHEN nr = 2 THEN round((rain / dry - 1) * 100, 4) END AS mean_lift_pct,
  CASE WHEN nr = 2 THEN stores_agree END AS stores_agree, n_stores
FROM ov JOIN ps ON ov.mm = ps.mm""")

# H
q("store_days", ["sd"], "SELECT * FROM sd")
q("channel_shift", ["clean_orders", "sd"], """
WITH j AS (SELECT c.sales_channel, s.precipitation_sum > 1.0 AS rain FROM clean_orders c
           JOIN sd s ON c.order_date = s.order_date AND c.store_id = s.store_id WHERE s.precipitation_sum IS NOT NULL),
t AS (SELECT CAST(count_if(coalesce(rain, false)) AS BIGINT) AS nr, CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) AS nd FROM j)
SELECT sales_channel, CAST(count_if(coalesce(rain, false)) AS BIGINT) AS rain_lines, CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) AS dry_lines,
  round(CAST(count_if(coalesce(rain, false)) AS BIGINT) * 100.0 / any_value(nr), 4) AS rain_pct, round(CAST(count_if(coalesce(NOT rain, false)) AS BIGINT) * 100.0 / any_value(nd), 4) AS dry_pct
FROM j, t GROUP BY sales_channel""")
q("rain_lift_median", ["sd"], """
WITH x AS (SELECT s.*, mm, precipitation_sum > mm AS r FROM sd s, (SELECT unnest([0.4, 1.0, 5.0, 10.0]::DOUBLE[]) AS mm)
           WHERE precipitation_sum IS NOT NULL),
o AS (SELECT mm, median(CASE WHEN r THEN net_revenue END) AS mr, median(CASE WHEN NOT r THEN net_revenue END) AS md
      FROM x GROUP BY mm),
ps AS (SELECT mm, CAST(count_if(coalesce(coalesce(sr > sdry, false), false)) AS BIGINT) AS stores_with_lift, count(*) AS n_stores
       FROM (SELECT mm, store_id, median(CASE WHEN r THEN net_revenue END) AS sr,
                    median(CASE WHEN NOT r THEN net_revenue END) AS sdry FROM x GROUP BY mm, store_id) GROUP BY mm)
SELECT o.mm AS threshold_mm, round((mr / md - 1) * 100, 4) AS median_lift_pct, stores_with_lift, n_stores
FROM o JOIN ps ON o.mm = ps.mm""")
q("store_mix", ["sd"], """
SELECT store_id, CAST(count_if(coalesce(precipitation_sum > 1.0, false)) AS BIGINT) AS rain_days, count(*) AS days,
  round(CAST(count_if(coalesce(precipitation_sum > 1.0, false)) AS BIGINT) / count(*), 6) AS rain_share, median(net_revenue) AS median_daily_net
FROM sd GROUP BY store_id""")
q("channel_shift_zscore", ["clean_orders", "sd"], """
WITH j AS (SELECT c.sales_channel, s.precipitation_sum > 1.0 AS rain FROM clean_orders c
           JOIN sd s ON c.order_date = s.order_date AND c.store_id = s.store_id WHERE s.precipitation_sum IS NOT NULL),
g AS (SELECT CAST(count_if(rain) AS BIGINT) AS n_rain, CAST(count_if(NOT rain) AS BIGINT) AS n_dry,
             CAST(count_if(rain AND coalesce(sales_channel = 'pickup', false)) AS BIGINT) AS k_rain,
             CAST(count_if(NOT rain AND coalesce(sales_channel = 'pickup', false)) AS BIGINT) AS k_dry FROM j),
r AS (SELECT *, k_rain::DOUBLE / n_rain AS p1, k_dry::DOUBLE / n_dry AS p2,
             (k_rain + k_dry)::DOUBLE / (n_rain + n_dry) AS pool FROM g)
SELECT n_rain, n_dry, k_rain, k_dry, round(p1 * 100, 4) AS share_rain_pct, round(p2 * 100, 4) AS share_dry_pct,
  round((p1 - p2) / sqrt(pool * (1 - pool) * (1.0::DOUBLE / n_rain + 1.0::DOUBLE / n_dry)), 6) AS z
FROM r""")


def _spearman_sql(src: str, x: str, y: str, part: str) -> str:
    pby = f"PARTITION BY {part}" if part else ""
    pby_x = f"PARTITION BY {part + ', ' if part else ''}{x}"
    pby_y = f"PARTITION BY {part + ', ' if part else ''}{y}"
    grp = f"GROUP BY {part}" if part else ""
    sel = f"{part}, " if part else ""
    return f"""
SELECT {sel}count(*) AS n,
  round(CASE WHEN count(DISTINCT {x}) > 1 AND count(DISTINCT {y}) > 1 THEN corr(rx, ry) END, 6) AS rho
FROM (SELECT *, rank() OVER ({pby} ORDER BY {x}) + (count(*) OVER ({pby_x}) - 1) / 2.0 AS rx,
             rank() OVER ({pby} ORDER BY {y}) + (count(*) OVER ({pby_y}) - 1) / 2.0 AS ry
      FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)
{grp}"""


q("spearman_rho_by_store", ["sd"],
  "SELECT *, 'temp_max' AS weather FROM (" + _spearman_sql("sd", "net_revenue", "temp_max", "store_id") + ")"
  + "\nUNION ALL\nSELECT *, 'precipitation_sum' AS weather FROM ("
  + _spearman_sql("sd", "net_revenue", "precipitation_sum", "store_id") + ")")
q("share_vs_median_rho", ["sd"], _spearman_sql(
  "(SELECT store_id, CAST(count_if(coalesce(precipitation_sum > 1.0, false)) AS BIGINT) / count(*) AS rain_share, "
  "median(net_revenue) AS median_daily_net FROM sd GROUP BY store_id)", "rain_share", "median_daily_net", ""))
q("effective_sample", ["daily_sales"], """
SELECT count(*) AS n_rows, count(DISTINCT (order_date, store_id)) AS n_store_days FROM daily_sales""")


# ---- p-values: tails by Simpson integration of the density (DuckDB has no
# erf / Student-t CDF); 20000 steps keep the error near 1e-14, far below the
# 6-decimal rounding of the reported p-values.
SIMPSON_N = 20000


def _simpson_w(i: str) -> str:
    return f"(CASE WHEN {i} = 0 OR {i} = {SIMPSON_N} THEN 1 WHEN {i} % 2 = 1 THEN 4 ELSE 2 END)"


def _normal_p_ctes(src: str, keys: str) -> str:
    """CTE text: from ``src`` (keys, z) to ``np_out`` (keys, p) two-sided."""
    return f"""
np_grid AS (SELECT {keys}, abs(z) AS a, i FROM {src}, range(0, {SIMPSON_N} + 1) t(i) WHERE z IS NOT NULL),
np_out AS (SELECT {keys}, 1 - 2 * sum({_simpson_w("i")} * exp(-0.5 * pow(i * a / {SIMPSON_N}, 2)))
             * (any_value(a) / {SIMPSON_N}) / 3 / sqrt(2 * pi()) AS p FROM np_grid GROUP BY {keys})"""


def _t_p_ctes(src: str, keys: str) -> str:
    """CTE text: from ``src`` (keys, n, rho_raw) to ``tp_out`` (keys, p): the
    two-sided Student-t p of t = rho*sqrt((n-2)/(1-rho^2)) with n-2 dof."""
    return f"""
tp_in AS (SELECT {keys}, CAST(n - 2 AS DOUBLE) AS nu,
            abs(rho_raw) * sqrt((n - 2) / (1 - rho_raw * rho_raw)) AS a
          FROM {src} WHERE rho_raw IS NOT NULL AND n >= 3 AND abs(rho_raw) < 1),
tp_grid AS (SELECT tp_in.*, i FROM tp_in, range(0, {SIMPSON_N} + 1) t(i)),
tp_out AS (SELECT {keys}, 1 - 2 * sum({_simpson_w("i")} * pow(1 + pow(i * a / {SIMPSON_N}, 2) / nu, -(nu + 1) / 2.0))
             * (any_value(a) / {SIMPSON_N}) / 3
             * exp(lgamma((any_value(nu) + 1) / 2.0) - lgamma(any_value(nu) / 2.0)) / sqrt(any_value(nu) * pi()) AS p
           FROM tp_grid GROUP BY {keys})"""


def _rho_raw_sql(src: str, x: str, y: str, part: str) -> str:
    pby = f"PARTITION BY {part}" if part else ""
    pby_x = f"PARTITION BY {part + ', ' if part else ''}{x}"
    pby_y = f"PARTITION BY {part + ', ' if part else ''}{y}"
    grp = f"GROUP BY {part}" if part else ""
    sel = f"{part}, " if part else ""
    return f"""
SELECT {sel}count(*) AS n,
  CASE WHEN count(DISTINCT {x}) > 1 AND count(DISTINCT {y}) > 1 THEN corr(rx, ry) END AS rho_raw
FROM (SELECT *, rank() OVER ({pby} ORDER BY {x}) + (count(*) OVER ({pby_x}) - 1) / 2.0 AS rx,
             rank() OVER ({pby} ORDER BY {y}) + (count(*) OVER ({pby_y}) - 1) / 2.0 AS ry
      FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL)
{grp}"""


def _p_final(rho: str = "rho_raw") -> str:
    return (f"CASE WHEN {rho} IS NULL OR n < 3 THEN NULL WHEN abs({rho}) >= 1 THEN 0.0 "
            f"ELSE round(tp_out.p, 6) END")


SD_STACK = """(SELECT store_id, 'temp_max' AS weather, net_revenue, temp_max AS w FROM sd
               UNION ALL SELECT store_id, 'precipitation_sum', net_revenue, precipitation_sum FROM sd)"""
STORE_MIX_SRC = ("(SELECT store_id, CAST(count_if(coalesce(precipitation_sum > 1.0, false)) AS BIGINT) "
                 "/ count(*) AS rain_share, median(net_revenue) AS median_daily_net FROM sd GROUP BY store_id)")

q("channel_shift_z", ["clean_orders", "sd"], f"""
WITH j AS (SELECT c.sales_channel, s.precipitation_sum > 1.0 AS rain FROM clean_orders c
           JOIN sd s ON c.order_date = s.order_date AND c.store_id = s.store_id WHERE s.precipitation_sum IS NOT NULL),
g AS (SELECT CAST(count_if(rain) AS BIGINT) AS n_rain, CAST(count_if(NOT rain) AS BIGINT) AS n_dry,
             CAST(count_if(rain AND coalesce(sales_channel = 'pickup', false)) AS BIGINT) AS k_rain,
             CAST(count_if(NOT rain AND coalesce(sales_channel = 'pickup', false)) AS BIGINT) AS k_dry FROM j),
r AS (SELECT *, k_rain::DOUBLE / n_rain AS p1, k_dry::DOUBLE / n_dry AS p2,
             (k_rain + k_dry)::DOUBLE / (n_rain + n_dry) AS pool, 1 AS one FROM g),
zz AS (SELECT *, (p1 - p2) / sqrt(pool * (1 - pool) * (1.0::DOUBLE / n_rain + 1.0::DOUBLE / n_dry)) AS z
       FROM r),{_normal_p_ctes("zz", "one")}
SELECT n_rain, n_dry, k_rain, k_dry, round(p1 * 100, 4) AS share_rain_pct, round(p2 * 100, 4) AS share_dry_pct, round(z, 6) AS z,
  round(np_out.p, 6) AS p_value
FROM zz LEFT JOIN np_out ON zz.one = np_out.one""")
q("spearman_by_store", ["sd"], f"""
WITH rr AS ({_rho_raw_sql(SD_STACK, "net_revenue", "w", "store_id, weather")}),{_t_p_ctes("rr", "store_id, weather")}
SELECT rr.store_id, rr.weather, n, round(rho_raw, 6) AS rho, {_p_final()} AS p_value
FROM rr LEFT JOIN tp_out ON rr.store_id = tp_out.store_id AND rr.weather = tp_out.weather""")
q("significance_screen", ["sd"], f"""
WITH rr AS ({_rho_raw_sql(SD_STACK, "net_revenue", "w", "store_id, weather")}),{_t_p_ctes("rr", "store_id, weather")},
tests AS (SELECT rr.store_id, rr.weather, n, round(rho_raw, 6) AS rho, {_p_final()} AS p_value,
                 count(*) OVER () AS n_tests
          FROM rr LEFT JOIN tp_out ON rr.store_id = tp_out.store_id AND rr.weather = tp_out.weather)
SELECT * FROM tests WHERE p_value < 0.05""")
cte("sd_signal", ["sd"], """
  SELECT * REPLACE (CASE WHEN store_id IN ('S001', 'S002', 'S003', 'S004') AND substr(order_date, 9, 2) <= '15'
    THEN net_revenue ELSE temp_max END AS temp_max) FROM sd""")
# adding zero, since a tail that rounds to nothing may come out as -0.0
q("significance_screen_signal", ["sd_signal"], re.sub(r"\bsd\b", "sd_signal", Q["significance_screen"][1])
  .replace("SELECT * FROM tests", "SELECT * REPLACE (p_value + 0.0::DOUBLE AS p_value) FROM tests"))
q("share_vs_median", ["sd"], f"""
WITH rr AS (SELECT *, 1 AS one FROM ({_rho_raw_sql(STORE_MIX_SRC, "rain_share", "median_daily_net", "")})),
{_t_p_ctes("rr", "one")[1:]}
SELECT n, round(rho_raw, 6) AS rho, {_p_final()} AS p_value FROM rr LEFT JOIN tp_out ON rr.one = tp_out.one""")


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(needed, body) for name, (needed, body) in Q.items()}
