"""E10-E17 on a handful of real catalog rows with their published crosswalk
outcomes (exact name, fuzzy medium/high, two ambiguous twin blocks)."""
from ledgerlark.operators.crosswalk import build_crosswalk

LEGACY = [
    ("P1001", "SummitRunner Lightweight Jacket 200", "outerwear", "rain shell", "130.82", "0.54", "2019-01-01"),
    ("P1004", "StormNomad Compact Cooler 203", "patio", "cooler", "109.9", "0.31", "2022-04-04"),
    ("P1007", "HearthRambler Stormproof Jacket 206", "outerwear", "rain shell", "112.42", "0.43", "2025-07-07"),
    ("P1077", "FieldRunner Storm Kit Battery Pack 276", "emergency", "battery pack", "95.15", "0.34", "2025-05-05"),
    ("P1079", "MoonRambler Stormproof Jacket 278", "outerwear", "rain shell", "256.21", "0.41", "2020-07-07"),
]
NEW = [
    ("NP5001", "SummitRunner Lightweight Jacket 200", "apparel", "waterproof outerwear", "129.77", "0.54", "2019-01-01"),
    ("NP5004", "Storm Nomad Compact Cooler 203", "patio", "cooler", "108.96", "0.31", "2022-04-04"),
    ("NP5007", "HearthRambler Storm proof Jacket 206", "apparel", "waterproof outerwear", "109.09", "0.43", "2025-07-07"),
    ("NP5073", "FieldRunner Battery Pack", "preparedness", "power storage", "91.38", "0.34", "2025-05-05"),
    ("NP5075", "MoonRambler Rain Shell", "apparel", "waterproof outerwear", "274.77", "0.41", "2020-07-07"),
    ("NP5077", "FieldRunner Battery Pack Alt", "preparedness", "power storage", "97.78", "0.34", "2025-05-05"),
    ("NP5079", "MoonRambler Rain Shell Alt", "apparel", "waterproof outerwear", "252.43", "0.41", "2020-07-07"),
]
EXPECTED = {
    "P1001": ("NP5001", "matched", "high", "exact_name", "exact normalized name match", 0),
    "P1004": ("NP5004", "matched", "medium", "attributes_fuzzy", "attribute block unique; name_sim=0.81", 1),
    "P1007": ("NP5007", "matched", "high", "attributes_fuzzy", "attribute block unique; name_sim=0.85", 0),
    "P1077": ("NP5073", "possible_match", "medium", "attributes_fuzzy",
              "two close candidates (NP5073 vs NP5077); picked higher name/price score", 1),
    "P1079": ("NP5075", "possible_match", "medium", "attributes_fuzzy",
              "two close candidates (NP5075 vs NP5079); picked higher name/price score", 1),
}


def test_crosswalk_on_catalog_rows(spark):
    legacy = spark.createDataFrame(
        [r + (int(r[0][1:]),) for r in LEGACY],
        "product_id string, product_name string, category string, subcategory string, base_price string, "
        "margin_rate string, launch_date string, catalog_pos long")
    new = spark.createDataFrame(
        [r + (int(r[0][2:]),) for r in NEW],
        "new_product_id string, item_name string, department string, class string, msrp string, "
        "gross_margin string, launch_date string, catalog_pos long")
    got = {r.product_id: (r.new_product_id, r.match_status, r.match_confidence, r.match_method, r.notes,
                          r.needs_review) for r in build_crosswalk(legacy, new).collect()}
    assert got == EXPECTED
