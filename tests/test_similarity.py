"""Normalisation and fuzzy scores (pure helpers + Spark columns)."""
from hypothesis import given, settings, strategies as st

from ledgerlark.functions import similarity as sim


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ch == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcde ", max_size=40), st.text(alphabet="abcde ", max_size=40))
def test_bit_parallel_lcs_matches_dp(a, b):
    assert sim.lcs_length(a, b) == lcs_dp(a, b)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc ", min_size=1, max_size=12), st.text(alphabet="abc ", min_size=1, max_size=30))
def test_best_window_matches_every_window(a, b):
    a, b = sorted((a, b), key=len)
    n = len(a)
    windows = [b[max(0, hi - n):hi] for hi in range(1, len(b) + n)]
    assert list(sim.stretch_lcs(a, b)) == [(len(w), lcs_dp(a, w)) for w in windows]
    scores = [int(round(100.0 * 2 * lcs_dp(a, w) / (n + len(w)))) for w in windows]
    if len(b) == n:                         # either may be the shorter one
        scores += [int(round(100.0 * 2 * lcs_dp(b, w) / (n + len(w)))) for hi in range(1, 2 * n)
                   for w in [a[max(0, hi - n):hi]]]
    want = 100 if a == b else max(scores)
    assert sim.partial_ratio(a, b) == sim.partial_ratio(b, a) == want


# Golden name similarities of accepted fuzzy matches (normalised names).
GOLDEN = [
    ("stormnomad compact cooler 203", "storm nomad compact cooler 203", 81),
    ("hearthrambler stormproof jacket 206", "hearthrambler storm proof jacket 206", 85),
    ("trailrover weekend patio heater 269", "bouldernomad patio heater", 65),
    ("canyonnomad travel tumbler 271", "fieldpacer insulated tumbler", 45),
    ("cloudnomad compact cooler 275", "summitrover cooler", 50),
]


def test_token_set_ratio_goldens():
    for a, b, want in GOLDEN:
        assert sim.token_set_ratio(a, b) == want, (a, b)


def test_ratio_edges():
    assert sim.ratio("", "") == 100          # equal strings first
    assert sim.ratio("abc", "") == 0
    assert sim.token_set_ratio("", "abc") == 0
    assert sim.token_set_ratio("b a", "a b") == 100
    assert sim.partial_ratio("cooler", "compact cooler 275") == 100
    assert 0 <= sim.partial_ratio("abcd", "xbcy") <= 100


def test_spark_columns_match_helpers(spark):
    from pyspark.sql import functions as F
    from ledgerlark.functions.text import normalize_text, token_overlap_similarity
    rows = [("StormNomad Compact-Cooler 203", "Storm Nomad Compact Cooler 203"),
            (None, "x"), ("  A__b  ", "a b")]
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select(normalize_text(F.col("a")).alias("na"), normalize_text(F.col("b")).alias("nb"))
    out = out.select("na", "nb", sim.similarity(F.col("na"), F.col("nb")).alias("s"),
                     token_overlap_similarity(F.col("na"), F.col("nb")).alias("o")).collect()
    assert out[0]["na"] == "stormnomad compact cooler 203"
    assert out[0]["s"] == 0.81
    assert out[1]["na"] == "" and out[1]["s"] == 0.0
    assert out[2]["na"] == "a b" and out[2]["s"] == 1.0 and out[2]["o"] == 1.0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 ", max_size=30), st.text(alphabet="ab1 ", max_size=30))
def test_token_set_ratio_is_its_definition(a, b):
    ta, tb = set(a.split()), set(b.split())
    inter = " ".join(sorted(ta & tb))
    x, y = ((inter + " " + " ".join(sorted(rest))).strip() for rest in (ta - tb, tb - ta))
    want = max(sim.ratio(inter, x), sim.ratio(inter, y), sim.ratio(x, y)) if ta and tb else 0
    assert sim.token_set_ratio(a, b) == want


def test_shared_tokens_are_not_searched(monkeypatch):
    searched, lcs = [], sim.lcs_length
    monkeypatch.setattr(sim, "lcs_length", lambda a, b: searched.append((a, b)) or lcs(a, b))
    assert sim.token_set_ratio("rain jacket 21", "jacket rain 12") == 93
    assert sim.token_set_ratio("rain jacket", "jacket rain 12") == 100
    assert searched == [("21", "12")]
