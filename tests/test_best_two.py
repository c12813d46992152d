"""Best two by bounds against all scored pairs."""
import random

import numpy as np
import pytest

from ledgerlark.functions import similarity
from ledgerlark.operators import best_two as P
from ledgerlark.operators import crosswalk as X

WORDS = ["trail", "jacket", "rain", "pro", "cooler", "xl", "storm", "kit", "alt", "7", "2000", "trial", "jackets"]


def text(rng, most=5):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, most)))


def test_bounds_are_never_below_the_ratio():
    rng = random.Random(7)
    a, b = ([text(rng) for _ in range(60)] for _ in range(2))
    ta, tb = P.Texts(a), P.Texts(b)
    exact = np.array([[similarity.token_set_ratio(x, y) / 100 for y in b] for x in a])
    pairs = P.pair_bounds(ta, tb)
    assert (pairs >= exact).all()
    assert (P.cell_bound(ta, *tb.summary()) >= pairs.max(axis=1) - 1e-12).all()
    assert pairs.mean() < 0.85                   # they do tell pairs apart


def test_top_two_of_a_cell():
    rng = random.Random(3)
    a, b = ([text(rng) for _ in range(40)] for _ in range(2))
    subs, new_subs = ([rng.choice(["shell", "rain shell", ""]) for _ in range(40)] for _ in range(2))
    base, price = ([rng.choice([None, 0.0, 10.0, 12.5]) for _ in range(40)] for _ in range(2))
    weights = (X.W_NAME, X.W_SUBCLASS, X.W_PRICE)
    found, tried = P.top_two(a, subs, base, b, new_subs, price, list(range(40)), weights)
    closeness = P.price_closeness(P._numbers(base)[:, None], P._numbers(price)[None, :])
    for i in range(40):
        scores = sorted((-(0.6 * (similarity.token_set_ratio(a[i], b[j]) / 100) + 0.2 * (
            similarity.token_set_ratio(subs[i], new_subs[j]) / 100) + 0.2 * closeness[i, j]), j) for j in range(40))[:2]
        assert [(j, s) for r, j, _, s in found if r == i] == [(j, -s) for s, j in scores]
    assert tried < 40 * 40 / 2


def catalogs(spark, rows, new_rows):
    legacy = spark.createDataFrame(rows, "product_id string, product_name string, category string, subcategory string, "
                                         "base_price string, margin_rate string, launch_date string, catalog_pos long")
    new = spark.createDataFrame(new_rows, "new_product_id string, item_name string, department string, class string, "
                                          "msrp string, gross_margin string, launch_date string, catalog_pos long")
    return legacy, new


def fixture(rng, n):
    """A hot block, small ones, ties, repeated names, empty texts, prices and
    dates that are missing or odd."""
    def price():
        return rng.choice([None, "0", "-3", "x", "10", "12.5", "13.10", "1e400"])

    def date():
        return rng.choice(["1900-01-01"] * 4 + ["2020-01-01", "2021-01-01", None])
    legacy = [(f"P{i}", text(rng) or None, "outerwear", rng.choice(["rain shell", "", None]), price(), "0.3", date(), i)
              for i in range(n)]
    new = [(f"N{i}", text(rng) + " n", "apparel", rng.choice(["rain shell", "shell", ""]), price(), "0.3", date(), i)
           for i in range(n)]
    return legacy, new


@pytest.mark.parametrize("hot_pairs,cell", [(0, 4), (30, 7)])
def test_same_rows_as_all_pairs(spark, hot_pairs, cell):
    legacy, new = catalogs(spark, *fixture(random.Random(cell), 90))

    def rows(ranked):
        return sorted((r.l_pos, r.n_cands, r.b.new_product_id, r.b.score, r.b.name_sim,
                       r.s and r.s.new_product_id, r.s and r.s.score) for r in ranked.collect())
    got = rows(X.best_two(legacy, new, hot_pairs=hot_pairs, cell=cell))
    assert got == rows(X.rank_candidates(X.scored_candidates(legacy, new)))
    assert max(r[1] for r in got) > 30


def test_empty_catalogs(spark):
    legacy, new = catalogs(spark, [], [])
    assert X.best_two(legacy, new, hot_pairs=0).collect() == []
    assert X.build_crosswalk(legacy, new).collect() == []


def test_bounds_of_many_cells_and_rows_at_once():
    rng = random.Random(11)
    a = P.Texts([text(rng) for _ in range(30)])
    summaries = [P.Texts([text(rng) for _ in range(9)]).summary() for _ in range(12)]
    together = P.cell_bounds(a, *zip(*summaries))
    assert together.shape == (30, 12)
    assert all((together[:, j] == P.cell_bound(a, *s)).all() for j, s in enumerate(summaries))
    names, subs = [[text(rng) for _ in range(20)] for _ in range(2)], [["shell"] * 20] * 2
    args = (names[0], subs[0], [10.0] * 20, names[1], subs[1], [9.0] * 20, list(range(20)), (0.6, 0.2, 0.2))
    whole, some = P.top_two(*args), P.top_two(*args, rows=[3, 17])
    assert some[0] == [x for x in whole[0] if x[0] in (3, 17)] and some[1] < whole[1]
    assert P.top_two(*args, rows=[])[0] == []


def test_bounds_and_scores_are_spread(spark, monkeypatch):
    """Few bytes, much work: the tasks are as many as the session's shuffles have."""
    parts = {}
    cut = P.cut_lineage

    def noted(df, name):
        parts[name] = df.rdd.getNumPartitions()
        return cut(df, name)
    monkeypatch.setattr(P, "cut_lineage", noted)
    legacy, new = catalogs(spark, *fixture(random.Random(5), 60))
    X.best_two(legacy, new, hot_pairs=0, cell=4).collect()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [parts[n] for n in ("cell_bounds", "seed_scores", "rest_scores")] == [tasks] * 3


def test_cells_of_groups_that_no_row_needs_are_not_bounded(spark, monkeypatch):
    rng = random.Random(2)
    kinds = ["amber lamp", "birch stool", "copper kettle", "denim jacket", "ivory comb", "maple flute"]
    legacy = [(f"P{i}", f"{k} {rng.randint(10, 99)} x", "outerwear", k, "10", "0.3", "1900-01-01", i)
              for i, k in enumerate(kinds * 16)]
    new = [(f"N{i}", f"{k} {rng.randint(10, 99)} y", "apparel", k, "10", "0.3", "1900-01-01", i)
           for i, k in enumerate(kinds * 16)]
    legacy, new = catalogs(spark, legacy, new)
    monkeypatch.setattr(P, "GROUP", 2, raising=False)
    monkeypatch.setattr(P, "SEED_GROUPS", 1, raising=False)
    stages, cut = {}, P.cut_lineage

    def noted(df, name):
        stages[name] = cut(df, name)
        return stages[name]
    monkeypatch.setattr(P, "cut_lineage", noted)

    def rows(ranked):
        return sorted((r.l_pos, r.b.new_product_id, r.b.score, r.s.new_product_id, r.s.score) for r in ranked.collect())
    got = rows(X.best_two(legacy, new, hot_pairs=0, cell=4))
    bounded = sum(stages[n].count() for n in ("cell_bounds", "rest_bounds") if n in stages)
    assert bounded < stages["legacy_cells"].count() * stages["new_cells"].count() / 2
    assert got == rows(X.rank_candidates(X.scored_candidates(legacy, new)))


def test_repeated_texts_are_looked_at_once():
    a, b = P.Texts(["rain shell", "", "rain shell", None]), P.Texts(["shell", "shell", "rain"])
    assert a.distinct()[0].tokens == [["rain", "shell"], []] and a.distinct()[1].tolist() == [0, 1, 0, 1]
    for i, x in enumerate(["rain shell", "", "rain shell", ""]):
        for j, y in enumerate(["shell", "shell", "rain"]):
            assert P.pair_bounds(a, b)[i, j] == P.pair_bounds(P.Texts([x]), P.Texts([y]))[0, 0]
