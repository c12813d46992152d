"""Product crosswalk: entity resolution between two catalogs.

Tiers
  1. exact normalised name; the first new-catalog row (catalog order) wins.
  2. equi-join on the block key (launch_date, margin text, mapped department)
     for tier-1 misses; score = 0.6 name + 0.2 subclass + 0.2 price closeness;
     best and runner-up per legacy row; floor / ambiguity / confidence rules.
  3. no block partner -> unresolved.

Scale: tier 2 is an equi-join, so only pairs inside a block are scored, and of a
hot block only those that can be a best or second best (``best_two``). Queries
over every pair (E20) read ``scored_candidates``; there "best" and "runner-up"
come from two partial (map-side combined) aggregations --
``max(struct(score, -pos, id))`` -- instead of a window, so a legacy row with a
huge candidate list never has to sit in one task.

Legacy input columns: product_id, product_name, category, subcategory,
base_price, margin_rate, launch_date, catalog_pos.
New input columns: new_product_id, item_name, department, class, msrp,
gross_margin, launch_date, catalog_pos.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.numeric import to_double
from ledgerlark.functions.similarity import similarity, similarity_pair
from ledgerlark.functions.text import normalize_text
from ledgerlark.operators import best_two as pruned
from ledgerlark.session import cut_lineage

# Legacy category -> new-system department rename.
CATEGORY_TO_DEPARTMENT = {
    "camping": "camping",
    "emergency": "preparedness",
    "footwear": "footwear",
    "hydration": "drinkware",
    "outerwear": "apparel",
    "patio": "patio",
}

# Scoring weights and thresholds.
W_NAME, W_SUBCLASS, W_PRICE = 0.6, 0.2, 0.2
STRONG_NAME = 0.85
AMBIGUOUS_GAP = 0.05
MIN_SCORE = 0.60

# Note texts.
NOTE_EXACT = "exact normalized name match"
NOTE_NONE = "no candidate sharing launch_date+margin+department"

CROSSWALK_COLUMNS = ["product_id", "new_product_id", "match_status", "match_confidence",
                     "match_method", "notes", "needs_review"]


def department_of(category: Column, mapping: dict | None = None, default: str = "") -> Column:
    """Rename by lower(category); a miss gives ``default``."""
    mapping = CATEGORY_TO_DEPARTMENT if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[F.lower(category.cast("string"))], F.lit(default))


def price_closeness(base: Column, msrp: Column) -> Column:
    """max(0, 1 - |m - b| / b); 0 when b <= 0 or either side unparsable."""
    b, m = to_double(base, strip_currency=False), to_double(msrp, strip_currency=False)
    v = F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(m - b) / b)
    return F.when((b > 0) & m.isNotNull(), v).otherwise(F.lit(0.0))


def _fmt2(c: Column) -> Column:
    return F.format_string("%.2f", c)


def prepare(legacy: DataFrame, new: DataFrame, mapping: dict | None = None):
    L = legacy.select(
        "product_id", "product_name", "subcategory", "base_price",
        F.col("margin_rate").alias("_m"), F.col("launch_date").alias("_d"),
        department_of(F.col("category"), mapping).alias("_dept"),
        F.col("catalog_pos").alias("l_pos"),
        normalize_text(F.col("product_name")).alias("l_name"),
        normalize_text(F.col("subcategory")).alias("l_sub"))
    N = new.select(
        "new_product_id", "msrp",
        F.col("gross_margin").alias("_m"), F.col("launch_date").alias("_d"),
        F.col("department").alias("_dept"),
        F.col("catalog_pos").alias("n_pos"),
        normalize_text(F.col("item_name")).alias("n_name"),
        normalize_text(F.col("class")).alias("n_class"))
    return L, N


def exact_name_matches(L: DataFrame, N: DataFrame) -> DataFrame:
    """(legacy row, first new id with the same normalised name)."""
    first = (N.groupBy("n_name")
             .agg(F.min_by("new_product_id", "n_pos").alias("new_product_id")))
    return L.join(first, L.l_name == first.n_name, "inner").drop("n_name")


def scored_candidates(legacy: DataFrame, new: DataFrame, mapping: dict | None = None,
                      method: str = "token_set_ratio") -> DataFrame:
    """E11 + E4-E8: every tier-2 candidate pair with its component scores."""
    L, N = prepare(legacy, new, mapping)
    return _scored(_not_exact(L, N), N, method)


def _not_exact(L: DataFrame, N: DataFrame) -> DataFrame:
    first_names = N.select("n_name").distinct()
    return L.join(first_names, L.l_name == first_names.n_name, "left_anti")


def _scored(rest: DataFrame, N: DataFrame, method: str = "token_set_ratio") -> DataFrame:
    # spread the scored pairs over the cluster before the Python UDF (a block
    # join whose sides were broadcast keeps the catalog scan's few splits)
    pairs = rest.join(N, ["_d", "_m", "_dept"], "inner").repartition("l_pos")
    price = price_closeness(F.col("base_price"), F.col("msrp"))
    if method == "exact_token_overlap":          # fully native
        name_sim = similarity(F.col("l_name"), F.col("n_name"), method)
        sub_sim = similarity(F.col("l_sub"), F.col("n_class"), method)
    else:                                        # one Arrow round trip for both scores
        both = similarity_pair(F.col("l_name"), F.col("n_name"), F.col("l_sub"), F.col("n_class"), method)
        pairs = pairs.withColumn("_s", both)
        name_sim = F.col("_s.first").cast("double") / F.lit(100.0)
        sub_sim = F.col("_s.second").cast("double") / F.lit(100.0)
    return (pairs.select("product_id", "l_pos", "new_product_id", "n_pos",
                         name_sim.alias("name_sim"), sub_sim.alias("subclass_sim"),
                         price.alias("price_sim"))
            .withColumn("score", F.lit(W_NAME) * F.col("name_sim")
                        + F.lit(W_SUBCLASS) * F.col("subclass_sim")
                        + F.lit(W_PRICE) * F.col("price_sim")))


def rank_candidates(scored: DataFrame) -> DataFrame:
    """Per legacy row: best, runner-up, candidate count.

    Ties keep catalog order (smaller ``n_pos`` first)."""
    key = F.struct(F.col("score"), (-F.col("n_pos")).alias("neg_pos"),
                   F.col("new_product_id"), F.col("name_sim"))
    best = (scored.groupBy("l_pos")
            .agg(F.max(key).alias("b"), F.count(F.lit(1)).alias("n_cands")))
    second = (scored.join(best.select("l_pos", F.col("b.neg_pos").alias("_bneg")), "l_pos")
              .where((-F.col("n_pos")) != F.col("_bneg"))
              .groupBy("l_pos").agg(F.max(key).alias("s")))
    return best.join(second, "l_pos", "left")


def best_two(legacy: DataFrame, new: DataFrame, mapping: dict | None = None,
             hot_pairs: int = pruned.HOT_PAIRS, cell: int = pruned.CELL) -> DataFrame:
    """E11 + E12 without all pairs: per legacy row with a block partner the best
    ``b`` and runner-up ``s`` (NULL if alone) by token-set score, ties in catalog
    order, and the size of its block. Blocks of more than ``hot_pairs`` pairs
    are searched by bounds (``operators.best_two``), with the same rows."""
    L, N = prepare(legacy, new, mapping)
    rest = cut_lineage(_not_exact(L, N), "not_exact")
    block = pruned.BLOCK
    sizes = cut_lineage(
        rest.groupBy(*block).agg(F.count(F.lit(1)).alias("_nl"))
        .join(N.groupBy(*block).agg(F.count(F.lit(1)).alias("n_cands")), block)
        .withColumn("hot", F.col("_nl") * F.col("n_cands") > hot_pairs), "block_sizes")
    small, hot = (sizes.where(c).select(*block) for c in (~F.col("hot"), F.col("hot")))
    keep = [F.col("l_pos").cast("long").alias("l_pos"), "new_product_id", F.col("n_pos").cast("long").alias("n_pos"),
            "name_sim", "score"]
    found = _scored(rest.join(small, block), N).select(*keep)
    if not hot.isEmpty():
        found = found.unionByName(pruned.hot_best(
            pruned.numbers(rest.join(hot, block), "l_pos", "product_id", "l_name", "l_sub", "base_price"),
            pruned.numbers(N.join(hot, block), "n_pos", "new_product_id", "n_name", "n_class", "msrp"),
            (W_NAME, W_SUBCLASS, W_PRICE), cell).select(*keep))
    one = F.struct("score", "new_product_id", "name_sim")
    best = pruned.ranked(found, ["l_pos"]).groupBy("l_pos").agg(
        F.max(F.when(F.col("_rn") == 1, one)).alias("b"), F.max(F.when(F.col("_rn") == 2, one)).alias("s"))
    counts = rest.join(sizes, block).select(F.col("l_pos").cast("long").alias("l_pos"), "n_cands")
    # read by tier 2 and tier 3: the similarity runs once
    return cut_lineage(best.join(counts, "l_pos"), "best_two")


def build_crosswalk(legacy: DataFrame, new: DataFrame, mapping: dict | None = None,
                    method: str = "token_set_ratio", keep_pos: bool = False,
                    materialize: bool = False, scored: DataFrame | None = None,
                    ranked: DataFrame | None = None) -> DataFrame:
    """One crosswalk row per legacy catalog row.

    Best and runner-up come from ``ranked`` (see :func:`best_two`, the default
    for the token-set score), or from all ``scored`` pairs.
    ``materialize`` checkpoints the scored candidate pairs (reliably, into the
    shared checkpoint folder) so the similarity UDF runs once even though
    best and runner-up both read the pairs."""
    L, N = prepare(legacy, new, mapping)
    tier1 = (exact_name_matches(L, N)
             .select("product_id", "l_pos", "new_product_id",
                     F.lit("matched").alias("match_status"), F.lit("high").alias("match_confidence"),
                     F.lit("exact_name").alias("match_method"), F.lit(NOTE_EXACT).alias("notes")))
    if ranked is None and scored is None and method == "token_set_ratio":
        ranked = best_two(legacy, new, mapping)
    elif ranked is None:
        if scored is None:
            scored = scored_candidates(legacy, new, mapping, method)
            if materialize:
                scored = cut_lineage(scored, "scored_pairs")
        ranked = rank_candidates(scored)
    b, s = F.col("b"), F.col("s")
    below = b.score < MIN_SCORE
    ambiguous = (F.col("n_cands") > 1) & ((b.score - s.score) < AMBIGUOUS_GAP)
    status = (F.when(below, "unresolved").when(ambiguous, "possible_match").otherwise("matched"))
    conf = (F.when(below, "low").when(ambiguous, "medium")
            .when(b.name_sim >= STRONG_NAME, "high").otherwise("medium"))
    note = (F.when(below, F.concat(F.lit("best candidate "), b.new_product_id, F.lit(" scored "),
                                   _fmt2(b.score), F.lit(f", under the {MIN_SCORE} floor")))
            .when(ambiguous, F.concat(F.lit("two close candidates ("), b.new_product_id, F.lit(" vs "),
                                      s.new_product_id, F.lit("); picked higher name/price score")))
            .otherwise(F.concat(F.when(F.col("n_cands") == 1, F.lit("attribute block unique"))
                                .otherwise(F.lit("best of block by name/price")),
                                F.lit("; name_sim="), _fmt2(b.name_sim))))
    tier2 = (ranked.join(L.select("product_id", "l_pos"), "l_pos")
             .select("product_id", "l_pos",
                     F.when(~below, b.new_product_id).alias("new_product_id"),
                     status.alias("match_status"), conf.alias("match_confidence"),
                     F.when(below, "below_threshold").otherwise("attributes_fuzzy").alias("match_method"),
                     note.alias("notes")))
    done = tier1.select("l_pos").unionByName(tier2.select("l_pos"))
    tier3 = (L.join(done, "l_pos", "left_anti")
             .select("product_id", "l_pos", F.lit(None).cast("string").alias("new_product_id"),
                     F.lit("unresolved").alias("match_status"), F.lit("low").alias("match_confidence"),
                     F.lit("none").alias("match_method"), F.lit(NOTE_NONE).alias("notes")))
    out = (tier1.unionByName(tier2).unionByName(tier3)
           .withColumn("needs_review",
                       F.when((F.col("match_status") == "matched")
                              & (F.col("match_confidence") == "high"), 0).otherwise(1)))
    if keep_pos:
        return out.withColumnRenamed("l_pos", "catalog_pos")
    return out.select(*CROSSWALK_COLUMNS)


def crosswalk_validation(crosswalk: DataFrame) -> DataFrame:
    """One row: n_rows, matched (non-null id), distinct new ids,
    double-assigned, per-confidence counts, review breakdown."""
    has_id = F.col("new_product_id").isNotNull()
    review = F.col("needs_review") == 1
    return crosswalk.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(has_id).alias("n_mapped"),
        F.count_distinct("new_product_id").alias("n_distinct_new"),
        (F.count_if(has_id) - F.count_distinct("new_product_id")).alias("n_double_assigned"),
        F.count_if(F.col("match_confidence") == "high").alias("n_high"),
        F.count_if(F.col("match_confidence") == "medium").alias("n_medium"),
        F.count_if(F.col("match_confidence") == "low").alias("n_low"),
        F.count_if(review).alias("n_review"),
        F.count_if(review & (F.col("match_status") == "matched")).alias("n_review_matched_medium"),
        F.count_if(review & (F.col("match_status") == "possible_match")).alias("n_review_possible"),
        F.count_if(review & (F.col("match_status") == "unresolved")).alias("n_review_unresolved"),
    )


def status_summary(crosswalk: DataFrame) -> DataFrame:
    """Rows per (match_status, match_method)."""
    return (crosswalk.groupBy("match_status", "match_method")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def score_distribution(scored: DataFrame, floor: float = MIN_SCORE, gap: float = AMBIGUOUS_GAP) -> DataFrame:
    """Accepted-matched / accepted-possible / rejected score populations
    over the scored tier-2 pairs.

    Rejected = every runner-up plus a best below the floor. One row per
    population with n, min, max (scores rounded to 3 dp), plus the overlap
    interval of accepted vs rejected and how many of each fall inside it. The
    four interval bounds are one small aggregate brought back as numbers.
    """
    ranked = rank_candidates(scored).select("l_pos", F.col("b.neg_pos").alias("_bneg"),
                                            F.col("b.score").alias("_best"),
                                            F.col("s.score").alias("_second"), "n_cands")
    j = scored.join(ranked, "l_pos")
    is_best = (-F.col("n_pos")) == F.col("_bneg")
    pop = (F.when(~is_best | (F.col("_best") < floor), "rejected")
           .when((F.col("n_cands") > 1) & ((F.col("_best") - F.col("_second")) < gap), "accepted_possible")
           .otherwise("accepted_matched"))
    labelled = j.select(pop.alias("population"), "score")
    acc = F.col("population") != "rejected"
    b = labelled.agg(
        F.min(F.when(acc, F.col("score"))).alias("a_min"), F.max(F.when(acc, F.col("score"))).alias("a_max"),
        F.min(F.when(~acc, F.col("score"))).alias("r_min"), F.max(F.when(~acc, F.col("score"))).alias("r_max")
    ).first()
    if None not in (b.a_min, b.r_max, b.r_min, b.a_max) and b.r_max > b.a_min:
        lo, hi = max(b.a_min, b.r_min), min(b.a_max, b.r_max)
        inside = (F.col("score") >= F.lit(lo)) & (F.col("score") <= F.lit(hi))
    else:
        lo = hi = None
        inside = F.lit(False)
    return (labelled.groupBy("population")
            .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("min_score"),
                 F.max("score").alias("max_score"), F.count_if(inside).alias("n_in_overlap"))
            .select("population", "n",
                    F.round("min_score", 3).alias("min_score"), F.round("max_score", 3).alias("max_score"),
                    F.round(F.lit(lo).cast("double"), 3).alias("overlap_lo"),
                    F.round(F.lit(hi).cast("double"), 3).alias("overlap_hi"),
                    "n_in_overlap"))


def crosswalk_fidelity(crosswalk: DataFrame, scored: DataFrame, legacy: DataFrame) -> DataFrame:
    """E20 fidelity and weakest accept: from the re-scored tier-2 pairs,
    compare the best name similarity (2 dp) with the ``name_sim=`` persisted
    in the notes of matched fuzzy rows, and report the weakest matched accept."""
    ranked = rank_candidates(scored)
    L = legacy.select("product_id", F.col("catalog_pos").alias("l_pos"))
    best = ranked.join(L, "l_pos").select(
        "product_id", F.col("b.score").alias("score"), F.col("b.name_sim").alias("name_sim"),
        F.col("b.new_product_id").alias("best_id"))
    persisted = (crosswalk.where((F.col("match_method") == "attributes_fuzzy")
                                 & (F.col("match_status") == "matched")
                                 & F.col("notes").contains("name_sim="))
                 .select("product_id", F.regexp_extract("notes", r"name_sim=([0-9.]+)", 1)
                         .try_cast("double").alias("persisted")))
    j = persisted.join(best, "product_id", "left")
    weakest = F.min(F.struct("score", "product_id", "best_id"))
    return j.agg(F.count(F.lit(1)).alias("n_persisted"),
                 F.count_if(F.round("name_sim", 2) == F.col("persisted")).alias("n_agree"),
                 weakest.alias("_w")).select(
        "n_persisted", "n_agree", F.col("_w.product_id").alias("weakest_product_id"),
        F.col("_w.best_id").alias("weakest_new_product_id"),
        F.round(F.col("_w.score"), 3).alias("weakest_score"))


def brand_bijection(crosswalk: DataFrame, legacy: DataFrame, new: DataFrame) -> DataFrame:
    """E21 held-out validation over mapped pairs: literal brand mismatches and
    whether brand -> brand_name is one-to-one."""
    pairs = (crosswalk.where(F.col("new_product_id").isNotNull())
             .join(legacy.select("product_id", "brand"), "product_id")
             .join(new.select("new_product_id", "brand_name"), "new_product_id"))
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(~F.col("brand").eqNullSafe(F.col("brand_name"))).alias("n_brand_differs"),
        F.count_distinct("brand").alias("n_brands"),
        F.count_distinct("brand_name").alias("n_brand_names"),
        F.count_distinct("brand", "brand_name").alias("n_brand_pairs"),
    )


def apply_overrides(crosswalk: DataFrame, overrides: DataFrame) -> DataFrame:
    """Human-review overrides (product_id, new_product_id) win."""
    o = overrides.select("product_id", F.col("new_product_id").alias("_ovr"))
    j = crosswalk.join(o, "product_id", "left")
    hit = F.col("_ovr").isNotNull()
    return (j.withColumn("new_product_id", F.coalesce("_ovr", "new_product_id"))
            .withColumn("match_status", F.when(hit, "matched").otherwise(F.col("match_status")))
            .withColumn("match_confidence", F.when(hit, "high").otherwise(F.col("match_confidence")))
            .withColumn("match_method", F.when(hit, "manual").otherwise(F.col("match_method")))
            .withColumn("needs_review", F.when(hit, 0).otherwise(F.col("needs_review")))
            .drop("_ovr"))
