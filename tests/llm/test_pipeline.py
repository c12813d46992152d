from collections import Counter

import corpus_pipeline as C
from ledgerlark.llm import quality_rules, simhash
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_stages_against_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("fp", F.lit("x"))
    stages = dict(C.STAGES)
    kept = stages["quality_rules"](spark, docs, SF).cache()
    led = quality_rules.apply_policy(quality_rules.ledger(docs)).where("kept")
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in led.collect())
    assert kept.columns == docs.columns
    clean = stages["toxicity"](spark, kept, SF).cache()
    assert clean.columns == docs.columns and 0.85 * kept.count() < clean.count() < kept.count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in kept.collect()} - {r.doc_id for r in clean.collect()}
    assert sum(labels.get(i) == 0 for i in gone) <= 1 and sum(labels.get(i) == 1 for i in gone) >= 25
    single = stages["near_duplicates"](spark, clean, SF).cache()
    comp = simhash.near_duplicates(clean).collect()
    assert Counter(r.doc_id for r in single.collect()) == Counter({r.component_id for r in comp})
    mixed = stages["mixing"](spark, single, SF)
    n = Counter(r.doc_id for r in mixed.collect())
    assert set(n) == {r.doc_id for r in single.collect()}      # none is lost
    tokens = {r.doc_id: r.n_tokens for r in stages["encoding"](spark, single, SF).collect()}
    lang = {r.doc_id: r.lang for r in single.collect()}
    own, mixed_total = Counter(), Counter()
    for i, copies in n.items():
        own[lang[i]] += tokens[i]
        mixed_total[lang[i]] += copies * tokens[i]
    goal = {x: own[x] ** C.TEMPER for x in own}
    for x in own:   # token shares after the stage are the tempered ones
        assert abs(mixed_total[x] / sum(mixed_total.values()) - goal[x] / sum(goal.values())) < 0.02
    assert mixed.columns == docs.columns
    coded = stages["encoding"](spark, single, SF).collect()
    want = {r.doc_id: r.h for r in single.select("doc_id", F.sha2("text", 256).alias("h")).collect()}
    assert {r.doc_id: r.decoded_sha256 for r in coded} == want


def test_odd_and_empty_tables(spark, odd, empty, labels, tmp):
    for name, docs in (("odd", odd), ("empty", empty)):
        sf = f"{tmp}/{name}"
        docs.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        got = C.run(spark, sf)
        assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        # of the odd rows only the long text has the words that the rules ask for
        assert [r.doc_id for r in got.collect()] == ([] if name == "empty" else [5])
