"""Fitted operators: held-out accuracy, brute force of their parts, odd rows."""
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import bpe
from ledgerlark.llm import mixing as M
from ledgerlark.llm import ordinal_quality as Q
from ledgerlark.llm import queries
from ledgerlark.llm import toxicity as T
from ledgerlark.llm.hashed_text import frequencies, scores

SF = "/root/testdata/sf0.1"


def auc(pos, neg):
    return float(np.mean([(pos > x).mean() + (pos == x).mean() / 2 for x in neg]))


def repeated(spark):
    """One labelled doc_id in most rows, with two texts, and its labels."""
    rows = [(1, "the same good words again and again")] * 300 + [(1, "another text of that id")] * 3
    rows += [(i, f"plain words number {i} of the table") for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    return docs, docs.dropDuplicates(["doc_id"]).selectExpr("doc_id", "cast(doc_id % 2 AS int) AS y")


def test_samples_hold_one_row_a_document(spark):
    docs, labels = repeated(spark)
    feats, grades = Q.rated_features(docs, labels.withColumnRenamed("y", "grade"), 2, 6)
    assert len(feats) == len(grades) == 6
    feats, grades = Q.rated_features(docs, labels.withColumnRenamed("y", "grade"), 2, 100)
    assert len(feats) == len(grades) == 11
    texts = T.labelled_texts(docs, labels, "doc_id", "text", "y", 100).collect()
    assert len(texts) == 11 and len({r.text for r in texts}) == 11


def test_domain_fit_weighs_a_repeated_document_once(spark):
    docs, labels = repeated(spark)
    first = docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    named = labels.select("doc_id", F.concat(F.lit("d"), "y").alias("domain"))
    a, b = (M.fit_domains(d, named, "domain") for d in (docs, first))
    assert a.domains == b.domains and np.allclose(a.weights, b.weights) and np.allclose(a.bias, b.bias)


def dense_softmax(texts, y, k):
    """The domain fit over one dense matrix."""
    x = np.zeros((len(texts), 1 << 16))
    for i, t in enumerate(texts):
        at, f = frequencies(t.encode(), 1 << 16)
        x[i, at] = f
    scale = 1 / np.sqrt((x * x).mean(axis=0) + 1e-9)
    scale /= np.sqrt(((x * scale) ** 2).sum(axis=1)).mean()
    x = np.hstack([x * scale, np.ones((len(x), 1))])
    w = np.zeros((x.shape[1], k))
    w[-1] = np.log(np.bincount(y, minlength=k) / len(y))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, M.STEPS + 1):
        p = np.exp(x @ w)
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - np.eye(k)[y]) / len(x)
        g[:-1] += M.RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x @ w


def test_domain_fit_in_65536_buckets(spark):
    texts = [f"{a} text {i} {b}" for i, (a, b) in enumerate([("the", "of and"), ("der", "und mit"), ("les", "et dans")] * 6)]
    y = np.arange(18) % 3
    docs = spark.createDataFrame([(i, t, f"d{y[i]}") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = M.fit_domains(docs, docs.select("doc_id", "lang"), "lang")
    assert model.weights.shape == (1 << 16, 3)
    z = np.array([scores(t.encode(), model.weights) + model.bias for t in texts])
    want = dense_softmax(texts, y, 3)
    assert np.abs((z - z[:, :1]) - (want - want[:, :1])).max() < 1e-2 and (z.argmax(axis=1) == y).all()


# -- toxicity ----------------------------------------------------------------

def brute_segments(s):
    """The definition: the best segment, then the same left and right of it."""
    if not len(s) or max(s) <= 0:
        return []
    total = np.concatenate(([0.0], np.cumsum(s)))
    best = max(((total[j] - total[i], -(j - i), -i, i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)))
    i, j = best[3], best[4]
    return (brute_segments(s[:i]) + [(i, j, round(best[0], 6))]
            + [(a + j, b + j, x) for a, b, x in brute_segments(s[j:])])


def test_segments_are_maximal():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 25, 40):
        for _ in range(40):
            s = rnd.normal(-0.2, 1, n)
            assert [(a, b, round(x, 6)) for a, b, x in T.segments(s)] == brute_segments(s)
            assert abs(T.best_segment(s) - max([x for _, _, x in T.segments(s)], default=0)) < 1e-9


def test_toxicity_odd_rows(spark, odd, empty, labels):
    model = T.fit(odd, labels)
    got = T.passages(odd, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert T.passages(empty, model).count() == 0
    none = T.fit(odd, labels.where("toxic = 0"))
    assert {r.score for r in T.passages(odd, none).collect()} == {0.0}
    assert T.fit(empty, labels).slope == 0 and T.fit(odd, labels.limit(0)).slope == 0
    scored = odd.withColumn("s", T.score_column(F.coalesce("text", F.lit("")), model)).collect()
    assert sorted(r.s for r in scored) == sorted(r.score for r in got)


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op9_segment_toxicity(spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert auc(toxic.score.values, clean.score.values) > 0.95
    assert (toxic.predicted == 1).mean() > 0.85 and (clean.predicted == 1).mean() < 0.01


def test_labels_held_out_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = T.held_out(F.col("doc_id"))
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (T.fit(docs, x.where(~held)) for x in (labels, flipped))
    assert (a.lam, a.log_k, a.slope, a.shift) == (b.lam, b.log_k, b.slope, b.shift)


# -- ordinal quality ------------------------------------------------------------

def test_ordinal_recovers_order():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=800)
    y = np.digitize(x + rnd.logistic(0, 0.2, 800), [-1, 0, 1])
    feats = [(np.array([3, 9], np.int32), np.array([max(v, 0), max(-v, 0)], np.float32)) for v in x]
    m = Q.fit_ordinal(feats, y, 4)
    assert (np.diff(m.thresholds) > 0).all() and m.weights[3] > 0 > m.weights[9]
    tails = m.tails(np.linspace(-5, 5, 50))
    assert (np.diff(tails, axis=0) >= 0).all() and (np.diff(tails, axis=1) <= 0).all()


def test_ordinal_fit_against_its_likelihood(monkeypatch):
    """The fit against one whose loss is written out document by document and
    whose gradient is taken by differences."""
    dim, steps, grades = 5, 40, 4
    monkeypatch.setattr(Q, "QUALITY_DIM", dim)
    monkeypatch.setattr(Q, "STEPS", steps)
    rnd = np.random.default_rng(6)
    x, y = rnd.random((30, dim)), rnd.integers(0, grades, 30)
    x[rnd.random(x.shape) < 0.3] = 0
    model = Q.fit_ordinal([(np.flatnonzero(r).astype(np.int32), r[r > 0].astype(np.float32)) for r in x], y, grades)
    scale = 1 / np.sqrt((x ** 2).mean(axis=0) + 1e-9)
    z = x * scale
    norm = np.mean([np.sqrt(sum(v * v for v in r)) for r in z])
    z = z / norm

    def loss(theta):
        cuts = [theta[dim]]
        for t in theta[dim + 1:]:
            cuts.append(cuts[-1] + np.exp(t))
        total = 0.0
        for r, g in zip(z, y):
            at_most = [1 / (1 + np.exp(-(c - float(r @ theta[:dim])))) for c in cuts] + [1.0]
            total -= np.log(at_most[g] - (at_most[g - 1] if g else 0.0))
        return total / len(y) + Q.RIDGE / 2 * float(theta[:dim] @ theta[:dim])

    share = np.array([(y >= k).mean() for k in range(1, grades)])
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    theta = np.concatenate([np.zeros(dim), start[:1], np.log(np.diff(start))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        g = np.array([(loss(theta + e) - loss(theta - e)) / 2e-6 for e in np.eye(len(theta)) * 1e-6])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    assert np.allclose(model.weights, theta[:dim] * scale / norm, atol=2e-3)
    assert np.allclose(model.thresholds, theta[dim] + np.concatenate([[0], np.cumsum(np.exp(theta[dim + 1:]))]), atol=2e-3)


def test_quality_odd_rows(spark, odd, empty, labels):
    rated = labels.select("doc_id", F.col("quality").alias("grade"))
    for r in (rated, rated.where("grade = 1"), rated.limit(0)):
        m = Q.fit(odd, r, 2)
        got = Q.score(odd, m).collect()
        assert len(got) == 10 and all(0 <= x.tail_probability <= 1 for x in got)
        assert Q.score(empty, m).count() == 0


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    rated = labels.where(~held).select("doc_id", F.when(F.col("quality") == 0, 0).otherwise(2 - F.col("toxic")).alias("grade"))
    got = Q.score(docs, Q.fit(docs, rated, 3)).join(labels.where(held), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert auc(good.tail_probability.values, bad.tail_probability.values) > 0.85
    assert good.kept.mean() > 0.98 and bad.kept.mean() < 0.4


# -- mixing ------------------------------------------------------------------------

def brute_rates(p, n, target, rounds=5000):
    """Dense projected gradient over documents, in the same metric."""
    gram = (p * n[:, None]).T @ p
    scale = 1 / np.diag(gram)
    half = np.sqrt(scale)
    step = 1 / np.linalg.eigvalsh(half[:, None] * gram * half).max()
    r = np.full(len(p), target.sum() / n.sum())
    for _ in range(rounds):
        r = np.maximum(0, r - step * p @ (scale * ((r * n) @ p - target)))
    return r


@pytest.mark.parametrize("weights", [(0.5, 0.3, 0.2), (0.05, 0.05, 0.9), (1.0, 0.0, 0.0)])
def test_rates_meet_targets(spark, weights):
    rnd = np.random.default_rng(2)
    q = np.array([rnd.multinomial(M.GRAIN, rnd.dirichlet([0.2, 0.2, 0.2])) for _ in range(300)])
    n = rnd.integers(0, 500, 300)
    member = spark.createDataFrame([(i, int(n[i]), *map(int, q[i])) for i in range(300)],
                                   "doc_id long, n_tokens long, q0 long, q1 long, q2 long")
    fit = M.fit_rates(member, ["a", "b", "c"], dict(zip("abc", weights)), close=1e-5)
    target, reached = fit.target, fit.reached
    rows = M.with_rates(member, fit).collect()
    got = {r.doc_id: r.rate for r in rows}
    assert fit.met == (0.0 not in weights)                    # a target that can't be met is reported
    assert all(r.domain_target == target["abc".index(r.domain)] for r in rows)
    assert all(r.domain_reached == reached["abc".index(r.domain)] for r in rows)
    p = q / M.GRAIN
    r = np.array([got[i] for i in range(300)])
    assert (r >= 0).all() and np.allclose((r * n) @ p, reached)
    want = brute_rates(p, n.astype(float), target)
    # as near to the targets as the best nonnegative rates come
    assert np.abs(reached - target).max() <= np.abs((want * n) @ p - target).max() + (1e-2 if 0.0 in weights else 1e-3) * n.sum()


def test_no_loss_and_odd_rows(spark, odd, empty):
    labelled = odd.select("doc_id", "lang")
    model = M.fit_domains(odd, labelled, "lang")
    rows = M.with_members(odd, model)
    member = M.members_of(rows, len(model.domains))
    fit = M.fit_rates(member, model.domains, M.tempered(member, model.domains, 0.5), "no_loss", least=1.0)
    out = M.resample(rows, fit.rates)
    assert out.columns == odd.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in odd.collect()} and out.count() >= odd.count()
    assert M.mix(odd, labelled, "lang", {"en": 1, "xx": 1}).count() == 10
    assert M.mix(empty, labelled, "lang", {"en": 1}).count() == 0
    assert {r.rate for r in M.mix(odd, labelled.limit(0), "lang", {}).collect()} == {1.0}


def test_held_out_languages_and_totals_after_resampling(spark):
    """Languages of documents whose labels the fit hasn't seen; tokens of the
    repeated documents against the targets of the fit."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = T.held_out(F.col("doc_id"))
    model = M.fit_domains(docs, docs.where(~held).join(labels, "doc_id", "left_semi"), "lang")
    rows = M.with_members(docs, model)
    top = [F.struct(F.col(f"{M.MEMBER}.q")[j].alias("q"), F.lit(d).alias("d")) for j, d in enumerate(model.domains)]
    assert rows.where(held & (F.greatest(*top)["d"] == F.col("lang"))).count() >= 0.999 * rows.where(held).count()
    member = M.members_of(rows, len(model.domains))
    fit = M.fit_rates(member, model.domains, M.tempered(member, model.domains, 0.7), "no_loss", least=1.0)
    assert fit.met and np.abs(fit.reached - fit.target).max() <= M.CLOSE * fit.target.sum()
    again = M.memberships(M.resample(rows, fit.rates), model)
    got = again.agg(*[F.sum(F.col("n_tokens") * F.col(f"q{j}") / M.GRAIN) for j in range(len(model.domains))]).first()
    assert np.abs(np.array(got) - fit.target).max() < 0.01 * fit.target.sum()


def random_texts(n):
    rnd = np.random.default_rng(7)
    parts = [" ", "  ", "\n", "\n\n", "   ", "\t", "\r\n", "\u00a0", "\u3000", "\u2009", "a", "The", "é", "Éa", "’", "'s", "don't", ".", "...",
             "x1", "12", "日本", "<|endoftext|>", "×", "÷a", "ß!", "\x1c", "\x85", "_", "-"]
    return ["".join(rnd.choice(parts, rnd.integers(0, 25))) for _ in range(n)]


def test_tokens_are_the_encoders(spark, odd):
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(90, "日本語の文章" * 20), (91, "QUJDRA" * 30)], "doc_id long, text string"))
    docs = docs.union(spark.createDataFrame([(92 + i, t) for i, t in enumerate(random_texts(400))], "doc_id long, text string"))
    got = M.memberships(docs, M.fit_domains(odd, odd.select("doc_id", "lang"), "lang")).select("doc_id", "n_tokens").collect()
    want = bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_tokens").collect()
    key = lambda r: (r.doc_id or 0, r.n_tokens)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert min(r.n_tokens for r in got if r.doc_id in (90, 91)) > 20


def test_languages_meet_their_weights(spark):
    got = queries.op7_soft_mixing(spark, "/root/testdata/sf0.01").toPandas()
    total = (got.rate * got.n_tokens).groupby(got.domain).sum()
    for lang, w in queries.LANGUAGE_WEIGHTS.items():
        assert abs(total[lang] / total.sum() - w) < 0.02
