"""Toxic passages as maximum-scoring segments.

Fit. The words of labelled texts, once a text, are counted by class. A token's score is its
log-odds of the toxic against the clean class under Dirichlet priors: the prior
of a word is what its longest prefix says, that of a prefix what the next
shorter one says, and so on down to the classes' shares; unseen words thus
score as their beginnings do. Counts live in hashed buckets, so the model has
one size however many words the corpus has.

Score. All maximal scoring segments of a text are found in linear time over
its token scores. For scores with a negative mean, the best segment of a
clean text of n tokens follows an extreme-value law: a segment of score S has
the expected count E = K n exp(-lambda S) there. lambda solves
mean(exp(lambda s)) = 1 over clean tokens, K fits the best segments of clean
texts. A segment with E below 1 is a passage; the evidence of a text is the
sum of -log E over its passages, or that of its best segment if it has none.
A logistic curve over the evidence gives the score. lambda, K and the curve
are fitted on texts scored by the counts of the other half of the labelled
texts, so no text is judged by its own words.

The labelled texts used for the fit are at most ``MAX_LABELLED`` (those with the
smallest XXH64 of their doc_id), a documented bound; scoring covers every text.

Defined results
* null or empty text, or one without words: the score of no evidence at all;
* a document labelled more than once is toxic if any label says so; labels
  other than 0 and 1 are ignored; with no labels of either class every score
  is 0;
* whole texts are scored, in pieces of bounded memory a token;
* repeated rows give repeated rows, and one text of each doc_id (that with the
  smallest XXH64) takes part in the fit; an empty table gives an empty table;
  other columns are not read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import RecentCache, held, ids_and_text, one_text_each, raw_bytes, release, row_ranges

MAX_LABELLED = 20_000
DIM = 1 << 20
PREFIXES = (3, 4, 5, 6)
#: Weight of the prior in tokens, for prefixes and whole words.
PRIOR = 20.0
#: Standard errors by which a token's log-odds are drawn towards 0, and what
#: every token costs, so that words that say nothing don't add up.
DOUBT, DRIFT = 1.0, 0.3
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
BINS = np.linspace(-10, 10, 801)
THRESHOLD = 0.7
EULER = 0.5772156649015329


def contexts(word: str) -> list[int]:
    """Buckets of a word's prefixes, shortest first, and of the word."""
    w = word.lower()
    w = EDGE.sub("", w) or w
    keys = [w[:n] for n in PREFIXES if n < len(w)]
    return [xxhash.xxh32_intdigest(f"{i}\0{k}".encode()) % DIM for i, k in enumerate(keys)] + [
        xxhash.xxh32_intdigest(f"w\0{w}".encode()) % DIM]


@dataclass
class Counts:
    """Token counts of the clean and the toxic class by bucket."""

    clean: np.ndarray
    toxic: np.ndarray
    n_clean: float
    n_toxic: float
    fit: str = field(default_factory=lambda: uuid.uuid4().hex)
    part: int = 0   # of the counts of one fit

    def score(self, word: str) -> float:
        """Log-odds drawn in by ``DOUBT`` standard errors, less the drift."""
        base = (self.n_toxic + 1) / (self.n_toxic + self.n_clean + 2)
        q, error = base, 0.0
        for b in contexts(word):
            t, c = float(self.toxic[b]), float(self.clean[b])
            if t + c:  # what was never seen tells nothing beyond its beginning
                t, c = t + PRIOR * q, c + PRIOR * (1 - q)
                q, error = t / (t + c), math.sqrt(1 / t + 1 / c)
        s = math.log(q / (1 - q)) - math.log(base / (1 - base))
        return math.copysign(max(0.0, abs(s) - DOUBT * error), s) - DRIFT


@dataclass
class Model:
    counts: Counts
    lam: float
    log_k: float
    slope: float
    shift: float

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        best = -self.log_k - math.log(max(1, n))
        z = [self.lam * s + best for _, _, s in found]
        return sum(x for x in z if x > 0) or max(z, default=best)

    def score(self, n: int, found: list[tuple[int, int, float]]) -> float:
        if self.slope == 0:
            return 0.0
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.evidence(n, found) + self.shift))))


def token_scores(texts: pa.Array, counts: Counts) -> Iterator[np.ndarray]:
    """The token scores of each text. Words are cut and their distinct ones
    found in Arrow, a few megabytes of text at a time; spellings that score
    alike (letter case, stops at the ends) are one."""
    seen = held(("toxicity", counts.fit), dict).setdefault(counts.part, RecentCache(120_000))
    for a, b in row_ranges(texts):
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(a, b - a).cast(pa.string()), "")))
        words = cut.flatten()
        trimmed = pc.ascii_trim(words, ".,;:!?")
        found = pc.if_else(pc.equal(trimmed, ""), words, trimmed).dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(seen.__getitem__, distinct))
        for i, x in enumerate(got):
            if x is None:
                got[i] = seen[distinct[i]] = counts.score(distinct[i]) if distinct[i] else math.nan
        seen.trim()
        s = np.array(got, np.float64)[found.indices.to_numpy()] if len(found) else np.zeros(0)
        real = ~np.isnan(s)  # white space at a text's ends leaves empty words
        at = np.concatenate([[0], np.cumsum(real)])[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        s = s[real]
        for x, y in zip(at[:-1].tolist(), at[1:].tolist()):
            yield s[x:y]
    release()


def best_segment(s: np.ndarray) -> float:
    """Score of the best segment; 0 if no token scores above 0."""
    if not len(s):
        return 0.0
    total = np.concatenate(([0.0], np.cumsum(s)))
    return float(np.max(total - np.minimum.accumulate(total)))


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score), in linear time.

    Runs of one sign are one step. A candidate keeps the totals before and
    after it, and where the search for an earlier, lower start went on."""
    if not len(s):
        return []
    up = s > 0
    starts = np.concatenate(([0], np.flatnonzero(up[1:] != up[:-1]) + 1))
    ends = np.concatenate((starts[1:], [len(s)]))
    sums = np.add.reduceat(s, starts)
    total = 0.0
    found: list[list] = []  # begin, end, total before, total after, earlier candidate with a lower start
    for begin, end, x in zip(starts.tolist(), ends.tolist(), sums.tolist()):
        before, total = total, total + x
        if x <= 0:
            continue
        new = [begin, end, before, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(b, e, after - low) for b, e, low, after, _ in found]


def labelled_texts(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
                   limit: int) -> DataFrame:
    """At most ``limit`` labelled documents: (text, toxic, half), written once."""
    known = (labels.select(labels[doc_id].cast("long").alias("doc_id"), labels[label].cast("int").alias("toxic"))
             .where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # ``known`` has at most ``limit`` rows of 12 bytes, and one text each stays
    out = one_text_each(ids_and_text(docs, doc_id, text).join(F.broadcast(known), "doc_id"), "toxic").select(
        "text", "toxic", F.pmod(F.xxhash64(F.xxhash64("doc_id")), F.lit(2)).cast("int").alias("half"))
    return cut_lineage(out, "toxicity-labelled")


def count_tokens(texts: DataFrame) -> list[list[Counts]]:
    """Counts by half; a word counts once a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((4, DIM), np.int64)
        tokens = np.zeros(4, np.int64)
        seen = RecentCache(100_000)
        for batch in batches:
            for t, toxic, half in zip(raw_bytes(batch["text"]), batch["toxic"].to_pylist(), batch["half"].to_pylist()):
                words = set(t.as_py().split())
                tokens[2 * half + toxic] += len(words)
                at: list[int] = []
                for w in words:
                    found = seen[w]
                    if found is None:
                        found = seen[w] = contexts(w.decode())
                    at += found
                np.add.at(n[2 * half + toxic], at, 1)
                seen.trim()
        used = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {"bucket": np.append(used, DIM)} | {f"c{i}": np.append(n[i, used], tokens[i]) for i in range(4)})

    got = (texts.mapInArrow(run, "bucket long, c0 long, c1 long, c2 long, c3 long")
           .groupBy("bucket").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(4)]).toArrow())
    dense = np.zeros((4, DIM + 1), np.float32)
    at = got["bucket"].to_numpy()
    for i in range(4):
        dense[i, at] = got[f"c{i}"].to_numpy()
    del got, at
    release()
    key = uuid.uuid4().hex
    return [Counts(dense[2 * h, :DIM], dense[2 * h + 1, :DIM], float(dense[2 * h, DIM]), float(dense[2 * h + 1, DIM]), key, h)
            for h in (0, 1)]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        limit: int = MAX_LABELLED) -> Model:
    """The model; brings back bucket counts and one row of figures for each
    labelled text, both bounded."""
    texts = labelled_texts(docs, labels, doc_id, text, label, limit)
    halves = count_tokens(texts)
    whole = Counts(halves[0].clean + halves[1].clean, halves[0].toxic + halves[1].toxic,
                   halves[0].n_clean + halves[1].n_clean, halves[0].n_toxic + halves[1].n_toxic)
    if not whole.n_clean or not whole.n_toxic:
        return Model(whole, 1.0, 0.0, 0.0, 0.0)

    def nulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros(len(BINS) - 1)
        best: list[tuple[int, float]] = []
        for batch in batches:
            clean = batch.filter(pc.equal(batch["toxic"], 0))
            for half in (0, 1):
                part = clean.filter(pc.equal(clean["half"], half))
                for s in token_scores(part["text"], halves[1 - half]):
                    hist += np.histogram(np.clip(s, BINS[0], BINS[-1]), BINS)[0]
                    best.append((len(s), best_segment(s)))
        yield pa.RecordBatch.from_pydict({
            "n": pa.array([x for x, _ in best] + list(range(len(hist))), pa.int64()),
            "x": pa.array([y for _, y in best] + hist.tolist(), pa.float64()),
            "hist": pa.array([False] * len(best) + [True] * len(hist))})

    got = texts.mapInArrow(nulls, "n long, x double, hist boolean")
    hist = got.where("hist").groupBy("n").agg(F.sum("x").alias("x")).orderBy("n").toArrow()["x"].to_numpy()
    mid = (BINS[1:] + BINS[:-1]) / 2
    lam = _lambda(mid, hist / max(1.0, hist.sum()))
    fitted = got.where("NOT hist AND n > 0").agg(F.avg(F.lit(lam) * F.col("x") - F.log("n")).alias("m")).first()["m"]
    log_k = (fitted if fitted is not None else 0.0) - EULER
    draft = Model(whole, lam, log_k, 1.0, 0.0)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in (0, 1):
                part = batch.filter(pc.equal(batch["half"], half))
                out = [draft.evidence(len(s), segments(s)) for s in token_scores(part["text"], halves[1 - half])]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), part["toxic"].cast("int64")], ["z", "toxic"])

    rows = texts.mapInArrow(evidence, "z double, toxic long").toArrow()  # at most ``limit`` rows
    z, y = rows["z"].to_numpy(), rows["toxic"].to_numpy()
    order = np.lexsort((y, z))  # sums in one order whatever the partitions were
    slope, shift = _logistic(np.clip(z[order], -30, 30), y[order])
    return Model(whole, lam, log_k, slope, shift)


def _lambda(x: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum(p exp(lambda x)) = 1; 1, the value for exact
    log-odds, where the mean isn't negative or no score is positive."""
    if float(p @ x) >= 0 or not p[x > 0].any():
        return 1.0
    low, high = 1e-3, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if float(p @ np.exp(mid * x)) < 1 else (low, mid)
    return low


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps with a small ridge."""
    w = np.zeros(2)
    x = np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), g)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1e-9, float(w[1]))


def passages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, n_words, passages): every segment with E < 1 as (first
    word, word after the last, score, log_e), in text order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, score, found = [], [], []
            for s in token_scores(batch["text"], model.counts):
                got = segments(s)
                n.append(len(s))
                score.append(model.score(len(s), got))
                log_e = [(b, e, x, model.log_k + math.log(len(s)) - model.lam * x) for b, e, x in got]
                found.append([dict(zip(("first", "after", "score", "log_e"), x)) for x in log_e if x[3] < 0])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(
                    found, pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()),
                                               ("score", pa.float64()), ("log_e", pa.float64())])))],
                ["doc_id", "score", "n_words", "passages"])

    return ids_and_text(docs, doc_id, text).mapInArrow(
        run, "doc_id long, score double, n_words long, "
             "passages array<struct<first: long, after: long, score: double, log_e: double>>")


def score_column(text: Column, model: Model) -> Column:
    """The score of a string column."""
    def run(values: pa.Array) -> pa.Array:
        return pa.array([model.score(len(s), segments(s)) for s in token_scores(values, model.counts)], pa.float64())

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "double").asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels a fit must not see: crc32 of the doc_id as text leaves
    1 when divided by 3."""
    return F.crc32(doc_id.cast("string")) % 3 == 1
