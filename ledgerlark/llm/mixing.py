"""Mixing sources to target weights by soft membership.

A classifier fitted on a labelled table predicts each document's domain
posteriors p. Nonnegative document rates r are then fitted by projected-gradient
least squares, so that the expected domain token totals sum(r n p) match the
targets (weights times a token budget).

* Posteriors are kept in steps of 1/``GRAIN``. The gradient step, taken in the
  token-weighted metric, is the same for documents with the same posteriors, so
  the work is first aggregated to one row a distinct posterior vector; each
  iteration is one small aggregate over that table, on the executors.
* A rate is a function of a document's posteriors and the residuals so far: the
  iterations carry only these residuals (a few numbers each), no rates, and any
  lost task recomputes its rates from them.
* Residuals of each domain are scaled by its own spread; the step is one over
  the largest eigenvalue of the scaled domain Gram matrix.

* Tokens and posteriors of a text are sums over its pieces (``pieces``), each
  distinct piece counted and scored once.

The classifier (softmax over hashed byte n-grams within pieces) is fitted on at most
``MAX_LABELLED`` labelled documents (smallest XXH64 of the doc_id), a documented
bound; their features stay on the executors, which send the gradient of each
step. Everything else covers all documents.

Defined results
* null or empty text: no tokens and even posteriors; it takes no part in the
  totals and gets the rate of its posteriors;
* targets that no allowed rates meet (say, of 0 for a domain that shares
  documents with others) are approached until the largest miss no longer
  shrinks, and the fit says so (``met``); others are met to ``CLOSE``;
* a target domain that no document belongs to can't be met and is left out; with
  no tokens at all every rate is 1;
* labels that are null are no domain; with one domain only, it is certain;
* repeated rows each get their rate, and one text of each doc_id (that with the
  smallest XXH64) takes part in the classifier's fit; an empty table gives an
  empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import pieces
from .common import ids_and_text, one_text_each, release, whole_text

#: Its tokens are counted.
TOKENIZER = "byte_bpe_50k.json"
MAX_LABELLED = 4_000
DOMAIN_DIM = 1 << 16
#: Sampled texts whose features are held at a time.
PIECE = 250
GRAIN = 1_000
STEPS = 60
RIDGE = 1e-4
CLOSE = 1e-4
#: The fit ends unmet when so many rounds make the largest miss no smaller by a
#: hundredth.
PATIENCE = 60
MARGIN = 0.02


# -- domain classifier --------------------------------------------------------

@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray   # bucket x domain
    bias: np.ndarray

    def key(self) -> str:
        return sha256(self.weights.tobytes() + self.bias.tobytes()).hexdigest()

    def posteriors(self, scores: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Of mean scores, in whole steps of 1/GRAIN that sum to GRAIN; even
        where not ``known``."""
        z = scores + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[~known] = 1 / len(self.domains)
        q = np.floor(p * GRAIN).astype(np.int64)
        rest = np.argsort(np.argsort(q - p * GRAIN, axis=1, kind="stable"), axis=1)   # the largest remainders first
        return q + (rest < GRAIN - q.sum(axis=1, keepdims=True))


def fit_domains(docs: DataFrame, labelled: DataFrame, domain: str, doc_id: str = "doc_id", text: str = "text",
                limit: int = MAX_LABELLED) -> DomainModel:
    """``labelled``: (doc_id, ``domain``). A document with several labels counts
    by its smallest."""
    known = (labelled.select(labelled[doc_id].cast("long").alias("doc_id"), labelled[domain].cast("string").alias("domain"))
             .where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.min("domain").alias("domain"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                rows = pieces.frequencies(part["text"], [], DOMAIN_DIM)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["domain"], pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                     pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["doc_id", "domain", "at", "f"])

    # ``known`` has at most ``limit`` rows, and one text each stays
    rated = one_text_each(ids_and_text(docs, doc_id, text).where("text <> ''").join(F.broadcast(known), "doc_id"), "domain")
    feats = cut_lineage(rated.select("doc_id", "domain", "text").sortWithinPartitions("doc_id").mapInArrow(
        run, "doc_id long, domain string, at array<int>, f array<float>"), "mixing-features")
    return fit_softmax(feats)


def _summed(feats: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` (``size`` numbers) over all batches: each task sends
    one row of its own sum, and no features leave the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                total += part(batch.slice(at, PIECE))
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["total"])

    out = np.zeros(size)
    for total in feats.mapInArrow(run, "total binary").toArrow()["total"]:   # SAMPLE_TASKS rows at most
        out += np.frombuffer(total.as_py(), np.float32)
    return out


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and frequency of every feature of a batch."""
    at, f = batch["at"], batch["f"]
    return (np.repeat(np.arange(batch.num_rows), np.diff(at.offsets.to_numpy())),
            at.flatten().to_numpy(), f.flatten().to_numpy().astype(np.float64))


def fit_softmax(feats: DataFrame) -> DomainModel:
    """Multinomial logistic regression with a ridge, by Adam over the whole
    sample: (doc_id, domain, at, f) stay with the executors, which send the
    gradient (DOMAIN_DIM numbers a domain) of each step."""
    sizes = {r.domain: r["count"] for r in feats.groupBy("domain").count().collect()}
    names = sorted(sizes)
    if not names:
        return DomainModel(["all"], np.zeros((DOMAIN_DIM, 1), np.float32), np.zeros(1))
    k, n = len(names), sum(sizes.values())

    def squares(batch: pa.RecordBatch) -> np.ndarray:
        _, col, val = _sparse(batch)
        return np.bincount(col, val * val, DOMAIN_DIM)

    scale = 1 / np.sqrt(_summed(feats, DOMAIN_DIM, squares) / n + 1e-9)   # a feature counts by its spread

    def norms(batch: pa.RecordBatch) -> np.ndarray:
        row, col, val = _sparse(batch)
        return np.array([np.sqrt(np.bincount(row, (val * scale[col]) ** 2, batch.num_rows)).sum()])

    scale = scale / (_summed(feats, 1, norms)[0] / n)
    w = np.zeros((DOMAIN_DIM + 1, k))
    w[DOMAIN_DIM] = np.log([sizes[d] / n for d in names])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        g = _summed(feats, w.size, _gradient(names, w[:DOMAIN_DIM] * scale[:, None], w[DOMAIN_DIM].copy())).reshape(w.shape) / n
        g[:DOMAIN_DIM] = g[:DOMAIN_DIM] * scale[:, None] + RIDGE * w[:DOMAIN_DIM]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return DomainModel(names, (w[:DOMAIN_DIM] * scale[:, None]).astype(np.float32), w[DOMAIN_DIM])


def _gradient(names: list[str], weights: np.ndarray, bias: np.ndarray) -> Callable[[pa.RecordBatch], np.ndarray]:
    """Of the summed loss by unscaled weights and bias."""
    weights = weights.astype(np.float32)

    def part(batch: pa.RecordBatch) -> np.ndarray:
        row, col, val = _sparse(batch)
        z = np.stack([np.bincount(row, val * weights[col, j], batch.num_rows) for j in range(len(names))], axis=1) + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(p)), [names.index(x) for x in batch["domain"].to_pylist()]] -= 1
        return np.concatenate([np.stack([np.bincount(col, val * p[row, j], DOMAIN_DIM) for j in range(len(names))], axis=1),
                               p.sum(axis=0)[None]]).ravel()

    return part


def membership_column(text: Column, model: DomainModel, tokenizer: str = TOKENIZER) -> Column:
    """struct(n, q) of a string column without nulls: byte-level tokens and
    posteriors in steps of 1/GRAIN."""
    path, key, k = public_tokenizers.path(tokenizer), model.key(), len(model.domains)

    def run(values: pa.Array) -> pa.Array:
        sums = pieces.sums(path, key, model.weights)
        n, scores = pieces.each_range(values, sums.of)
        size = np.diff(values.offsets.to_numpy()) if hasattr(values, "offsets") else n
        q = model.posteriors(scores, size > 0)
        release()
        lists = pa.ListArray.from_arrays(np.arange(len(q) + 1, dtype=np.int32) * k, pa.array(q.ravel()))
        return pa.StructArray.from_arrays([pa.array(n), lists], ["n", "q"])

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "struct<n:long,q:array<long>>").asNondeterministic()(text)


def memberships(docs: DataFrame, model: DomainModel, doc_id: str = "doc_id", text: str = "text",
                tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, q0..): byte-level tokens and posteriors in steps of
    1/GRAIN."""
    rows = ids_and_text(docs, doc_id, text).select("doc_id", membership_column(F.col("text"), model, tokenizer).alias("m"))
    return rows.select("doc_id", F.col("m.n").alias("n_tokens"), *_posteriors("m", len(model.domains)))


def _posteriors(struct: str, k: int) -> list[Column]:
    return [F.col(f"{struct}.q")[j].alias(f"q{j}") for j in range(k)]


# -- rates --------------------------------------------------------------------

@dataclass
class Rates:
    """Rates as a function of posteriors: a start value and the steps so far,
    each taken from where the last two rates point (Nesterov's momentum), and
    never below ``least``."""

    start: float
    steps: list[np.ndarray]   # by iteration and domain
    least: float = 0.0

    def _fold(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = ahead = np.full(len(p), self.start)
        for k, s in enumerate(self.steps):
            last, r = r, np.maximum(self.least, ahead - p @ s)
            ahead = r + k / (k + 3) * (r - last)
        return r, ahead

    def of(self, p: np.ndarray) -> np.ndarray:
        return self._fold(p)[0]


def _kinds(member: DataFrame, k: int) -> DataFrame:
    """One row a distinct posterior vector: its tokens."""
    return member.groupBy(*[f"q{j}" for j in range(k)]).agg(F.sum("n_tokens").alias("n")).where("n > 0")


def _totals(kinds: DataFrame, k: int, rates: Rates) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the rates, and at the point the next
    step is taken from: one aggregate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((2, k))
        for batch in batches:
            p = np.stack([batch[f"q{j}"].to_numpy() for j in range(k)], axis=1) / GRAIN
            for i, r in enumerate(rates._fold(p)):
                out[i] += (r * batch["n"].to_numpy()) @ p
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in out.ravel()], [f"t{j}" for j in range(2 * k)])

    got = kinds.mapInArrow(run, ", ".join(f"t{j} double" for j in range(2 * k))).agg(
        *[F.sum(f"t{j}").alias(f"t{j}") for j in range(2 * k)]).first()
    both = np.array([x or 0.0 for x in got]).reshape(2, k)
    return both[0], both[1]


@dataclass
class Fit:
    """Fitted rates with the token targets of the domains and what the rates
    are expected to reach."""

    domains: list[str]
    rates: Rates
    target: np.ndarray
    reached: np.ndarray
    met: bool


def fit_rates(member: DataFrame, domains: list[str], weights: dict[str, float], budget: float | str = "corpus",
              least: float = 0.0, close: float = CLOSE, patience: int = PATIENCE) -> Fit:
    """``budget``: tokens in all; 'corpus' for as many as there are, 'no_loss'
    for the least with which no domain has to shrink, and a ``MARGIN`` more if
    rates have a floor: documents of several domains lift them all. ``least``:
    the smallest rate allowed."""
    k = len(domains)
    kinds = cut_lineage(_kinds(member, k), "mixing-kinds")
    p = [F.col(f"q{j}") / GRAIN for j in range(k)]
    got = kinds.agg(*[F.sum(F.col("n") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
                    *[F.sum(F.col("n") * p[j]).alias(f"n{j}") for j in range(k)]).first()
    own = np.array([got[f"n{j}"] or 0.0 for j in range(k)])
    gram = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    share = np.array([max(0.0, float(weights.get(d, 0.0))) for d in domains]) * (own > 0)
    if not own.sum() or not share.sum():
        return Fit(domains, Rates(1.0, []), np.zeros(k), own, not own.sum())
    share /= share.sum()
    if budget == "no_loss":
        budget = float(max(own[j] / share[j] for j in range(k) if share[j] > 0)) * (1 + MARGIN * (least > 0))
    total = own.sum() if budget == "corpus" else float(budget)
    target = share * total
    scale = np.where(own > 0, 1 / np.maximum(np.diag(gram), 1e-300), 0.0)   # squared weights
    half = np.sqrt(scale)
    step = 1 / float(np.linalg.eigvalsh(half[:, None] * gram * half[None, :]).max())
    rates = Rates(max(least, total / own.sum()), [], least)
    reached, ahead = _totals(kinds, k, rates)
    best, since = (np.inf, rates, reached), 0
    while True:
        miss = np.abs(reached - target).max()
        since = 0 if miss < 0.99 * best[0] else since + 1
        if miss < best[0]:
            best = miss, rates, reached
        if miss <= close * total or since >= patience:
            break
        rates = Rates(rates.start, [*rates.steps, step * scale * (ahead - target)], least)
        reached, ahead = _totals(kinds, k, rates)
    return Fit(domains, best[1], target, best[2], bool(best[0] <= close * total))


def with_rates(member: DataFrame, fit: Fit) -> DataFrame:
    """(doc_id, n_tokens, domain, posterior, rate, domain_target,
    domain_reached): the likeliest domain (ties: the first by name) with its
    posterior, the rate, and the tokens the domain should have and is expected to
    have at the rates, so that a target that isn't met is seen."""
    k = len(fit.domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = np.stack([batch[f"q{j}"].to_numpy() for j in range(k)], axis=1)
            top = q.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_tokens"], pa.array([fit.domains[j] for j in top], pa.string()),
                 pa.array(q[np.arange(len(q)), top] / GRAIN, pa.float64()), pa.array(fit.rates.of(q / GRAIN), pa.float64()),
                 pa.array(fit.target[top], pa.float64()), pa.array(fit.reached[top], pa.float64())],
                ["doc_id", "n_tokens", "domain", "posterior", "rate", "domain_target", "domain_reached"])

    return member.mapInArrow(run, "doc_id long, n_tokens long, domain string, posterior double, rate double, "
                                  "domain_target double, domain_reached double")


def mix(docs: DataFrame, labelled: DataFrame, domain: str, weights: dict[str, float], budget: float | str = "corpus",
        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``with_rates``, one per document."""
    model = fit_domains(docs, labelled, domain, doc_id, text)
    member = cut_lineage(memberships(docs, model, doc_id, text), "mixing-members")
    return with_rates(member, fit_rates(member, model.domains, weights, budget))


def tempered(member: DataFrame, domains: list[str], power: float) -> dict[str, float]:
    """Weights in proportion to the domains' own token totals to a power."""
    own = member.agg(*[F.sum(F.col("n_tokens") * F.col(f"q{j}")).alias(f"n{j}") for j in range(len(domains))]).first()
    return {d: float(x or 0) ** power if x else 0.0 for d, x in zip(domains, own)}


MEMBER, RATE = "__mixing_member", "__mixing_rate"


def with_members(docs: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """``docs``, stored, with tokens and posteriors in the column ``MEMBER``:
    each text is looked at once, and its rate needs no join."""
    return cut_lineage(docs.withColumn(MEMBER, membership_column(whole_text(docs, text), model)), "mixing-documents")


def members_of(docs: DataFrame, k: int) -> DataFrame:
    """(n_tokens, q0..) of the rows of ``with_members``."""
    return docs.select(F.col(f"{MEMBER}.n").alias("n_tokens"), *_posteriors(MEMBER, k))


def resample(docs: DataFrame, rates: Rates, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` (of ``with_members``), each as often as its rate
    says: the whole part of the rate, and once more where a hash of doc_id and
    text falls below the rest; so the totals expected are the fitted ones, and
    with rates of 1 or more no document is lost."""
    def run(q: pa.Array) -> pa.Array:
        p = np.asarray(q.flatten()).reshape(len(q), -1) / GRAIN
        return pa.array(rates.of(p), pa.float64())

    run.__annotations__ = {"q": pa.Array, "return": pa.Array}
    draw = F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), whole_text(docs, text)), F.lit(1 << 20)) / float(1 << 20)
    out = docs.withColumn(RATE, F.arrow_udf(run, "double").asNondeterministic()(F.col(f"{MEMBER}.q")))
    copies = (F.floor(RATE) + (draw < F.col(RATE) - F.floor(RATE)).cast("int")).cast("int")
    out = out.withColumn(RATE, F.explode(F.array_repeat(F.lit(1), copies)))
    return out.select(*[F.col(f"`{x}`") for x in docs.columns if x != MEMBER])
