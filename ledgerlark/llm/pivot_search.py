"""Exact top-k by inner product with pivot-table elimination.

Every vector's distances to a set of pivots are computed once. For a query q
and a vector x, max over pivots of |d(q,p) - d(x,p)| is a lower bound of their
distance, and with the exact norms an upper bound of the inner product:
(|q|^2 + |x|^2 - bound^2) / 2. Candidates are evaluated in the order of that
bound until it falls below the k-th best score found so far; what is left can't
enter the result, so the result is exact.

Vectors and queries are packed into blocks of bounded size whose members are
neighbours of one pivot. A block's smallest and largest distance to each pivot
bound all its members at once: whole blocks are taken in the order of this
bound or left out, and only what is left of a block is bounded pair by pair. The
k-th best score within a query's own block is where all its searches start from.

Query blocks meet candidate blocks in a grid of cells, whose sides follow the
sizes of both tables: a cell holds at most ``CELL`` queries and ``CELL`` vectors
or so, keeps one running k-th score a query, and gives one row a query. No side
is broadcast whole; only the pivots (``PIVOTS`` vectors of a bounded sample) are
sent to all tasks.

Products are sums of whole numbers. They are taken in doubles where the norms
show that no sum can leave the 53 bits these hold exactly, else in 64-bit
integers, else in unbounded ones.

Defined results
* vectors that are null, empty, or hold null or non-finite components take no
  part, nor do rows without an id; a component or a result beyond the long
  range is an error, never a missing row;
* vectors of another length than the query's take no part in its result;
* ties go to the smaller id; a row with the query's own id is never its
  result; other rows that repeat are results of their own; a query row that
  repeats gives its result once;
* fewer candidates than k: all of them; an empty table an empty table; other
  columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import ship

K = 5
PIVOTS = 64
SAMPLE = 2_000
BLOCK = 256
#: Vectors and queries of a cell, about.
CELL = 8_192
SCALE = 256
#: Pivots that are compared pair by pair before what they rule out is left.
STEP = 16
EXACT = float(1 << 52)       # sums of doubles below are exact, with room to spare
LONG = float(1 << 62)


def quantized(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, x as double."""
    raw = vectors[vector].cast("array<double>")
    beyond = F.raise_error(F.lit("a vector component is beyond the long range")).cast("double")
    v = F.transform(raw, lambda x: F.floor(F.when(F.abs(x) * scale < LONG, x * F.lit(float(scale))).otherwise(beyond)))
    fine = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = F.when(raw.isNotNull() & (F.size(raw) > 0) & fine & vectors[vec_id].isNotNull(), v.cast("array<long>"))
    return vectors.select(vectors[vec_id].cast("long").alias("vec_id"), own.alias("v")).where("v IS NOT NULL")


def _matrix(values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    flat, at = values.values.to_numpy(zero_copy_only=False), values.offsets.to_numpy()
    size = np.diff(at)
    if len(size) and (size == size[0]).all():
        return [(np.arange(len(size)), flat[at[0]:at[-1]].reshape(len(size), -1).astype(np.int64))]
    return [(rows, np.stack([flat[at[r]:at[r + 1]] for r in rows]).astype(np.int64))
            for n in np.unique(size) if len(rows := np.flatnonzero(size == n))]


def choose_pivots(vectors: DataFrame, n: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """For each length in a bounded sample, up to n pivots far from each
    other: each is the sampled vector farthest from those before it."""
    got = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).toArrow()
    pivots = {}
    for _, x in _matrix(got["v"].combine_chunks()) if len(got) else []:
        x = x.astype(np.float64)
        chosen = [0]
        far = ((x - x[0]) ** 2).sum(axis=1)
        while len(chosen) < min(n, len(x)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        pivots[x.shape[1]] = x[chosen]
    return pivots


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.sqrt(np.maximum(0, (x ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None, :] - 2 * x @ p.T))


def _squares(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(1)


def _upper(norms: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products from sums of squared norms and lower
    bounds of distances; a hair is added, so rounding never makes one too low."""
    return (norms - gap * gap) / 2 + 1e-9 * norms + 1e-6


def _bounds(q: np.ndarray, qd: np.ndarray, x: np.ndarray, xd: np.ndarray) -> np.ndarray:
    """Upper bounds of all inner products of two blocks."""
    gap = np.zeros((len(q), len(x)))
    for p in range(qd.shape[1]):
        np.maximum(gap, np.abs(qd[:, p, None] - xd[None, :, p]), out=gap)
    return _upper(_squares(q)[:, None] + _squares(x)[None, :], gap)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, exactly; whole numbers."""
    most = np.sqrt(_squares(q).max() * _squares(x).max())    # no sum of products is larger
    if most < EXACT:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if most < LONG:
        return q @ x.T
    return q.astype(object) @ x.T.astype(object)


class Best:
    """The best k (score, id) of each of some queries."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)   # a k-th best score known from elsewhere, or minus infinity
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.n = n

    def add(self, row: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        row, score, ident = (np.concatenate([a, b]) for a, b in ((self.row, row), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, -score, row))
        row, score, ident = row[order], score[order], ident[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        self.row, self.score, self.id = row[keep], score[keep], ident[keep]
        full = place[keep] == self.k - 1
        at = self.row[full]
        self.floor[at] = np.maximum(self.floor[at], self.score[full].astype(np.float64) * (1 - 1e-15 * np.sign(
            self.score[full].astype(np.float64))))          # rounded down, where doubles don't hold it


def evaluate(best: Best, q: np.ndarray, qid: np.ndarray, qd: np.ndarray, x: np.ndarray, ids: np.ndarray, xd: np.ndarray,
             rows: np.ndarray) -> None:
    """Adds what a block has for the queries ``rows``: pairs whose bound is below
    the k-th best score are not looked at, nor queries and vectors that have no
    other."""
    q, cols = q[rows], np.arange(len(x))
    norms, gap = _squares(q)[:, None] + _squares(x)[None, :], np.zeros((len(q), len(x)))
    floor = best.floor[rows, None]
    for p in range(0, qd.shape[1], STEP):
        for j in range(p, min(p + STEP, qd.shape[1])):
            np.maximum(gap, np.abs(qd[rows, j, None] - xd[None, cols, j]), out=gap)
        alive = _upper(norms, gap) >= floor
        r, c = alive.any(axis=1), alive.any(axis=0)
        if not c.any():
            return
        if r.mean() * c.mean() < 0.7:
            rows, q, cols, floor = rows[r], q[r], cols[c], floor[r]
            norms, gap, alive = norms[np.ix_(r, c)], gap[np.ix_(r, c)], alive[np.ix_(r, c)]
    alive &= qid[rows, None] != ids[None, cols]
    score = products(q, x[cols])
    if score.dtype != object and score.shape[1] > best.k:
        low = np.where(alive, score, np.iinfo(np.int64).min)
        alive &= low >= np.partition(low, low.shape[1] - best.k, axis=1)[:, -best.k, None]
    r, c = np.nonzero(alive)
    best.add(rows[r], score[r, c], ids[cols[c]])


def _block(r: dict, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = r[f"{side}n"]
    return (np.frombuffer(r[f"{side}ids"], "<i8"), np.frombuffer(r[f"{side}v"], "<i8").reshape(n, -1),
            np.frombuffer(r[f"{side}d"], "<f8").reshape(n, -1))


BLOCK_SCHEMA = "dims int, first long, n int, ids binary, v binary, d binary, more binary"
QUERY_SCHEMA = "vec_id long, v array<long>, floor double"
FOUND_SCHEMA = "query_id long, query_key long, ids array<long>, scores array<long>"
_ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(),
          "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(cols, fields)],
                                      [name for name, _ in fields])


def pack(vectors: DataFrame, pivots: dict[int, np.ndarray], more: str, kind: str, block: int = BLOCK) -> DataFrame:
    """Blocks of at most ``block`` vectors of one length with their pivot
    distances and one more column (of numpy type ``kind``); vectors nearest to
    the same pivot stand together as far as a task has them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, extra = batch["vec_id"].to_numpy(), batch[more].to_numpy(zero_copy_only=False)
            out = []
            for rows, x in _matrix(batch["v"]):
                p = pivots.get(x.shape[1])
                d = _distances(x, p if p is not None else np.zeros((1, x.shape[1])))
                order = np.lexsort((ids[rows], d.argmin(axis=1)))
                for at in range(0, len(order), block):
                    o = order[at:at + block]
                    out.append((x.shape[1], int(ids[rows[o[0]]]), len(o), ids[rows[o]].astype("<i8").tobytes(),
                                x[o].astype("<i8").tobytes(), d[o].astype("<f8").tobytes(),
                                extra[rows[o]].astype(kind).tobytes()))
            yield _batch(out, BLOCK_SCHEMA)

    return vectors.mapInArrow(run, BLOCK_SCHEMA)


def _asked(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The queries, each with the k-th best score within its own block."""
    for batch in batches:
        for r in batch.to_pylist():
            pick = np.flatnonzero(np.frombuffer(r["more"], "u1"))
            if len(pick):
                ids, x, d = _block(r)
                best = Best(len(pick), k, np.full(len(pick), -np.inf))
                evaluate(best, x[pick], ids[pick], d[pick], x, ids, d, np.arange(len(pick)))
                yield _batch([(int(ids[i]), x[i].tolist(), f) for i, f in zip(pick, best.floor.tolist())], QUERY_SCHEMA)


def _cell(k: int):
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        """What the vectors of a cell have for its queries."""
        blocks = [_block(r) for b in held.to_batches(max_chunksize=1) for r in b.to_pylist()]
        out = []
        for r in (r for b in asked.to_batches(max_chunksize=1) for r in b.to_pylist()):
            if not blocks:
                break
            low, high = (np.stack([f(d, axis=0) for _, _, d in blocks]) for f in (np.min, np.max))
            most = np.array([_squares(x).max() for _, x, _ in blocks])
            qids, q, qd = _block(r)
            best = Best(len(q), k, np.frombuffer(r["more"], "<f8").copy())
            gap = np.zeros((len(q), len(blocks)))
            for p in range(qd.shape[1]):        # from each query to the nearest that a block can have
                np.maximum(gap, np.maximum(qd[:, p, None] - high[None, :, p], low[None, :, p] - qd[:, p, None]), out=gap)
            bound = _upper(_squares(q)[:, None] + most[None, :], gap)
            for b in np.argsort(-bound.max(axis=0), kind="stable").tolist():
                rows = np.flatnonzero(bound[:, b] >= best.floor)
                if len(rows):
                    ids, x, d = blocks[b]
                    evaluate(best, q, qids, qd, x, ids, d, rows)
            edge = np.searchsorted(best.row, np.arange(len(q) + 1))
            for j in range(len(q)):
                a, b = edge[j], edge[j + 1]
                if b > a:
                    scores = [int(s) for s in best.score[a:b]]
                    if max(map(abs, scores)) >= 1 << 63:
                        raise OverflowError("an inner product is beyond the long range")
                    out.append((int(qids[j]), xxhash.xxh64_intdigest(q[j].tobytes()) >> 1, best.id[a:b].tolist(), scores))
        return pa.Table.from_batches([_batch(out, FOUND_SCHEMA)])

    return run


def top_k(vectors: DataFrame, asked: Column, k: int = K, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each
    row of ``vectors`` (vec_id, v) for which ``asked`` holds, over all rows."""
    ship(vectors.sparkSession)
    rows = cut_lineage(vectors.select("vec_id", "v", F.coalesce(asked, F.lit(False)).alias("ask")), "pivot-vectors")
    table = choose_pivots(rows.select("vec_id", "v"), pivots)
    blocks = cut_lineage(pack(rows, table, "ask", "u1", block), "pivot-blocks")
    queries = (blocks.mapInArrow(lambda b: _asked(b, k), QUERY_SCHEMA)
               .groupBy("vec_id", "v").agg(F.max("floor").alias("floor")))
    q = cut_lineage(pack(queries, table, "floor", "<f8", block), "pivot-queries")
    # the grid: a query block meets every candidate block of its length, each pair in one cell
    n_q, n_x = (df.agg(F.sum("n")).first()[0] or 0 for df in (q, blocks))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, -(-n_q // CELL))
    down = max(1, -(-n_x // CELL), min(tasks // across, n_x // (8 * block)))   # smaller cells while tasks are free
    own = lambda n: F.pmod(F.xxhash64("first", "ids"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("across", own(across)).withColumn("down", every(down))
    x = blocks.withColumn("down", own(down)).withColumn("across", every(across))
    cell = ["across", "down", "dims"]
    found = q.groupBy(*cell).cogroup(x.groupBy(*cell)).applyInArrow(_cell(k), FOUND_SCHEMA)
    each = found.select("query_id", "query_key", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    rank = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return (each.toDF("query_id", "query_key", "vec_id", "score").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
