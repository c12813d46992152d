"""Ranked lexical search by presence masks.

Each item (query) gets its k highest-scoring documents over the whole table. A
document's mask has a bit for each of the item's terms that it holds. Documents
of one mask share the bound of their scores: the sum, over the mask's terms, of
weight times the largest contribution of the term. Masks are evaluated by
descending bound, until the next bound is below the k-th score found so far;
what is left can't enter the result, so the result is exact.

1. **Index.** One pass over the documents cuts them into shards of some
   megabytes. A shard's row holds its documents' ids and lengths, and for each
   term the documents that hold it, in order, with its counts. Words that no
   item holds are left out there by a Bloom filter of bounded size.
2. **Statistics.** N and L are sums over the shards, df of each item term a sum
   with one row a (shard, term).
3. **Search.** Items are packed into blocks of about ``BLOCK``; each block meets
   each shard in one cell of a grid, through an equi-join, so a task holds one
   shard and one block and neither side is broadcast. A task keeps the k best of
   an item from shard to shard, so later shards start from a higher k-th score.

Score: the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, with
w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L.

Defined results
* terms are taken with A-Z lower-cased; null, empty and termless texts have none
  and don't count in N;
* a row a document, also of documents that repeat; equal scores by ascending
  doc_id, null ids last; only scores above 0;
* an item that repeats is answered once; items of one id but other texts are
  answered each by itself; an item without terms, or whose terms no document
  holds, has no rows;
* empty tables give an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import raw_bytes, release, row_ranges, whole_text
from .decontaminate import Filter, Words, item_filter, word_hashes, words_of

K = 10
BLOCK = 256
#: Masks evaluated at a time.
BATCH = 64
#: Documents of a shard, beside its bytes; their numbers fit 16 bits.
SHARD_ROWS = 1 << 16
SHARD = ("n_docs int, with_terms long, n_terms long, ids binary, known binary, sizes binary, terms array<binary>, "
         "ends binary, docs binary, counts binary")
FOUND = "item long, doc_id long, score long"


def _picked(w: Words, keep: np.ndarray) -> pa.Array:
    """The words at ``keep`` as an Arrow array."""
    start, size = w.start[keep], (w.end - w.start)[keep]
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                                 pa.py_buffer(w.data[at].tobytes())])


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, term, h): the distinct terms of each item and their
    hashes; ``item`` numbers the distinct items."""
    distinct = cut_lineage(items.select(items[item_id].alias("item_id"), whole_text(items, text).alias("text")).distinct()
                           .withColumn("item", F.monotonically_increasing_id()), "search-items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_ranges(batch["text"]):
                w = words_of(raw_bytes(batch["text"].slice(a, b - a)))
                words = _picked(w, np.arange(len(w.start))).cast(pa.binary())
                of = np.repeat(np.arange(b - a), np.diff(w.first))
                yield pa.RecordBatch.from_arrays([batch["item"].slice(a, b - a).take(pa.array(of)), words,
                                                  pa.array(word_hashes(w).astype(np.int64))], ["item", "term", "h"])

    terms = distinct.select("item", "text").mapInArrow(run, "item long, term binary, h long").distinct()
    return cut_lineage(terms.join(distinct.select("item", "item_id"), "item"), "search-terms")


def shards(docs: DataFrame, keep: Filter, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs`` over the words that ``keep`` lets pass."""
    names = [f.split()[0] for f in SHARD.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in ((x, min(x + SHARD_ROWS, b)) for a, b in row_ranges(batch["text"]) for x in range(a, b, SHARD_ROWS)):
                w = words_of(raw_bytes(batch["text"].slice(a, b - a)))
                sizes = np.diff(w.first)
                at = np.flatnonzero(keep(word_hashes(w)))
                words = _picked(w, at).dictionary_encode()
                doc = np.repeat(np.arange(b - a), sizes)[at]
                pair, counts = np.unique(words.indices.to_numpy().astype(np.int64) * SHARD_ROWS + doc, return_counts=True)
                ends = np.searchsorted(pair, np.arange(1, len(words.dictionary) + 1) * SHARD_ROWS)
                ids = batch["doc_id"].slice(a, b - a)
                row = (b - a, int((sizes > 0).sum()), int(sizes.sum()), pc.fill_null(ids, 0).to_numpy().astype("<i8").tobytes(),
                       ids.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes(), sizes.astype("<i8").tobytes(),
                       words.dictionary.to_pylist(), ends.astype("<i8").tobytes(),
                       (pair % SHARD_ROWS).astype("<u2").tobytes(), counts.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], kinds[f.split()[1]]) for v, f in zip(row, SHARD.split(", "))], names)
            release()

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), whole_text(docs, text).alias("text")).mapInArrow(run, SHARD)


def document_frequencies(index: DataFrame) -> DataFrame:
    """(term, df)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ends = np.frombuffer(batch["ends"][i].as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([batch["terms"][i].values, pa.array(np.diff(ends, prepend=0))], ["term", "df"])

    return (index.select("terms", "ends").mapInArrow(run, "term binary, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


# -- search within a shard -------------------------------------------------------

class Shard:
    """A shard's postings with the contribution of each."""

    def __init__(self, r: dict, total_docs: int, total_terms: int):
        self.n = r["n_docs"]
        self.ids, self.known = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["known"], "u1")
        self.ends = np.frombuffer(r["ends"], "<i8")
        self.docs = np.frombuffer(r["docs"], "<u2").astype(np.int64)
        tf = np.frombuffer(r["counts"], "<u4").astype(np.int64)
        m = 10 + (90 * np.frombuffer(r["sizes"], "<i8") * total_docs) // total_terms
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs])
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.most = np.maximum.reduceat(self.gain, self.starts) if len(tf) else tf
        self.terms = pa.array(r["terms"], pa.binary())

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits of each distinct mask: mask x term, the mask of each document
        that has one, by number; documents without any have -1)."""
        bits = np.zeros((-(-len(terms) // 64), self.n), np.uint64)
        for j, t in enumerate(terms.tolist()):
            bits[j >> 6, self.docs[self.starts[t]:self.ends[t]]] |= np.uint64(1 << (j & 63))
        group, found = np.zeros(self.n, np.int64), np.zeros((1, 0), np.uint64)
        for word in bits:                       # refined word by word
            values, code = np.unique(word, return_inverse=True)
            both, group = np.unique(group * len(values) + code, return_inverse=True)
            found = np.concatenate([found[both // len(values)], values[both % len(values), None]], axis=1)
        flat = np.unpackbits(found.astype("<u8").view("u1").reshape(len(found), -1), axis=1, bitorder="little")
        return flat[:, :len(terms)].astype(bool), group

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, so_far: list[tuple]) -> list[tuple]:
        """``so_far``, (-score, no id, id) in order, merged with the documents
        that belong among its first k; masks by descending bound."""
        has, group = self.masks(terms)
        bound = has @ (weights * self.most[terms])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        place = np.argsort(group, kind="stable")          # documents by mask
        edge = np.searchsorted(group[place], np.arange(len(bound) + 1))
        for a in range(0, len(order), BATCH):
            if len(so_far) == k and bound[order[a]] < -so_far[-1][0]:
                break
            take = order[a:a + BATCH]
            docs = np.sort(np.concatenate([place[edge[g]:edge[g + 1]] for g in take.tolist()]))
            score = np.zeros(len(docs), np.int64)
            for j in np.flatnonzero(has[take].any(axis=0)).tolist():
                lo, hi = self.starts[terms[j]], self.ends[terms[j]]
                at = np.minimum(np.searchsorted(self.docs[lo:hi], docs), hi - lo - 1) + lo
                score += np.where(self.docs[at] == docs, weights[j] * self.gain[at], 0)
            new = zip((-score).tolist(), (1 - self.known[docs].astype(int)).tolist(), self.ids[docs].tolist())
            so_far = sorted([*so_far, *(x for x in new if x[0] < 0)])[:k]
        return so_far


class Block:
    """Items with their terms as numbers."""

    def __init__(self, items: list[dict]):
        every = pa.array([t for i in items for t in i["terms"]], pa.binary()).dictionary_encode()
        self.terms, codes = every.dictionary, every.indices.to_numpy()
        self.items, at = [], 0
        for i in items:
            n = len(i["terms"])
            self.items.append((i["item"], codes[at:at + n], np.array(i["weights"], np.int64)))
            at += n


def _search(total_docs: int, total_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        blocks: dict[int, Block] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch[c][i].as_py() for c in batch.schema.names if c != "items"}
                if r["block"] not in blocks:
                    blocks = {r["block"]: Block(batch["items"][i].as_py())}   # one at a time
                block, shard = blocks[r["block"]], Shard(r, total_docs, total_terms)
                if not len(shard.terms):
                    continue
                place = pc.fill_null(pc.index_in(block.terms, shard.terms), -1).to_numpy(zero_copy_only=False)
                for item, codes, weights in block.items:
                    at = place[codes]
                    here = at >= 0
                    if here.any():
                        best[item] = shard.best(at[here].astype(np.int64), weights[here], k, best.get(item, []))
        rows = [(item, None if nameless else d, -s) for item, found in best.items() for s, nameless, d in found]
        cols = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item", "doc_id", "score"])

    return run


def top_k(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each
    item."""
    spark = docs.sparkSession
    terms = item_terms(items, item_id, item_text)
    index = cut_lineage(shards(docs, item_filter(terms), doc_id, text).withColumn("shard", F.monotonically_increasing_id()),
                        "search-index")
    got = index.agg(F.sum("with_terms"), F.sum("n_terms")).first()
    total_docs, total_terms = got[0] or 0, got[1] or 0
    weight = F.floor(1000 * F.log(F.lit(2.0 * total_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = (terms.join(document_frequencies(index), "term").withColumn("w", weight)
                .groupBy("item").agg(F.collect_list(F.struct("term", "w")).alias("t"))      # an item's own terms
                .select("item", F.col("t.term").alias("terms"), F.col("t.w").alias("weights")))
    weighted = cut_lineage(weighted, "search-weights")
    n_blocks = max(1, -(-weighted.count() // BLOCK))
    blocks = (weighted.groupBy(F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("block"))
              .agg(F.collect_list(F.struct("item", "terms", "weights")).alias("items")))   # about BLOCK items
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = blocks.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    dealt = (index.withColumn("cell", F.pmod(F.xxhash64("shard"), F.lit(cells)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).drop("shard", "with_terms", "n_terms"))
    found = dealt.join(grid, ["cell", "block"]).drop("cell").mapInArrow(_search(total_docs, max(1, total_terms), k), FOUND)
    rank = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    names = terms.select("item", "item_id").distinct()
    return (found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).join(names, "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
