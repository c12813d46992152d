"""Benchmark decontamination by winnowing.

``WINDOW`` consecutive words of a benchmark item that occur in a document are a
hit. Of the ``WINDOW - GRAM + 1`` word k-grams in a window the one with the
smallest hash (ties: the rightmost) is kept; which one depends on the window's
words alone, so a window that a document shares with an item keeps the same
k-gram on both sides and no shared window is missed. Documents and items are
joined on these fingerprints, and each hit is extended word by word to both
sides; it counts if the shared run is a window or longer.

A fingerprint carries its k-gram with ``WINDOW - GRAM`` words to either side:
each window that keeps it lies within. So a hit is verified and extended on
these words alone, and no text is read or moved again.

An item of fewer words than a window is one window of its own length n: its
fingerprint is the n-gram itself, and documents keep all their n-grams for the
lengths that occur.

* Words, hashes and window minima are worked out in Arrow and numpy, in one pass
  over the documents. What no item can match is dropped there by a Bloom filter of
  the items' hashes, of at most ``FILTER_BITS`` bits however many items there
  are; a full filter only lets more pass to the join.
* Equal contexts, of passages that many documents share, are one row before
  they meet the items; the matches go back to the documents by salted keys.

Defined results
* words are taken after lower-casing A-Z; null and empty texts and those without
  words have none, and an item without words has no window;
* a row per document, also of documents that repeat; each is judged by its own
  text; items of one id are one item with the windows of all its texts; items
  without an id hit, but are not listed;
* an empty table of items leaves all documents clean, an empty table of documents
  is an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import raw_bytes, row_ranges, whole_text

WINDOW = 10
GRAM = 5
FILTER_BITS = 1 << 26
PROBES = 2
#: Rows a salted key is dealt to.
SALT = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)          # of lower-cased bytes
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
MARK = "h long, n int, off int, ctx string, pos int"


# -- words and fingerprints ----------------------------------------------------

@dataclass
class Words:
    """The words of some texts, one after another."""

    data: np.ndarray     # lower-cased bytes of all texts
    start: np.ndarray    # of each word in data
    end: np.ndarray
    first: np.ndarray    # of each text, and the number of all: its first word

    def text(self, a: int, b: int) -> str:
        return " ".join(self.data[s:e].tobytes().decode("utf-8", "replace")
                        for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist()))


def words_of(texts: pa.Array) -> Words:
    """``texts``: binary, no nulls."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
    data = _LOWER[raw]
    inside = _IN_WORD[data]
    at = at - at[0]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True                                 # no word reaches into the next text
    here, before = inside, np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(here & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]])
    end = np.flatnonzero(here & (~after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, at))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h = h ^ (h >> np.uint64(29))
    return h * _MIX


def word_hashes(w: Words) -> np.ndarray:
    """Eight bytes at a time, all words at once."""
    size = w.end - w.start
    h = size.astype(np.uint64)
    if not len(h):
        return h
    padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(w.data) + 1, 8), (1, 1))
    left, at = np.arange(len(h)), 0
    while len(left):
        part = np.ascontiguousarray(eight[w.start[left] + at]).view("<u8").ravel()
        over = np.maximum(0, 8 - (size[left] - at)).astype(np.uint64) * np.uint64(8)
        part = (part << over) >> over               # bytes beyond the word are dropped
        h[left] = _mixed((h[left] ^ part) * _BASE)
        at += 8
        left = left[size[left] > at]
    return h


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Of the n-gram that begins at each word (the last n - 1 are void)."""
    out = np.full(len(h), np.uint64(n))
    for j in range(n):
        out[:len(h) - j] = _mixed(out[:len(h) - j] ^ h[j:]) if j < len(h) else 0
    return out


def _inside(w: Words, n: int) -> np.ndarray:
    """Whether the n words from each word on lie in one text."""
    count = np.diff(w.first)
    left = np.repeat(w.first[1:], count) - np.arange(len(w.start))   # words to the text's end
    return left >= n


def fingerprints(w: Words, h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at which the kept k-grams begin, in order, and their hashes."""
    grams, spare = gram_hashes(h, gram), window - gram
    m = len(h) - spare
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = grams[:m].copy(), np.arange(m)
    for j in range(1, spare + 1):
        better = grams[j:j + m] <= best
        best[better] = grams[j:j + m][better]
        at[better] = np.flatnonzero(better) + j
    kept = np.unique(at[_inside(w, window)[:m]])
    return kept, grams[kept]


def marks(texts: pa.Array, keep, short: list[int], window: int, gram: int):
    """(words of each text; text number, hash, n, offset, context, position of
    each fingerprint that ``keep`` lets pass). n is the length of a run that
    counts."""
    w = words_of(texts)
    h = word_hashes(w)
    out = []
    for n, k in [(window, gram), *((n, n) for n in short)]:
        at, hashes = fingerprints(w, h, n, k)
        stays = keep(hashes)
        at, hashes = at[stays], hashes[stays].astype(np.int64)
        text = np.searchsorted(w.first, at, side="right") - 1
        lo, hi = np.maximum(at - (n - k), w.first[text]), np.minimum(at + n, w.first[text + 1])
        out += [(t, x, n, a - b, w.text(b, c), a)
                for t, x, a, b, c in zip(text.tolist(), hashes.tolist(), at.tolist(), lo.tolist(), hi.tolist())]
    return np.diff(w.first), w.first, out


# -- filter --------------------------------------------------------------------

def _bits(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    h = h.astype(np.uint64)
    for k in range(PROBES):
        yield (h >> np.uint64(1 + 29 * k)) & np.uint64(size - 1)


class Filter:
    """A Bloom filter; what it holds passes, most else doesn't."""

    def __init__(self, words: np.ndarray):
        self.words = words        # of 64 bits

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for b in _bits(h, len(self.words) * 64):
            out &= (self.words[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1) == 1
        return out


def item_filter(hashes: DataFrame, limit: int = FILTER_BITS) -> Filter:
    """From the column ``h``: 16 bits a distinct hash, ``limit`` at most; built
    by the executors, so at most limit / 64 numbers reach the driver."""
    n = hashes.select("h").distinct().count()
    size = 1 << 12
    while size < min(16 * n, limit):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch["h"].to_numpy().astype(np.uint64)
            b = np.concatenate(list(_bits(h, size))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(b >> 6), pa.array((np.uint64(1) << (b & 63).astype(np.uint64)).view(np.int64))],
                                             ["at", "bits"])

    got = (hashes.select("h").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    words = np.zeros(size // 64, np.uint64)
    words[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return Filter(words)


# -- join ----------------------------------------------------------------------

def item_marks(items: DataFrame, item_id: str, text: str, window: int, gram: int) -> DataFrame:
    """(item, h, n, off, ctx): the fingerprints of all items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_ranges(batch["text"]):
                texts, ids = raw_bytes(batch["text"].slice(a, b - a)), batch["item"].slice(a, b - a)
                size = np.diff(words_of(texts).first)
                rows = []
                for n in {min(x, window) for x in size.tolist()} - {0}:      # short items by their length
                    pick = np.flatnonzero(np.minimum(size, window) == n)
                    part, names = texts.take(pa.array(pick)), ids.take(pa.array(pick)).to_pylist()
                    k = gram if n == window else n
                    rows += [(names[t], *rest[:-1]) for t, *rest in marks(part, lambda h: np.ones(len(h), bool), [], n, k)[2]]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string()))],
                    ["item", "h", "n", "off", "ctx"])

    rows = items.select(items[item_id].cast("string").alias("item"), whole_text(items, text).alias("text"))
    return rows.mapInArrow(run, "item string, h long, n int, off int, ctx string")


def document_marks(docs: DataFrame, doc_id: str, text: str, keep: Filter, short: list[int], window: int, gram: int) -> DataFrame:
    """(doc_id, n_words, found): the fingerprints of each document that may be
    an item's."""
    kind = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int32()), ("off", pa.int32()), ("ctx", pa.string()), ("pos", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_ranges(batch["text"]):
                size, first, got = marks(raw_bytes(batch["text"].slice(a, b - a)), keep, short, window, gram)
                found: list[list[dict]] = [[] for _ in range(b - a)]
                for t, h, n, off, ctx, at in got:
                    found[t].append({"h": h, "n": n, "off": off, "ctx": ctx, "pos": at - int(first[t])})
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), pa.array(size, pa.int64()), pa.array(found, kind)],
                                                 ["doc_id", "n_words", "found"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), whole_text(docs, text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, found array<struct<{MARK.replace(' ', ':')}>>"
                           .replace(",:", ","))


def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of contexts that share a hash: the run of equal words around the k-gram,
    as words before and after its first, if it is long enough."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            a, b = r["ctx"].split(" "), r["item_ctx"].split(" ")
            i, j = r["off"], r["item_off"]
            lo = hi = 0
            while lo < min(i, j) and a[i - lo - 1] == b[j - lo - 1]:
                lo += 1
            while hi < min(len(a) - i, len(b) - j) and a[i + hi] == b[j + hi]:
                hi += 1
            if lo + hi >= r["n"]:
                rows.append((r["ctx"], r["off"], r["n"], r["item_ctx"], r["item_off"], lo, hi))
        cols = list(zip(*rows)) or [[]] * 7
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         ["ctx", "off", "n", "item_ctx", "item_off", "lo", "hi"])


def hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: row, doc_id, n_words; spans: row, begin, until; matches: row,
    item): the shared runs of each document and the items it shares them with."""
    known = cut_lineage(item_marks(items, item_id, item_text, window, gram), "decon-items")
    short = sorted(r.n for r in known.where(F.col("n") < window).select("n").distinct().collect())   # below the window
    keep = item_filter(known)
    rows = cut_lineage(document_marks(docs, doc_id, text, keep, short, window, gram)
                       .withColumn("row", F.monotonically_increasing_id()), "decon-documents")
    found = rows.select("row", F.inline("found"))
    # contexts, each once, meet the items' contexts, each once
    contexts = found.select("h", "n", "off", "ctx").distinct()
    theirs = known.select("h", "n", F.col("off").alias("item_off"), F.col("ctx").alias("item_ctx")).distinct()
    runs = cut_lineage(contexts.join(theirs, ["h", "n"]).select("ctx", "off", "n", "item_ctx", "item_off").mapInArrow(
        extended, "ctx string, off int, n int, item_ctx string, item_off int, lo int, hi int"), "decon-runs")
    who = known.where("item IS NOT NULL").select("n", F.col("off").alias("item_off"), F.col("ctx").alias("item_ctx"), "item")
    spans = runs.select("ctx", "off", "n", "lo", "hi").distinct()
    names = runs.join(who, ["n", "item_off", "item_ctx"]).select("ctx", "off", "n", "item").distinct()
    salted = found.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    key = ["ctx", "off", "n", "salt"]
    back = salted.join(spans.withColumn("salt", every), key).select(
        "row", (F.col("pos") - F.col("lo")).alias("begin"), (F.col("pos") + F.col("hi")).alias("until"))
    matches = salted.join(names.withColumn("salt", every), key).select("row", "item")
    return rows.drop("found"), back.distinct(), matches.distinct()


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), one row per
    document: words inside shared runs, and the items (ids as strings, sorted)
    they come from."""
    rows, spans, matches = hits(docs, items, **options)
    # words of the runs, each once: what a run adds to those that begin before it
    before = Window.partitionBy("row").orderBy("begin", "until").rowsBetween(Window.unboundedPreceding, -1)
    new = spans.withColumn("seen", F.coalesce(F.max("until").over(before), F.lit(0)))
    words = new.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("until") - F.greatest("begin", "seen"))).alias("n_hit"))
    named = matches.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))   # a document's own
    none = F.lit([]).cast("array<string>")
    return (rows.join(words, "row", "left").join(named, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", none).alias("items"))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    (F.col("n_hit") > 0).alias("contaminated")))
