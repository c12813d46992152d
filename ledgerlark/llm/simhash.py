"""SimHash near-duplicates by pigeonhole blocks.

``fingerprints`` gives a 64-bit fingerprint a document, ``classes`` the
connected classes of fingerprints that differ in at most ``bits`` bits.

1. Equal fingerprints are one node (map-side combined), so exact copies, also
   thousands, are never paired.
2. The fingerprint is split into ``bits + spare`` blocks. Two that differ in
   at most ``bits`` bits agree on at least ``spare`` blocks, so they share the
   key of one choice of ``spare`` blocks. Nodes are joined on these keys.
3. A key with few nodes is joined with itself and each pair verified by
   ``bit_count`` of the exclusive or. A key with more than ``PAIR_LIMIT`` nodes
   is cut finer by an exact route: under one key the nodes differ in free bits
   only, so two are within 2 bits just if one common value is within one flip
   of both; every node files itself under its flips, and whoever shares a
   value is linked to the smallest one there. That is linear in the nodes; no
   pair is lost and none is listed. (The route is for 2 bits; at other
   distances all pairs of a key are verified.)
4. Classes by alternating large-star and small-star rounds over the links,
   each written to the shared folder; nothing reaches the driver but one sum.

Defined results
* null or empty text, or one without words: fingerprint zero, linked like any
  other; fewer words than a shingle: the whole word sequence is one shingle;
* ties and repeated rows: equal fingerprints are one class; ``component_id``
  is its smallest doc_id; null doc_ids are ignored in that minimum;
* an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ids_and_text, raw_bytes, whole_text

SHINGLE = 3
BITS = 2
SPARE = 3
PAIR_LIMIT = 32
SEED = 42
ROWS = 1 << 16


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text (UTF-8)."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) <= k:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(k))))
    h = np.fromiter((hashed(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), ROWS):
        part = h[i:i + ROWS].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprint_column(text: Column, k: int = SHINGLE) -> Column:
    """Fingerprint as a signed long."""
    def run(values: pa.Array) -> pa.Array:
        got = np.fromiter((fingerprint(v.as_py() or b"", k) for v in raw_bytes(values)), np.uint64, len(values))
        return pa.array(got.view(np.int64))

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "long").asNondeterministic()(text)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), one row per input row, written once."""
    base = ids_and_text(docs, doc_id, text)
    return cut_lineage(base.select("doc_id", fingerprint_column(F.col("text"), k).alias("fp")), "simhash-fp")


def blocks(bits: int, spare: int) -> list[int]:
    """Signed masks of the unions of ``spare`` out of ``bits + spare`` blocks."""
    n = bits + spare
    edges = [64 * i // n for i in range(n + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(n)]
    return [_signed(sum(c)) for c in combinations(parts, spare)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(nodes: DataFrame, bits: int = BITS, spare: int = SPARE, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Distinct (a, b), a < b, whose transitive closure is that of all pairs
    of fingerprints ``nodes.fp`` within ``bits`` bits; every link is such a
    pair."""
    masks = blocks(bits, spare)
    keyed = nodes.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("choice", "key"))
    counted = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut_lineage(keyed.join(counted, ["choice", "key"]), "simhash-keys")
    few = shared.where(F.col("n") <= pair_limit) if bits == 2 else shared
    a, b = few.select("choice", "key", F.col("fp").alias("a")), few.select("choice", "key", F.col("fp").alias("b"))
    found = (a.join(b, ["choice", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits))
             .select("a", "b"))
    if bits == 2:
        flips = F.array(*[
            F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)).cast("long") for k in range(64) if not m >> k & 1])
            for m in masks])
        near = (shared.where(F.col("n") > pair_limit)
                .select("fp", F.explode(F.get(flips, F.col("choice"))).alias("flip"))
                .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).distinct())
        least = near.groupBy("value").agg(F.min("fp").alias("a"))
        found = found.union(near.join(least, "value").where("fp <> a").select("a", F.col("fp").alias("b")))
    return found.distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each class, for nodes with a link
    that aren't roots. Alternating large-star and small-star."""
    edges = cut_lineage(edges, "simhash-links")
    state = _state(edges)
    while state[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("m").alias("a"), "b").distinct())
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").select("m", F.explode(F.array("a", "b")).alias("b"))
                 .where("m <> b").select(F.col("m").alias("a"), "b").distinct())
        after = cut_lineage(small, "simhash-links")
        now = _state(after)
        edges = after
        if now == state:
            break
        state = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def classes(fps: DataFrame, bits: int = BITS, spare: int = SPARE, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(fp, component_id): the smallest doc_id of each fingerprint's class."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = cut_lineage(nodes, "simhash-nodes")
    roots = connected(links(nodes, bits, spare, pair_limit))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                    bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row."""
    fps = fingerprints(docs, doc_id, text, k)
    out = fps.join(classes(fps, bits), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` with one row left of each class: of its smallest
    doc_id, and where that repeats, of the smallest XXH64 of the text, then the
    row read first. A row without a doc_id stays only if its class has no
    doc_id at all."""
    cols = docs.columns
    p = "__simhash_"
    tagged = cut_lineage(
        docs.withColumn(f"{p}text", whole_text(docs, text))
        .withColumn(f"{p}fp", fingerprint_column(F.col(f"{p}text"), k))
        .withColumn(f"{p}hash", F.xxhash64(f"{p}text"))
        .withColumn(f"{p}row", F.monotonically_increasing_id())
        .drop(f"{p}text"), "simhash-docs")
    rows = tagged.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"{p}fp").alias("fp"),
                         F.col(f"{p}hash").alias("hash"), F.col(f"{p}row").alias("row"))
    # of each fingerprint its first row, then of each class
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "row")
    best = rows.groupBy("fp").agg(F.min(order).alias("first"))
    best = cut_lineage(best, "simhash-nodes")
    roots = connected(links(best.select("fp"), bits))
    placed = best.join(roots, best["fp"] == roots["node"], "left").select(
        F.coalesce("root", "fp").alias("root"), "first")
    winners = placed.groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.row").alias(f"{p}row"))
    return tagged.join(winners, f"{p}row", "left_semi").select(*[F.col(f"`{c}`") for c in cols])
