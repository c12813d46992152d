"""Token files: canonical length-limited Huffman coding of ids.

Format, a folder with two tables:

``codebook``  id, bits: the code length of every id that occurs. Codes follow from
              the lengths alone (canonical: ascending by length, then id).
``blocks``    one row a block in ``part=P/piece=S`` folders, ascending by P, S and
              ``start``, which is ascending by document: the block's documents
              (``doc_ids``), their token counts, ``start`` (tokens of the part
              before the block), the coded ids and ``checkpoints``, the bit
              offset of every ``STEP``-th token.

Writing. Documents are dealt into parts by ranges of doc_id and sorted, encoded,
and their ids kept once (in the shared folder); global counts of the ids give
optimal code lengths of at most ``LIMIT`` bits by package-merge; then blocks are
coded independently.

Reading. Blocks are independent. From its checkpoints a block is decoded in
many places at once: each step looks up the next bits of every run in one table
of 2 ** longest entries that gives the id and its length.

Defined results
* null or empty text: only the end id; an empty table: no block;
* documents with one doc_id stand together, ordered by XXH64 of the text, then
  the text; documents without doc_id come first;
* a document is never cut; a block holds at least one;
* other columns are not read.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage, stage_root
from .bpe import byte_letters
from .common import RecentCache, held, ids_and_text, release, row_ranges, ship

LIMIT = 17
STEP = 256
BLOCK_TOKENS = 1 << 19
CHUNK = 1 << 15
END_ID = 1
CACHED_WORDS = 250_000
#: Words that lower-casing, NFC and the letter pattern leave as one piece.
PLAIN = "^[a-zß-öø-ÿ]+$"
PARTED = r"([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~])"
#: Byte-level letters of Latin-1 bytes, by code point.
LETTERS = {b: c for c, b in byte_letters().items()}


# -- encoding ---------------------------------------------------------------

class WordIds:
    """Ids of words by the tokenizers library, for tokenizers that drop white
    space: a text's ids are those of its words in order.

    Texts are cut into words and their distinct words found in Arrow, a few
    megabytes at a time; only distinct words not met lately go through the
    library. Words that its normalizer and pattern leave as they are (small
    Latin letters) are handed straight to its BPE model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.seen = RecentCache(CACHED_WORDS)
        # checked on the tokenizer at hand, not taken for granted
        self.plain = all(self._ids(w) == self._model(w) for w in ("word", "naïveté", "größe", "x", "abcdefghij"))
        self.spelling = all(self._ids(a) == self._ids(b) for a, b in (
            ("The Word", "the word"), ("ab. cd, ef.", "ab . cd , ef ."), ("ab.cd,ef", "ab .cd ,ef"),
            ("a... b,. c&&&", "a ... b ,. c &&&"), ("é%%% a-b@c", "é %%% a -b @c")))

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _model(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(LETTERS))]

    def learn(self, words: list[str]) -> None:
        plain = pc.match_substring_regex(pa.array(words, pa.string()), PLAIN).to_pylist()
        tokenize, seen = self.model.tokenize, self.seen
        for word, easy in zip(words, plain):
            if easy and self.plain:
                got = [t.id for t in tokenize(word)] if word.isascii() else self._model(word)
            else:
                got = self._ids(word)
            seen[word] = array("I", got).tobytes()

    def words(self, texts: pa.Array) -> pa.ListArray:
        """The words of each text, in the spelling they are looked up by: the
        tokenizer's own normalizer lower-cases, and its pattern parts punctuation
        (but for the apostrophe) from the letter before it, so words that differ
        in these are one. Texts that may hold a special token, whose case counts, stay as they are."""
        if self.spelling:
            spelled = pc.replace_substring_regex(pc.ascii_lower(texts), PARTED, r"\1 \2")
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, spelled)
        return pc.ascii_split_whitespace(texts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (a few megabytes, no nulls), and where each
        text's end."""
        words = self.words(texts)
        ends = words.offsets.to_numpy()
        found = words.flatten().dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(self.seen.__getitem__, distinct))
        new = [w for w, ids in zip(distinct, got) if ids is None]
        if new:
            self.learn(new)
            got = [self.seen[w] if ids is None else ids for w, ids in zip(distinct, got)]
        self.seen.trim()
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32),
                                         np.frombuffer(b"".join(got), np.uint32))
        ids = lists.take(found.indices)
        return ids.values.to_numpy(), ids.offsets.to_numpy()[ends[1:] - ends[0]].astype(np.int64)


def word_ids(path: str) -> WordIds:
    return held(("words", path), lambda: WordIds(path))


IDS_SCHEMA = "part long, start long, doc_id long, n_tokens long, ids binary"


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary array of the ids up to each end."""
    at = np.concatenate([[0], 4 * ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(ids.tobytes())])


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary array, and where each row's begin and the last end."""
    _, at, data = ids.buffers()
    at = np.frombuffer(at, np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data and len(ids) else np.zeros(0, np.uint8)
    return raw.view("<u4") if raw.flags.aligned else np.frombuffer(raw.tobytes(), "<u4"), (at - at[0]) // 4


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, start, doc_id, n_tokens, ids): 32-bit ids with the end id,
    ascending by doc_id within and across parts; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        words = word_ids(path)
        for batch in batches:
            for a, b in row_ranges(batch["text"], 8 << 20):
                ids, ends = words.encode(batch["text"].slice(a, b - a))
                ids = np.insert(ids, ends, END_ID).astype("<u4")   # after each text
                ends = ends + np.arange(1, len(ends) + 1)
                n = np.diff(ends, prepend=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part)), pa.array(start + ends - n), batch["doc_id"].slice(a, b - a),
                     pa.array(n), _binary(ids, ends)], ["part", "start", "doc_id", "n_tokens", "ids"])
                start += int(ends[-1])
            release()

    base = ids_and_text(docs, doc_id, text)
    placed = (base.withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash")
              .sortWithinPartitions("doc_id", "hash", "text").drop("hash"))
    return cut_lineage(placed.mapInArrow(run, IDS_SCHEMA), "token-ids")


def counts(ids: DataFrame) -> DataFrame:
    """(id, n) over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(_flat(batch["ids"])[0])
            total = np.pad(total, (0, max(0, len(got) - len(total))))
            total[:len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# -- codes --------------------------------------------------------------------

def code_lengths(n: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for symbols that occur n
    times, by package-merge."""
    if len(n) < 2:
        return np.ones(len(n), np.int64)
    limit = max(limit, int(np.ceil(np.log2(len(n)))))
    order = np.argsort(n, kind="stable")
    coins = n[order].astype(np.float64)
    level, kept = coins, [np.ones(len(coins), bool)]
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([coins, pairs])
        place = np.argsort(both, kind="stable")
        level = both[place]
        kept.append(place < len(coins))
    lengths = np.zeros(len(n), np.int64)
    take = 2 * len(n) - 2
    for coin in reversed(kept):
        own = int(coin[:take].sum())     # the cheapest coins of this level
        lengths[order[:own]] += 1
        take = 2 * (take - own)          # each package is two of the level below
    return lengths


def canonical_codes(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Codes by ascending length, then id."""
    order = np.lexsort((ids, bits))
    codes = np.zeros(len(ids), np.uint64)
    code, last = 0, 0
    for i in order.tolist():
        code <<= int(bits[i]) - last
        last = int(bits[i])
        codes[i] = code
        code += 1
    return codes


class Code:
    """Tables to code and decode by; ``ids`` ascending."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.longest = int(bits.max()) if len(bits) else 1
        size = int(ids.max()) + 1 if len(ids) else 1
        codes = canonical_codes(ids, bits)
        self.code, self.bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[ids], self.bits[ids] = codes, bits
        # by the next bits: the id and, in the low byte, its length
        self.table = np.ones(1 << self.longest, np.int64)
        for i, b, c in zip(ids.tolist(), bits.tolist(), codes.tolist()):
            low = c << (self.longest - b)
            self.table[low:low + (1 << (self.longest - b))] = i << 8 | b

    def pack(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The coded ids and their checkpoints, worked out in pieces that stay
        in the processor's cache."""
        if not len(ids):
            return b"", b""
        total = np.zeros(len(ids) * self.longest // 32 + 2, np.uint64)
        marks, end = [], 0
        for start in range(0, len(ids), CHUNK):
            part = ids[start:start + CHUNK]
            bits = self.bits[part]
            at = end + np.cumsum(bits) - bits
            end = int(at[-1] + bits[-1])
            marks.append(at[-start % STEP::STEP])
            word, shift = at >> 5, at & 31
            value = self.code[part] << (64 - bits - shift).astype(np.uint64)
            # bits of different ids never overlap: or is sum
            first = np.flatnonzero(np.diff(word, prepend=-1))
            total[word[first]] |= np.bitwise_or.reduceat(value >> np.uint64(32), first)
            total[word[first] + 1] |= np.bitwise_or.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return total[:(end + 31) // 32].astype(">u4").tobytes(), np.concatenate(marks).astype("<u8").tobytes()

    def unpack(self, data: bytes, checkpoints: bytes, n: int) -> np.ndarray:
        """All runs of a block side by side, one id of each at a time."""
        raw = np.frombuffer(data + bytes(STEP * self.longest // 8 + 8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
        out = np.empty((STEP, len(at)), np.int64)
        drop = 32 - self.longest
        keep = (1 << self.longest) - 1
        for k in range(STEP):
            got = self.table[(window[at >> 3] >> (drop - (at & 7))) & keep]
            out[k] = got
            at = at + (got & 255)
        return (out.T.ravel()[:n] >> 8).astype(np.uint32)


def _code(key: str, ids: bytes, bits: bytes) -> Code:
    return held(("code", key), lambda: Code(np.frombuffer(ids, "<i8"), np.frombuffer(bits, "<i8")))


# -- files --------------------------------------------------------------------

BLOCKS_SCHEMA = ("part long, piece long, start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
                 "checkpoints binary, data binary")


def write(ids: DataFrame, path: str, limit: int = LIMIT, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token files of (part, start, doc_id, n_tokens, ids)."""
    got = counts(ids).orderBy("id").toArrow()  # as many rows as the vocabulary has ids, at most
    symbols = got["id"].to_numpy()
    bits = code_lengths(got["n"].to_numpy(), limit)
    spark = ids.sparkSession
    spark.createDataFrame(pa.table({"id": symbols, "bits": bits})).coalesce(1).write.parquet(f"{path}/codebook")
    key, a, b = uuid.uuid4().hex, symbols.astype("<i8").tobytes(), bits.astype("<i8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code(key, a, b)
        held: list[tuple] = []
        piece, size, after = 0, 0, None  # after: where the next document of this piece would start

        def block() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(x[3] for x in held), np.uint32)
            data, marks = code.pack(flat)
            row = (held[0][0], piece, held[0][1], len(flat), [x[2] for x in held], [len(x[3]) // 4 for x in held],
                   marks, data)
            types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 2
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              [f.split()[0] for f in BLOCKS_SCHEMA.split(", ")])

        for batch in batches:
            for row in zip(batch["part"].to_pylist(), batch["start"].to_pylist(), batch["doc_id"].to_pylist(),
                           (x.as_py() for x in batch["ids"])):
                follows = after == row[:2]
                if held and (not follows or size >= block_tokens):
                    yield block()
                    held, size = [], 0
                if not follows:
                    piece = row[1]
                held.append(row)
                size += len(row[3]) // 4
                after = (row[0], row[1] + len(row[3]) // 4)
        if held:
            yield block()

    (ids.select("part", "start", "doc_id", "ids").mapInArrow(run, BLOCKS_SCHEMA)
     .write.partitionBy("part", "piece").option("compression", "uncompressed").parquet(f"{path}/blocks"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of token files: ``start`` counts the ids of
    all documents before, ``ids`` are little-endian 32-bit ids."""
    ship(spark)
    book = spark.read.parquet(f"{path}/codebook").orderBy("id").toArrow()
    key, a, b = uuid.uuid4().hex, *(book[c].to_numpy().astype("<i8").tobytes() for c in ("id", "bits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code(key, a, b)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch[c][i] for c in batch.schema.names}
                n = r["doc_tokens"].values.to_numpy()
                ids = code.unpack(r["data"].as_py(), r["checkpoints"].as_py(), int(n.sum())).astype("<u4").tobytes()
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), r["part"].as_py())), r["doc_ids"].values,
                     pa.array(r["start"].as_py() + ends - n), pa.array(n),
                     pa.array([ids[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist())], pa.binary())],
                    ["part", "doc_id", "inner", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks")
    docs = blocks.select("part", "start", "doc_ids", "doc_tokens", "checkpoints", "data").mapInArrow(
        run, "part long, doc_id long, inner long, n_tokens long, ids binary")
    # one row a part: as many as the writing tasks
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids")


def digest(ids: Column) -> Column:
    """Unsigned crc32 of little-endian 32-bit ids."""
    return F.crc32(ids)


def write_documents(docs: DataFrame, tokenizer: str, path: str | None = None, doc_id: str = "doc_id",
                    text: str = "text") -> str:
    """Encode and write ``docs``; the folder, by default one under the shared
    folder of this application."""
    path = path or f"{stage_root(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write(encoded(docs, tokenizer, doc_id, text), path)
    return path
