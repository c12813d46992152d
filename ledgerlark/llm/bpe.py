"""Byte-pair encoding by last-token states over a trie, and decoding.

The encoding of a prefix ends in one certain token, its last token; what stands
before it is the encoding of the shorter prefix. So one token a trie node says
everything: the last token t of a prefix is the one vocabulary entry that is a
suffix of it and whose boundary with the last token of the rest is never
merged over. Distinct words go into a trie, a depth-first walk passes the
states down, and a shared prefix is worked out once however many words have it.

Whether a boundary holds follows from the merge trees: the right edge of the
left token and the left edge of the right token grow by merges of known rank;
it is broken just if two pieces that stand side by side at the same time form
a pair that ranks before what either is merged into next.

Work is spread by Spark over the partitions of the documents; each task cuts
its texts into words, encodes the words it hasn't met lately and looks up the
rest. A text is cut as the byte-level pattern cuts it; strings of special
tokens inside a text are their ids, as the library does.

Defined results
* null or empty text: no ids, decoded text empty; null ids decode to empty;
* whole texts, however long: a text's words are looked up one after another;
* repeated rows give repeated rows, an empty table an empty table; other
  columns are not read;
* an id outside the vocabulary decodes to nothing.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, held, ids_and_text, release, row_ranges

#: Unicode White_Space, fixed by the standard.
WS = "\t-\r \x85\xa0  -     　"
#: Pieces between which no word of the byte-level pattern reaches.
CHUNK = re.compile(f" ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
#: The byte-level word pattern of the vocabulary (fixed by its format).
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
CACHED_CHUNKS = 120_000
CACHED_PAIRS = 300_000
CACHED_STEPS = 250_000
#: What the quick cut at single spaces and line ends would get wrong: other
#: white space, its mark, and longer runs.
ODD = (r"[\t\x0b\x0c\r\x00\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
       r"|[ \n][ \n][ \n]|[ \n][ \n]\z")
#: No word of the pattern goes on from a letter into punctuation.
WORD_END = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])"
#: Pieces that are one word.
ONE_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The format's letter for each byte: printable Latin-1 stands for itself,
    the other bytes take the letters from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Byte-level merges with the tables the trie walk needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        byte = byte_letters()
        by_name = data["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = [b""] * (1 + max([*by_name.values(), *self.special.values()]))
        for name, i in by_name.items():
            if name not in self.special:
                self.tokens[i] = bytes(byte[c] for c in name)
        for name, i in self.special.items():
            self.tokens[i] = name.encode()
        self.ids: dict[bytes, int] = {self.tokens[i]: i for n, i in by_name.items() if len(n) == 1}
        self.rank: dict[int, int] = {}                   # merge rank of a pair of ids
        self.made: dict[int, tuple[int, int, int]] = {}  # by id: the pair it is merged from, and when
        self.pairs: dict[int, bool] = {}
        for r, merge in enumerate(data["model"]["merges"]):
            x, y = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = by_name[x], by_name[y], by_name[x + y]
            self.rank[a << 20 | b] = r
            # an entry that merging its own bytes doesn't end in is never met
            if self.tokens[a] in self.ids and self.tokens[b] in self.ids and c not in self.made and self.stands(a, b, r):
                self.made[c] = (a, b, r)
                self.ids[self.tokens[c]] = c
        self.suffixes = Suffixes(self.ids)

    def edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """The pieces at a token's first (0) or last (1) byte, from the byte
        up, each with the rank at which it is merged into the next."""
        out, ends = [], NEVER
        while True:
            out.append((t, ends))
            if t not in self.made:
                return out[::-1]
            pair = self.made[t]
            t, ends = pair[side], pair[2]

    def stands(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether no merge before rank ``until`` crosses from a to b."""
        right, left, rank = self.edge(a, 1), self.edge(b, 0), self.rank
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = right[i], left[j]
            r = rank.get(x << 20 | y, NEVER)
            # equal pairs merge from the left: x's own merge comes before this
            # one, y's after it
            if r < until and r < x_ends and r <= y_ends:
                return False
            if min(x_ends, y_ends) >= until:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def pair(self, a: int, b: int) -> bool:
        """``stands``, remembered; ids are below 2 ** 20."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        got = self.pairs[a << 20 | b] = self.stands(a, b)
        return got


class Suffixes:
    """For each text read byte by byte, the vocabulary entries that end it,
    longest first; states are worked out when first met."""

    def __init__(self, ids: dict[bytes, int]):
        self.child: dict[int, int] = {}        # state << 8 | byte -> longer state
        levels: dict[int, list[tuple[int, int, int]]] = {}
        own: dict[int, tuple[int, int]] = {}
        n = 0
        for w, t in ids.items():
            state = 0
            for depth, byte in enumerate(w):
                key = state << 8 | byte
                if key not in self.child:
                    n += 1
                    self.child[key] = n
                    levels.setdefault(depth, []).append((state, byte, n))
                state = self.child[key]
            own[state] = (t, len(w))
        self.fail, self.ends = [0] * (n + 1), [()] * (n + 1)
        for depth in sorted(levels):           # what a state falls back to is shorter, so it is ready
            for state, byte, new in levels[depth]:
                back = self.fail[new] = self._shorter(state, byte)
                self.ends[new] = (own[new], *self.ends[back]) if new in own else self.ends[back]
        self.step = dict(self.child)

    def _shorter(self, state: int, byte: int) -> int:
        while state:
            state = self.fail[state]
            got = self.child.get(state << 8 | byte)
            if got is not None:
                return got
        return 0

    def next(self, state: int, byte: int) -> int:
        got = self.step.get(state << 8 | byte)
        if got is None:
            if len(self.step) >= CACHED_STEPS:
                self.step.clear()
                self.step.update(self.child)
            got = self.step[state << 8 | byte] = self._shorter(state, byte)
        return got


def encode_words(words: list[bytes], v: Vocabulary) -> list[list[int]]:
    """Ids of each of the sorted distinct words, by one walk of their trie.

    Sorted words are their trie laid out depth-first: what a word has in
    common with the one before is the path down to where it branches off, and
    the states on that path stay as they are."""
    out: list[list[int]] = []
    suffixes, pair, known = v.suffixes, v.pair, v.pairs  # cleared, never replaced
    step, ends = suffixes.step, suffixes.ends
    last: list[int] = [0]          # last token of the prefix of each length,
    size: list[int] = [0]          # its length,
    state: list[int] = [0]         # and the suffix state there
    before = b""
    for w in words:
        n, most = 0, min(len(w), len(before))
        while n < most and w[n] == before[n]:
            n += 1
        del last[n + 1:], size[n + 1:], state[n + 1:]
        at = state[n]
        for depth in range(n + 1, len(w) + 1):
            byte = w[depth - 1]
            to = step.get(at << 8 | byte)
            at = suffixes.next(at, byte) if to is None else to
            for t, k in ends[at]:
                if k == depth:
                    break
                prior = last[depth - k]
                ok = known.get(prior << 20 | t)
                if pair(prior, t) if ok is None else ok:
                    break
            last.append(t)
            size.append(k)
            state.append(at)
        before = w
        found, at = [], len(w)
        while at:
            found.append(last[at])
            at -= size[at]
        found.reverse()
        out.append(found)
    return out


class Encoder:
    """One a Python worker; remembers the ids of pieces met lately."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.seen = RecentCache(CACHED_CHUNKS)
        special = "|".join(map(regex.escape, sorted(self.v.special, key=len, reverse=True)))
        self.split = regex.compile(f"({special})") if special else None
        self.odd = "|".join([ODD, *(re.sub(r"\W", lambda m: f"\\x{{{ord(m[0]):x}}}", t) for t in self.v.special)])
        self.table = pa.array([*self.v.tokens, b""], pa.binary())

    def learn(self, pieces: list[str]) -> None:
        """One trie for all the words of these pieces."""
        parts = [[c.encode()] if ONE_WORD(c) else [w.encode() for w in WORDS.findall(c)] for c in pieces]
        words = sorted({w for p in parts for w in p})
        ids = {w: array("i", x).tobytes() for w, x in zip(words, encode_words(words, self.v))}
        for c, p in zip(pieces, parts):
            self.seen[c] = ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p])

    def pieces(self, text: str) -> list[str]:
        return [c for i, part in enumerate(self.split.split(text) if self.split else [text])
                for c in ([part] if i % 2 else CHUNK.findall(part))]

    def lists(self, pieces: pa.Array) -> pa.ListArray:
        """Ids of each piece."""
        found = pieces.dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(self.seen.__getitem__, distinct))
        new = [c for c, ids in zip(distinct, got) if ids is None]
        if new:
            for c in new:
                if c in self.v.special:
                    self.seen[c] = array("i", [self.v.special[c]]).tobytes()
            self.learn([c for c in new if c not in self.v.special])
            got = [self.seen[c] if ids is None else ids for c, ids in zip(distinct, got)]
        self.seen.trim()
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32),
                                        np.frombuffer(b"".join(got), np.int32)).take(found.indices)

    def rows(self, pieces: pa.ListArray) -> pa.ListArray:
        """Ids of each text from its pieces."""
        ids = self.lists(pieces.flatten())
        ends = pieces.offsets.to_numpy()
        return pa.ListArray.from_arrays(ids.offsets.to_numpy()[ends - ends[0]], ids.values)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of some texts (a few megabytes, no nulls). Texts whose white
        space is single spaces and line ends are cut in Arrow."""
        odd = pc.match_substring_regex(texts, self.odd)
        plain = texts.filter(pc.invert(odd))
        cut = pc.replace_substring(pc.replace_substring(plain, "\n", "\0\n\0"), " ", "\0 ")
        cut = pc.replace_substring_regex(cut, WORD_END, "\\1\0\\2")
        done = self.rows(pc.split_pattern(cut, "\0"))
        if len(plain) == len(texts):
            return done
        rest = self.rows(pa.array([self.pieces(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.string())))
        odd = odd.to_numpy(zero_copy_only=False)
        place = np.where(odd, len(plain) + np.cumsum(odd), np.cumsum(~odd)) - 1
        return pa.concat_arrays([done, rest]).take(pa.array(place))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The texts of lists of ids."""
        flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(
            pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
        none = len(self.table) - 1
        parts = self.table.take(pa.array(np.where((flat >= 0) & (flat < none), flat, none)))
        _, at, data = parts.buffers()
        at = np.frombuffer(at, np.int32)[:len(parts) + 1][ends]
        out = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at.tobytes()), data or pa.py_buffer(b"")])
        try:
            return out.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8: as the library's decoder
            return pa.array([b.decode("utf-8", "replace") for b in out.to_pylist()], pa.string())


def encoder(path: str) -> Encoder:
    return held(("bpe", path), lambda: Encoder(path))


def encode_column(text: Column, path: str) -> Column:
    """Ids of a string column without nulls as array<int>."""
    def run(values: pa.Array) -> pa.Array:
        enc = encoder(path)
        parts = [enc.encode(values.slice(a, b - a)) for a, b in row_ranges(values)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<int>").asNondeterministic()(text)


def decode_column(ids: Column, path: str) -> Column:
    """The text of an array<int> column; null decodes to nothing."""
    def run(values: pa.Array) -> pa.Array:
        return encoder(path).decode(values)

    run.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string").asNondeterministic()(ids)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids), one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for a, b in row_ranges(batch["text"]):
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), enc.encode(batch["text"].slice(a, b - a))],
                                                 ["doc_id", "ids"])

    return ids_and_text(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``."""
    return encoded.withColumn("decoded", decode_column(F.col(ids), path))


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts are encoded, the
    ids decoded, and both digested (the ids decimal, joined by commas) slice by
    slice in one pass, so no ids of a whole table travel between processes."""
    def sha(values: pa.Array) -> pa.Array:
        _, at, data = values.cast(pa.large_binary()).buffers()
        at, data = np.frombuffer(at, np.int64)[values.offset:].tolist(), memoryview(data or b"")
        return pa.array([sha256(data[at[i]:at[i + 1]]).hexdigest() for i in range(len(values))], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for a, b in row_ranges(batch["text"]):
                ids = enc.encode(batch["text"].slice(a, b - a))
                decimal = pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), pc.list_value_length(ids).cast(pa.int64()),
                     sha(pc.binary_join(decimal, ",")), sha(enc.decode(ids))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            release()

    return ids_and_text(docs, doc_id, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
