"""Texts as pieces between which no byte-level token reaches.

A piece is a run of letters with the space before it, a line end, punctuation:
what the byte-level word pattern never matches across. What a model needs of a
text is then a sum over its pieces, and is worked out once for each distinct
piece a worker meets. Texts are cut in numpy; those with other white space than
single spaces and line ends, or with special tokens, by pattern."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe import CHUNK
from .common import held, row_ranges

#: n-gram lengths and their multipliers (odd, fixed), as of ``hashed_text``.
GRAMS = ((2, 0x9E3779B1), (4, 0x85EBCA6B))
#: Distinct pieces a worker remembers.
REMEMBERED = 300_000
#: Positions hashed at a time.
CHUNK_BYTES = 1 << 20
#: New pieces encoded as one text, a line each.
LINES = 256
#: Score sums are whole numbers of this part, so they don't depend on order.
FRACTION = 1 << 24

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LATIN = np.zeros(256, bool)       # second byte of a Latin-1 letter
_LATIN[128:192] = True
_LATIN[[0x97, 0xB7]] = False
_PUNCTUATION = np.zeros(256, bool)
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _PUNCTUATION[_a:_b] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[[0, 9, 11, 12, 13]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _wide_space(raw: np.ndarray) -> np.ndarray:
    """Where a white space character beyond ASCII begins."""
    at = np.flatnonzero(_LEAD[raw])
    padded = np.concatenate([raw, np.zeros(2, np.uint8)])
    a, b, c = raw[at], padded[at + 1], padded[at + 2]
    return at[((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
              | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
              | ((a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
              | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
              | ((a == 0xE3) & (b == 0x80) & (c == 0x80))]


def cut(texts: pa.Array, special: list[str]) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(rows, pieces, ends): the pieces of some texts (strings, no nulls), those
    of the i-th row being pieces[ends[i]:ends[i + 1]]."""
    big = texts.cast(pa.large_binary())
    _, offsets, data = big.buffers()
    at = np.frombuffer(offsets, np.int64)[big.offset:big.offset + len(big) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    gap = (raw == 32) | (raw == 10)
    strange = [np.flatnonzero(_CONTROL[raw]), _wide_space(raw), np.flatnonzero(gap[:-2] & gap[1:-1] & gap[2:])]
    odd = np.zeros(len(texts) + 1, bool)
    odd[np.searchsorted(at, np.concatenate(strange), side="right") - 1] = True
    odd = odd[:-1]
    long = np.flatnonzero(np.diff(at) > 1)
    odd[long] |= gap[at[long + 1] - 1] & gap[at[long + 1] - 2]           # two at the end
    for s in special:
        odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    start = np.zeros(len(raw) + 1, bool)
    start[at] = True
    start[:-1] |= gap
    start[1:] |= raw == 10
    ends = _LETTER[raw]
    ends[1:] |= _LATIN[raw[1:]] & (raw[:-1] == 0xC3)
    start[1:-1] |= ends[:-1] & _PUNCTUATION[raw[1:]]
    bounds = np.flatnonzero(start)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()),
                                                                        pa.py_buffer(raw)])
    first = np.searchsorted(bounds, at)
    if not odd.any():
        yield np.arange(len(texts)), pieces, first
        return
    rows = np.flatnonzero(~odd)
    size = np.diff(first)
    kept = pieces.filter(pa.array(np.repeat(~odd, size)))
    yield rows, kept, np.concatenate([[0], np.cumsum(size[rows])])
    rows = np.flatnonzero(odd)
    split = re.compile(f"({'|'.join(map(re.escape, special))})") if special else None
    lists = [[c.encode() for i, part in enumerate(split.split(t) if split else [t])
              for c in ([part] if i % 2 else CHUNK.findall(part))] for t in texts.take(pa.array(rows)).to_pylist()]
    yield rows, pa.array(list(chain.from_iterable(lists)), pa.large_binary()), np.concatenate([[0], np.cumsum([len(x) for x in lists])])


def grams(pieces: pa.Array, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(piece, bucket) of every n-gram within a piece, ASCII letters
    lower-cased; a piece shorter than the n-gram is one n-gram."""
    _, offsets, data = pieces.buffers()
    at = np.frombuffer(offsets, np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    for a in range(0, len(raw), CHUNK_BYTES):
        b = min(a + CHUNK_BYTES, len(raw))
        here = np.arange(a, b)
        piece = np.searchsorted(at, here, side="right") - 1
        left, begins = at[piece + 1] - here, at[piece] == here
        part = _LOWER[np.concatenate([raw[a:b + 3], np.zeros(max(0, b + 3 - len(raw)), np.uint8)])]
        for n, mult in GRAMS:
            h = np.full(b - a, n, np.uint32)
            for k in range(n):
                h = np.where(k < left, h * np.uint32(257) + part[k:k + b - a], h)
            h *= np.uint32(mult)
            pick = (left >= n) | begins
            yield piece[pick], ((h ^ (h >> np.uint32(15))) & np.uint32(dim - 1))[pick]


def frequencies(texts: pa.Array, special: list[str], dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text and their relative frequencies."""
    out: list = [None] * len(texts)
    for rows, pieces, ends in cut(texts, special):
        got = list(grams(pieces, dim))
        of = np.repeat(np.arange(len(rows)), np.diff(ends))
        both = np.concatenate([of[p] * dim + b for p, b in got]) if got else np.zeros(0, np.int64)
        pairs, n = np.unique(both, return_counts=True)
        edge = np.searchsorted(pairs, np.arange(len(rows) + 1) * dim)
        for i, r in enumerate(rows.tolist()):
            own = n[edge[i]:edge[i + 1]]
            out[r] = ((pairs[edge[i]:edge[i + 1]] % dim).astype(np.int32), (own / max(1, own.sum())).astype(np.float32))
    return out


class Sums:
    """Tokens and score sums of texts, from what each distinct piece adds."""

    def __init__(self, tokenizer: str, weights: np.ndarray):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = special_tokens(self.library)
        line_end = self.library.encode("\n", add_special_tokens=False).ids
        # None: lines can't be told apart by a token of their own
        self.line_end = line_end[0] if len(line_end) == 1 and not any("\n" in s for s in self.special) else None
        self.weights = weights
        self.forget()

    def forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.values = np.zeros((0, 2 + self.weights.shape[1]), np.int64)   # tokens, n-grams, scores
        self.met = np.zeros(0, np.int64)                                    # ranges of texts with the piece

    def forget_rare(self) -> None:
        """All pieces but those of several ranges, half of what is remembered at most."""
        least = 2
        while (self.met >= least).sum() > REMEMBERED // 2:
            least += 1
        kept = self.met >= least
        new = (np.cumsum(kept) - 1).tolist()
        self.at = {p: new[i] for (p, i), k in zip(self.at.items(), kept[np.fromiter(self.at.values(), np.int64)].tolist()) if k}
        self.values, self.met = self.values[kept], np.zeros(len(self.at), np.int64)

    def _encoded(self, texts: list[str]) -> list:
        return self.library.encode_batch_fast(texts, add_special_tokens=False)

    def tokens(self, new: list[str]) -> np.ndarray:
        """Of each piece. A line end is a token of its own between pieces that
        neither hold one nor end in white space, so those are encoded as the
        lines of a few texts, not one by one."""
        out = np.zeros(len(new), np.int64)
        special = set(self.special)
        alone = np.array([self.line_end is None or "\n" in p or p[-1:].isspace() or p in special for p in new], bool)
        single, lines = np.flatnonzero(alone), np.flatnonzero(~alone)
        out[single] = [len(e) for e in self._encoded([new[i] for i in single.tolist()])]
        texts = ["\n".join([new[i] for i in lines[a:a + LINES].tolist()]) for a in range(0, len(lines), LINES)]
        if texts:
            ids = np.concatenate([np.array([*e.ids, self.line_end]) for e in self._encoded(texts)])
            out[lines] = np.diff(np.flatnonzero(ids == self.line_end), prepend=-1) - 1
        return out

    def _learn(self, new: list[bytes]) -> None:
        out = np.zeros((len(new), self.values.shape[1]))
        out[:, 0] = self.tokens([p.decode() for p in new])
        for piece, bucket in grams(pa.array(new, pa.large_binary()), len(self.weights)):
            out[:, 1] += np.bincount(piece, minlength=len(new))
            for j in range(self.weights.shape[1]):
                out[:, 2 + j] += np.bincount(piece, self.weights[bucket, j] * FRACTION, len(new))
        self.at.update(zip(new, range(len(self.values), len(self.values) + len(new))))
        self.values = np.concatenate([self.values, np.rint(out).astype(np.int64)])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, mean scores: text x output; zeros for an empty text)."""
        out = np.zeros((len(texts), self.values.shape[1]), np.int64)
        for rows, pieces, ends in cut(texts, self.special):
            if len(self.at) > REMEMBERED:
                self.forget_rare()
            found = pieces.dictionary_encode()
            distinct = found.dictionary.to_pylist()
            self._learn([p for p in distinct if p not in self.at])
            number = np.fromiter(map(self.at.__getitem__, distinct), np.int64, len(distinct))
            self.met[number] += 1
            index, total = found.indices.to_numpy(), np.zeros(len(pieces) + 1, np.int64)
            for j in range(out.shape[1]):
                np.cumsum(self.values[number, j][index], out=total[1:])   # of the few distinct, then of all
                out[rows, j] = total[ends[1:]] - total[ends[:-1]]
        return out[:, 0], out[:, 2:] / (FRACTION * np.maximum(1, out[:, 1:2]))


def special_tokens(library) -> list[str]:
    """Longest first."""
    return sorted((t.content for t in library.get_added_tokens_decoder().values()), key=len, reverse=True)


def each_range(texts: pa.Array, run: Callable[[pa.Array], list[np.ndarray]]) -> list[np.ndarray]:
    """``run`` over a few megabytes of texts at a time, its arrays put
    together."""
    got = [run(texts.slice(a, b - a)) for a, b in row_ranges(texts)] or [run(texts)]
    return [np.concatenate(x) for x in zip(*got)]


def sums(tokenizer: str, key: str, weights: np.ndarray) -> Sums:
    """One a Python worker."""
    return held(("pieces", tokenizer, key), lambda: Sums(tokenizer, weights))
