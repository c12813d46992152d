"""Piece sums: pieces encoded as lines, and what a worker still remembers."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from ledgerlark.llm import pieces


def _sums():
    return pieces.Sums(public_tokenizers.path("byte_bpe_50k.json"), np.ones((1 << 10, 2), np.float32))


def test_pieces_encoded_as_lines_count_as_alone():
    s = _sums()
    new = [" the", "the", "\n", " ", "  ", "\t", " \n", "'s", " 's", "12", " été", " ", "́", "x\n", *s.special]
    new += [f" w{i}" for i in range(3 * pieces.LINES)]
    assert s.line_end is not None
    assert s.tokens(new).tolist() == [len(e) for e in s._encoded(new)]


def test_piece_of_several_ranges_outlives_the_rare_ones(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 40)
    s, learned = _sums(), []
    learn = s._learn
    s._learn = lambda new: (learned.extend(new), learn(new))
    texts = [f"often {' '.join(f'q{i}x{j}' for j in range(15))}" for i in range(12)]
    got = [s.of(pa.array([t]))[0][0] for t in texts]
    assert learned.count(b"often") == 1 and len(s.at) <= 60
    assert got == [len(e) for e in s._encoded(texts)]
