"""Fuzzy name similarity (E4-E6) as one Arrow-batched pandas UDF.

Only candidate pairs that survived blocking reach this UDF, so the Python
work is proportional to the scored pairs, never to all pairs.

Semantics (0-100 integer scores, divided by 100 by the caller in Spark):

* ``ratio(a, b)``: 100 when equal; 0 when either is empty; otherwise
  ``round_half_even(100 * 2*LCS(a, b) / (len a + len b))`` -- the indel
  (insert/delete only) similarity, not substitution-cost-1 Levenshtein.
* ``token_set_ratio``: over token sets A, B with ``i`` = sorted intersection,
  ``x = i + sorted(A-B)``, ``y = i + sorted(B-A)`` (space-joined, stripped):
  ``max(ratio(i, x), ratio(i, y), ratio(x, y))``; 0 when either side has no
  tokens.
* ``partial_ratio``: best ``ratio`` of the shorter string against every stretch
  of the longer one; the LCS lengths of all stretches come from one pass (combing
  of strands, Tiskin 2008: the LCS of a with b[i:j] is j - i less the strands that
  enter at or after i and leave before j).

LCS length uses the bit-parallel recurrence (Hyyro 2004), so a pair costs
O(len(a)) big-integer operations instead of an O(len(a)*len(b)) table.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code with the UDFs (pickled by value), so Python workers
# need neither the package installed nor the driver's sys.path.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

METHODS = ("token_set_ratio", "partial_ratio", "edit_distance", "exact_token_overlap")


def lcs_length(a: str, b: str) -> int:
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for j, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    total = len(a) + len(b)
    return int(round(100.0 * ((2 * lcs_length(a, b)) / total)))


def token_set_ratio(a: str, b: str) -> int:
    ta, tb = set(a.split()), set(b.split())
    if not a.strip() or not b.strip():
        return 0
    inter, x, y = (" ".join(sorted(ts)) for ts in (ta & tb, ta - tb, tb - ta))
    if not inter:
        return ratio(x, y)
    if not x or not y:                   # one side is the intersection itself
        return 100
    # the intersection and a space begin both: they are in every LCS, which is
    # searched for the rest alone
    n, nx, ny = len(inter), len(inter) + 1 + len(x), len(inter) + 1 + len(y)
    return max(int(round(100.0 * ((2 * lcs) / total))) for lcs, total in (
        (n, n + nx), (n, n + ny), (n + 1 + lcs_length(x, y), nx + ny)))


def partial_ratio(a: str, b: str) -> int:
    """Best ratio of the shorter string with any stretch of the longer one
    that is as long, or shorter where it begins or ends the longer one; of
    strings of one length either is taken as the shorter."""
    if a == b:
        return 100
    if not a or not b:
        return 0
    sides = [(a, b)] if len(a) <= len(b) else []
    sides += [(b, a)] if len(b) <= len(a) else []
    return max(int(round(100.0 * (2 * lcs) / (len(short) + size)))
               for short, long_ in sides for size, lcs in stretch_lcs(short, long_))


def top_to_bottom(a: str, b: str) -> list[int]:
    """For each place of b, the place where the strand that leaves below it came
    in above; -1 for a strand from the side."""
    down = list(range(len(b)))
    for i, ch in enumerate(a):
        across = -1 - i                     # strands from the side are older than all from above
        for j, other in enumerate(b):
            # strands part at a match, and two that have met before don't cross again
            if ch == other or across > down[j]:
                across, down[j] = down[j], across
    return down


def stretch_lcs(a: str, b: str):
    """(length, LCS with a) of every stretch of b that is as long as a, or
    shorter where it begins or ends b; b is not shorter than a."""
    n, m = len(a), len(b)
    came_from = top_to_bottom(a, b)
    leaves = {start: end for end, start in enumerate(came_from) if start >= 0}
    inside = 0                              # strands that come in and leave within [lo, hi)
    for hi in range(1, m + n):
        lo = hi - n
        if hi <= m and came_from[hi - 1] >= max(lo - 1, 0):
            inside += 1
        if lo > 0 and leaves.get(lo - 1, m) < min(hi, m):
            inside -= 1
        size = min(hi, m) - max(lo, 0)
        yield size, size - inside


_SCORERS = {
    "token_set_ratio": token_set_ratio,
    "partial_ratio": partial_ratio,
    "edit_distance": ratio,
}


def score_text(a: str | None, b: str | None, method: str = "token_set_ratio") -> int:
    """Driver-free scalar version, used by the UDF and by tests."""
    return _SCORERS[method](a or "", b or "")


def _scored(fn, a: pd.Series, b: pd.Series) -> pd.Series:
    """Each distinct pair of strings of a batch is scored once."""
    pairs = [(x or "", y or "") for x, y in zip(a, b)]
    known = {p: fn(*p) for p in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype="int32")


def _make_udf(method: str):
    fn = _SCORERS[method]

    @F.pandas_udf(T.IntegerType())
    def _score(a: pd.Series, b: pd.Series) -> pd.Series:
        return _scored(fn, a, b)

    return _score


def _make_pair_udf(method: str):
    fn = _SCORERS[method]

    @F.pandas_udf(T.StructType([T.StructField("first", T.IntegerType()),
                                T.StructField("second", T.IntegerType())]))
    def _score2(a1: pd.Series, b1: pd.Series, a2: pd.Series, b2: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "first": _scored(fn, a1, b1),
            "second": _scored(fn, a2, b2),
        })

    return _score2


def similarity_pair(a1: Column, b1: Column, a2: Column, b2: Column,
                    method: str = "token_set_ratio") -> Column:
    """Two similarities in one Arrow round trip: a struct (first, second) of
    0-100 integer scores. The caller divides by 100."""
    key = ("pair", method)
    if key not in _UDFS:
        _UDFS[key] = _make_pair_udf(method)
    return _UDFS[key](a1, b1, a2, b2)


_UDFS: dict = {}


def similarity(a_norm: Column, b_norm: Column, method: str = "token_set_ratio") -> Column:
    """Similarity in [0, 1] between two normalised strings.

    ``exact_token_overlap`` is fully native; the three fuzzy methods go through
    one vectorised UDF returning the integer score, and the division by 100
    happens JVM-side.
    """
    if method not in METHODS:
        raise ValueError(f"unknown similarity method {method!r}")
    if method == "exact_token_overlap":
        from ledgerlark.functions.text import token_overlap_similarity
        return token_overlap_similarity(a_norm, b_norm)
    if method not in _UDFS:
        _UDFS[method] = _make_udf(method)
    return _UDFS[method](a_norm, b_norm).cast("double") / F.lit(100.0)
