"""Best and second-best catalog match of every legacy row (E11, E12), exact
also where a block is hot: a default launch date must not make all pairs.

Blocks of at most ``HOT_PAIRS`` pairs are scored whole. A larger block is cut,
on both sides, into cells of up to ``CELL`` neighbours in (subclass, name)
order, and each cell of the new catalog carries a summary: a bit set of its
tokens, the most of every character in one text, shortest and longest text,
and its price range. ``GROUP`` cells that follow each other have a summary too.

1. Bounds: a legacy row and a summary give a score that no row of that cell, or
   group, can exceed, from shared token lengths, text lengths, characters and
   price. They are taken for all groups, and for the cells of some groups only.
2. Seeds: of the ``SEED_GROUPS`` groups of highest bounds the ``SEEDS`` cells of
   highest bounds are scored first; the second best score found there is the
   row's floor.
3. Rest: a group's cells are bounded, and a pair of cells is read again, only if
   a bound reaches its row's floor. The cells of a legacy cell are taken by
   descending bound, and floors rise with what is found.

Inside two cells the same bound is taken pair by pair, and pairs are scored in
bound order until the second best can't be beaten. Bounds are never below a
score, and equal ones go on, so ties still fall to the smaller ``n_pos``.

Cells come from a range partitioning, so no task sees a block; pairs of cells
are joined on a grid whose squares hold at most ``SIDE`` cells a side.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions.numeric import to_double
from ledgerlark.functions.similarity import token_set_ratio
from ledgerlark.session import cut_lineage

# the workers need neither the package installed nor the driver's sys.path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT_PAIRS = 4096       # pairs of a block that are scored without bounds
CELL = 128             # rows of a cell
SIDE = 32              # cells a side of a grid square
RUN = 512              # pairs of cells bounded at a time
GROUP = 32             # cells of a group
SEED_GROUPS = 2        # groups whose cells are bounded first for each legacy cell
SEEDS = 2              # cells scored first for each legacy cell
BITS = 2048            # of a cell's token set; two tokens on one bit only raise a bound
SLACK = 1e-9           # above any rounding of the bounds' arithmetic

BLOCK = ["_d", "_m", "_dept"]
ROW_LISTS = "pos array<long>, id array<string>, name array<string>, sub array<string>, price array<double>"
CELL_SCHEMA = ("_d string, _m string, _dept string, cell long, " + ROW_LISTS
               + ", name_bits binary, name_most array<int>, name_len array<int>"
               + ", sub_bits binary, sub_most array<int>, sub_len array<int>, price_range array<double>")
SUMMARY = ["name_bits", "name_most", "name_len", "sub_bits", "sub_most", "sub_len", "price_range"]
FOUND_SCHEMA = ("l_cell long, l_idx int, l_pos long, product_id string, new_product_id string, n_pos long, "
                "name_sim double, score double, tried long")

_CHARS = np.array([32, *range(48, 58), *range(97, 123)])     # all that a normalised text holds


class Texts:
    """Tokens, lengths and characters of normalised texts, repeats left out as
    the token-set ratio does."""

    def __init__(self, texts):
        place = {}                               # a text that occurs again is looked at once
        self.kind = np.array([place.setdefault(t or "", len(place)) for t in texts], dtype=np.int64)
        tokens = [sorted(set(t.split())) for t in place]
        joined = [" ".join(t).encode() for t in tokens]
        length = np.array([len(j) for j in joined], dtype=np.int64)
        chars = np.array([np.bincount(np.frombuffer(j, dtype=np.uint8), minlength=123)[_CHARS] for j in joined],
                         dtype=np.int64).reshape(len(joined), len(_CHARS))
        bits = [np.array([zlib.crc32(t.encode()) % BITS for t in ts], dtype=np.int64) for ts in tokens]
        sizes = [np.array([len(t) + 1 for t in ts], dtype=np.int64) for ts in tokens]
        self.tokens, self.bits, self.sizes = ([x[i] for i in self.kind] for x in (tokens, bits, sizes))
        self.length, self.chars = length[self.kind], chars[self.kind]

    def take(self, rows) -> Texts:
        part = Texts([])
        part.tokens, part.bits, part.sizes = ([x[i] for i in rows] for x in (self.tokens, self.bits, self.sizes))
        part.kind, part.length, part.chars = self.kind[rows], self.length[rows], self.chars[rows]
        return part

    def distinct(self) -> tuple[Texts, np.ndarray]:
        """Each text once, and which of them every row has."""
        _, first, which = np.unique(self.kind, return_index=True, return_inverse=True)
        if len(first) == len(which):
            return self, np.arange(len(which))
        return self.take(first), which

    def summary(self) -> tuple[bytes, list[int], list[int]]:
        on = np.zeros(BITS, dtype=np.uint8)
        for b in self.bits:
            on[b] = 1
        return (np.packbits(on).tobytes(), self.chars.max(axis=0).tolist(),
                [int(self.length.min()), int(self.length.max())])


def _rounded_up(ratio: np.ndarray) -> np.ndarray:
    """The most that a rounded percentage can be, as a fraction."""
    return np.minimum(np.floor(100.0 * ratio + 0.5 + SLACK), 100.0) / 100.0


def _over(part, whole):
    return np.where(whole > 0, part / np.maximum(whole, 1), 0.0)


def cell_bounds(a: Texts, bits: list[bytes], most, length) -> np.ndarray:
    """Per text of ``a`` (rows) and summarised cell (columns), no lower than the
    text's token-set ratio with any text of the cell."""
    a, which = a.distinct()
    on = np.unpackbits(np.frombuffer(b"".join(bits), dtype=np.uint8).reshape(len(bits), -1), axis=1)
    lo, hi = np.asarray(length, dtype=np.int64).reshape(-1, 2).T
    shared = np.array([on[:, b] @ s if len(b) else np.zeros(len(on)) for b, s in zip(a.bits, a.sizes)], dtype=np.int64) - 1
    shared = np.clip(shared, 0, hi)
    most = np.asarray(most, dtype=np.int64).reshape(len(bits), -1)
    chars = np.array([np.minimum(row, most).sum(axis=1) for row in a.chars]).reshape(shared.shape)
    other = np.clip(chars, lo, hi)           # the length at which the ratio of both is highest
    own = a.length[:, None]
    best = np.maximum(np.maximum(_over(2.0 * shared, shared + own), _over(2.0 * shared, shared + np.maximum(shared, lo))),
                      _over(2.0 * np.minimum(chars, other), own + other))
    return np.where((own > 0) & (hi > 0), _rounded_up(best), 0.0)[which]


def cell_bound(a: Texts, bits: bytes, most, length) -> np.ndarray:
    """:func:`cell_bounds` of one cell."""
    return cell_bounds(a, [bits], [most], [length])[:, 0]


def pair_bounds(a: Texts, b: Texts) -> np.ndarray:
    """No lower than the token-set ratio of any text of ``a`` (rows) with any of
    ``b`` (columns)."""
    (a, rows), (b, columns) = a.distinct(), b.distinct()
    number = {t: i for i, t in enumerate({t for ts in (*a.tokens, *b.tokens) for t in ts})}
    held = [np.zeros((len(x.tokens), max(len(number), 1))) for x in (a, b)]
    for x, m in zip((a, b), held):
        for i, ts in enumerate(x.tokens):
            m[i, [number[t] for t in ts]] = 1
    size = np.array([len(t) + 1 for t in number] or [0], dtype=float)
    shared = np.maximum((held[0] * size) @ held[1].T - 1, 0)
    la, lb = a.length[:, None], b.length[None, :]
    chars = np.array([np.minimum(row, b.chars).sum(axis=1) for row in a.chars]).reshape(shared.shape)
    best = np.maximum(np.maximum(_over(2.0 * shared, shared + la), _over(2.0 * shared, shared + lb)),
                      _over(2.0 * chars, la + lb))
    return np.where((la > 0) & (lb > 0), _rounded_up(best), 0.0)[np.ix_(rows, columns)]


def price_closeness(base: np.ndarray, price: np.ndarray) -> np.ndarray:
    """E7 in numbers, NaN for none: the same operations in the same order."""
    with np.errstate(divide="ignore", invalid="ignore"):
        v = np.maximum(0.0, 1.0 - np.abs(price - base) / base)
    return np.where((base > 0) & ~np.isnan(price), v, 0.0)


def _numbers(values) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], dtype=float)


def _cells(batches, size: int):
    """Rows in block order -> cells, each of one block. A block's first cell has
    a multiple of ``GROUP`` as its number, so that no group is of two blocks."""
    prefix, n, rows = TaskContext.get().partitionId() << 33, 0, []

    def cell():
        keys = rows[0][:3]
        pos, ids, names, subs, prices = (list(x) for x in zip(*(r[3:] for r in rows)))
        known = [p for p in (None if pd.isna(p) else float(p) for p in prices) if p is not None]
        return (*keys, prefix + n, pos, ids, names, subs, [None if pd.isna(p) else float(p) for p in prices],
                *Texts(names).summary(), *Texts(subs).summary(), [min(known), max(known)] if known else [])

    columns = [c.split()[0] for c in CELL_SCHEMA.split(", ")]
    for batch in batches:
        done = []
        for row in batch.itertuples(index=False, name=None):
            if rows and (len(rows) == size or rows[0][:3] != row[:3]):
                done.append(cell())
                n = n + 1 if rows[0][:3] == row[:3] else (n // GROUP + 1) * GROUP
                rows = []
            rows.append(row)
        if done:
            yield pd.DataFrame(done, columns=columns)
    if rows:
        yield pd.DataFrame([cell()], columns=columns)


def cells(rows: DataFrame, size: int) -> DataFrame:
    """``rows``: block, pos, id, name, sub, price."""
    ordered = (rows.select(*BLOCK, "pos", "id", "name", "sub", "price")
               .repartitionByRange(*BLOCK, "sub", "name", "pos").sortWithinPartitions(*BLOCK, "sub", "name", "pos"))
    return ordered.mapInPandas(lambda batches: _cells(batches, size), CELL_SCHEMA)


def _group(rows: pd.DataFrame) -> pd.DataFrame:
    """The summary of all rows of a group's cells."""
    own = {}
    for t in ("name", "sub"):
        length = np.array(list(rows[f"{t}_len"]))
        own[f"{t}_bits"] = np.bitwise_or.reduce([np.frombuffer(b, dtype=np.uint8) for b in rows[f"{t}_bits"]]).tobytes()
        own[f"{t}_most"] = np.array(list(rows[f"{t}_most"])).max(axis=0).tolist()
        own[f"{t}_len"] = [int(length[:, 0].min()), int(length[:, 1].max())]
    known = [v for r in rows.price_range for v in r]
    own["price_range"] = [min(known), max(known)] if known else []
    return pd.DataFrame([{**rows.iloc[0][[*BLOCK, "n_group"]].to_dict(), **own}])


def _bounds(batches, weights):
    """Rows come in runs of one legacy cell, whose texts are looked at once a
    run, against all cells of the run in one go. Where floors are given, cells
    that no row can need are left out."""
    w_name, w_sub, w_price = weights
    for batch in batches:
        out = []
        for at in range(0, len(batch), RUN):
            for l_cell, run in batch.iloc[at:at + RUN].groupby("l_cell", sort=False):
                own = run.iloc[0]
                name = cell_bounds(Texts(own.l_name), list(run.name_bits), list(run.name_most), list(run.name_len))
                sub = cell_bounds(Texts(own.l_sub), list(run.sub_bits), list(run.sub_most), list(run.sub_len))
                base, price = _numbers(own.l_price)[:, None], np.zeros(name.shape)
                priced = np.flatnonzero([len(r) > 0 for r in run.price_range])
                if len(priced):
                    lo, hi = np.array([run.price_range.iloc[j] for j in priced], dtype=float).T
                    price[:, priced] = price_closeness(base, np.clip(base, lo, hi))
                bound = w_name * name + w_sub * sub + w_price * price + SLACK
                floor = -1.0 if own.floors is None else np.fmax(_numbers(own.floors), -1.0)
                out += [(l_cell, n, c.tolist(), float(c.mean())) for n, c in zip(run.n_cell, bound.T) if (c >= floor).any()]
        yield pd.DataFrame(out, columns=["l_cell", "n_cell", "bound", "mean_bound"])


def top_two(names, subs, bases, new_names, new_subs, prices, places, weights, floors=None, rows=None, texts=None):
    """For each legacy row (of ``rows``, if given) the best two new rows of one
    cell that reach its floor, as (legacy index, new index, name similarity,
    score), and how many pairs were scored. ``texts``: the four lists as
    ``Texts``, where they are at hand."""
    w_name, w_sub, w_price = weights
    rows = np.arange(len(names)) if rows is None else np.asarray(rows, dtype=np.int64)
    bases, prices = _numbers(bases), _numbers(prices)
    price = price_closeness(bases[:, None], prices[None, :])
    name_of, sub_of, new_name_of, new_sub_of = texts or [Texts(x) for x in (names, subs, new_names, new_subs)]
    bound = np.zeros(price.shape)
    bound[rows] = (w_name * pair_bounds(name_of.take(rows), new_name_of) + w_sub * pair_bounds(sub_of.take(rows), new_sub_of)
                   + w_price * price[rows] + SLACK)
    found, tried, known = [], 0, {}

    def ratio(a, b):
        key = (a or "", b or "")
        if key not in known:
            known[key] = token_set_ratio(*key) / 100.0
        return known[key]

    for i in rows.tolist():
        floor = -1.0 if floors is None or floors[i] is None or np.isnan(floors[i]) else floors[i]
        best = []                                # (-score, place, new index, name similarity)
        reach = np.flatnonzero(bound[i] >= floor)
        for j in reach[np.argsort(-bound[i, reach], kind="stable")]:
            if len(best) == 2 and bound[i, j] < -best[1][0]:
                break
            name = ratio(names[i], new_names[j])
            score = w_name * name + w_sub * ratio(subs[i], new_subs[j]) + w_price * float(price[i, j])
            tried += 1
            best = sorted([*best, (-score, places[j], int(j), name)])[:2]
        found += [(i, j, name, -minus) for minus, _, j, name in best]
    return found, tried


def _scores(batches, weights):
    """The best two of each legacy row among the cells given. The cells of a
    legacy cell come one after the other, those of high bounds first, and a row
    whose second best so far is above a later cell's bound leaves that out."""
    now, texts, floor, best, tried, who = None, None, None, {}, 0, None

    def found():
        out = []
        for i, tops in best.items():
            for minus, place, new_id, name in tops:
                out.append((now, i, who[0][i], who[1][i], new_id, place, name, -minus, 0 if out else tried))
        return out

    columns = [c.split()[0] for c in FOUND_SCHEMA.split(", ")]
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            if r.l_cell != now:
                out += found()
                now, texts, best, tried, who = r.l_cell, [Texts(r.l_name), Texts(r.l_sub)], {}, 0, (r.l_pos, r.l_id)
                floor = np.full(len(r.l_pos), -1.0)
            if r.floors is not None:
                floor = np.fmax(floor, _numbers(r.floors))
            rows = np.flatnonzero(np.asarray(r.bound) >= floor)
            if not len(rows):
                continue
            got, n = top_two(r.l_name, r.l_sub, r.l_price, r.name, r.sub, r.price, r.pos, weights, floor, rows,
                             texts + [Texts(r.name), Texts(r.sub)])
            tried += n
            for i, j, name, score in got:
                best[i] = sorted([*best.get(i, []), (-score, r.pos[j], r.id[j], name)], key=lambda t: t[:2])[:2]
                if len(best[i]) == 2:
                    floor[i] = max(floor[i], -best[i][1][0])
        yield pd.DataFrame(out, columns=columns)
    yield pd.DataFrame(found(), columns=columns)


def _grid(left: DataFrame, right: DataFrame) -> DataFrame:
    """All pairs of cells of a block, each square of the grid one join key."""
    def squares(c, name):
        return c.groupBy(*BLOCK).agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("long").alias(name))
    n = squares(left, "_ln").join(squares(right, "_rn"), BLOCK)

    def placed(c, ident, own, count, others, other_count):
        return (c.join(n, BLOCK).withColumn(own, F.pmod(F.xxhash64(ident), F.col(count)))
                .withColumn(others, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_count) - 1)))
                .drop("_ln", "_rn"))
    return (placed(left, "l_cell", "_ls", "_ln", "_rs", "_rn")
            .join(placed(right, "n_cell", "_rs", "_rn", "_ls", "_ln"), [*BLOCK, "_ls", "_rs"]))


def hot_best(legacy: DataFrame, new: DataFrame, weights, size: int = CELL) -> DataFrame:
    """The best two of each legacy row among a few candidates of every cell that
    can hold them (``FOUND_SCHEMA``). Both sides: block, pos, id, name, sub, price."""
    lc = cut_lineage(cells(legacy, size), "legacy_cells")
    nc = cut_lineage(cells(new, size), "new_cells").withColumnRenamed("cell", "n_cell")
    L = lc.select(*BLOCK, F.col("cell").alias("l_cell"),
                  *[F.col(c).alias(f"l_{c}") for c in ("pos", "id", "name", "sub", "price")])
    nc = nc.withColumn("n_group", F.floor(F.col("n_cell") / GROUP))
    texts = L.select("l_cell", "l_name", "l_sub", "l_price")
    # a few small rows are much work here, so their number of tasks is set: left to
    # the join, or to the bytes, it may be one
    tasks = int(legacy.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64("l_cell")      # of no shuffle before, which would take its place

    def bounded(pairs: DataFrame, name: str) -> DataFrame:
        return cut_lineage(
            pairs.select("l_cell", "n_cell", "l_name", "l_sub", "l_price", *SUMMARY, "floors")
            .repartition(tasks, key).sortWithinPartitions("l_cell")
            .mapInPandas(lambda b: _bounds(b, weights), "l_cell long, n_cell long, bound array<double>, mean_bound double"),
            name)

    def first_of(bounds: DataFrame, ident: str, n: int) -> DataFrame:
        order = Window.partitionBy("l_cell").orderBy(F.desc("mean_bound"), ident)
        return bounds.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")

    def cells_of(which: DataFrame) -> DataFrame:
        return which.join(nc.select("n_group", "n_cell", *SUMMARY), "n_group").join(texts, "l_cell")

    no_floors = F.lit(None).cast("array<double>")
    kinds = {f.split()[0]: f for f in CELL_SCHEMA.split(", ")}
    groups = cut_lineage(
        nc.select(*BLOCK, "n_group", *SUMMARY).groupBy(*BLOCK, "n_group")
        .applyInPandas(_group, ", ".join([*(kinds[c] for c in BLOCK), "n_group long", *(kinds[c] for c in SUMMARY)])),
        "new_groups")
    group_bounds = bounded(_grid(L.select(*BLOCK, *texts.columns), groups.withColumnRenamed("n_group", "n_cell"))
                           .withColumn("floors", no_floors), "group_bounds").withColumnRenamed("n_cell", "n_group")
    seed_groups = cut_lineage(first_of(group_bounds, "n_group", SEED_GROUPS).select("l_cell", "n_group"), "seed_groups")
    bounds = bounded(cells_of(seed_groups).withColumn("floors", no_floors), "cell_bounds")
    seeds = first_of(bounds, "n_cell", SEEDS)

    def scored(which: DataFrame, name: str) -> DataFrame:
        rows = which.join(L.drop(*BLOCK), "l_cell").join(nc.select("n_cell", "pos", "id", "name", "sub", "price"), "n_cell")
        rows = rows.repartition(tasks, key).sortWithinPartitions("l_cell", F.desc("mean_bound"), "n_cell")
        return cut_lineage(rows.mapInPandas(lambda b: _scores(b, weights), FOUND_SCHEMA), name)

    first = scored(seeds.withColumn("floors", F.lit(None).cast("array<double>")), "seed_scores")
    second = ranked(first, ["l_cell", "l_idx"]).where(F.col("_rn") == 2)
    # at most a cell's rows in a map
    found = second.groupBy("l_cell").agg(F.map_from_entries(F.collect_list(F.struct("l_idx", "score"))).alias("_f"))
    floors = cut_lineage(texts.join(found, "l_cell", "left").select("l_cell", F.transform(
        "l_name", lambda _, i: F.when(F.col("_f").isNotNull(), F.try_element_at(F.col("_f"), i))).alias("floors")), "floors")

    def needed(which: DataFrame) -> DataFrame:
        return which.join(floors, "l_cell").where(
            F.exists(F.arrays_zip("bound", "floors"), lambda p: p["bound"] >= F.coalesce(p["floors"], F.lit(-1.0))))

    other_groups = needed(group_bounds.join(seed_groups, ["l_cell", "n_group"], "left_anti"))
    others = bounded(cells_of(other_groups.select("l_cell", "n_group", "floors")), "rest_bounds")
    rest = needed(bounds.join(seeds.select("l_cell", "n_cell"), ["l_cell", "n_cell"], "left_anti").unionByName(others))
    rest = rest.select("l_cell", "n_cell", "bound", "mean_bound", "floors")
    return first.unionByName(scored(rest, "rest_scores"))


def ranked(found: DataFrame, by: list[str]) -> DataFrame:
    """Best two (``_rn``) by score, ties to the smaller place; Spark keeps two
    rows a key before it shuffles."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "n_pos")
    return found.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= 2)


def numbers(rows: DataFrame, pos: str, ident: str, name: str, sub: str, price: str) -> DataFrame:
    return rows.select(*BLOCK, F.col(pos).cast("long").alias("pos"), F.col(ident).alias("id"), F.col(name).alias("name"),
                       F.col(sub).alias("sub"), to_double(F.col(price), strip_currency=False).alias("price"))
