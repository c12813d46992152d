"""Merkle manifest of a dataset: one tree a source, one tree over the sources.

Every row is a leaf, the SHA-256 of its fields. Within a source the leaves
ascend by id; three consecutive nodes become their digest until one node is
left, the source's subroot. The subroots, ordered by source, likewise give the
root. What proves a leaf is its siblings, level by level up to the root.

* **Order.** Rows are dealt out by range of (source, id) and sorted within each
  task; a row's place in its source is its place in its task plus the source's
  rows in the tasks before, one small row a (source, task). A source with a
  third of all rows is spread over its share of the tasks.
* **Levels.** Four levels are built at a time, from groups of 81 neighbours, and
  stored: each leaf and each node four levels up is linked to its parent's place
  by the siblings between the two.
* **Climb.** A recursive query ascends over these parent-linked rows, folding the
  possibly tampered digest of every leaf and appending siblings. The leaves of a
  group share what they meet above it, so they climb in one row, and the siblings
  they append there are held once. The nodes of the upper levels are stored once
  a block of 6,561 leaves, so no key has more leaves than that, however large a
  source is.

Defined results
* a null field is `-`, every other its length in UTF-8 bytes, `:` and its value;
* rows that repeat, also those of one id, are leaves of their own; equal ids
  stand in the order of their digests; null ids stand first and are not
  tampered with; a null source is a source of its own, before all others;
* a leaf that is alone in its source is the subroot, and so with one source the
  subroot is the root; its proof has no siblings (the digest of nothing);
* an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 3
LEVELS = 4                 # built at a time
GROUP = RUN ** LEVELS
BLOCK = GROUP ** 2         # leaves under one stored path
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


# -- digests, as 32 bytes; hashed as their hex text ----------------------------

def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _of_nodes(nodes: Column) -> Column:
    """The digest of concatenated nodes."""
    return _digest(F.lower(F.hex(nodes)).cast("binary"))


def text_of(digest: str) -> Column:
    return F.lower(F.hex(F.col(digest))).alias(digest)


def leaf_digest(fields: Sequence[Column]) -> Column:
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-"))
             for f in (c.cast("string") for c in fields)]
    return _digest(F.concat(*parts).cast("binary"))


def leaves(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", lang: str = "lang",
           n_chars: str = "n_chars", text: str = "text") -> DataFrame:
    """(doc_id, tree, leaf, tampered): ``tree`` stands for the source, null
    first. Tampering deletes line ends where 2 divides the id's CRC-32."""
    rows = docs.select(*[docs[c].cast(t).alias(f) for c, t, f in zip(
        (doc_id, source, lang, n_chars, text), ("long", "string", "string", "long", "string"), FIELDS)])
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    changed = leaf_digest([F.col(c) for c in FIELDS[:-1]] + [F.replace("text", F.lit("\n"), F.lit(""))])
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return rows.select("doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")).alias("tree"), leaf.alias("leaf"),
                       F.when(F.coalesce(hit, F.lit(False)), changed).alias("changed"))


# -- places --------------------------------------------------------------------

def placed(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (a stored table) with ``idx``, the row's place in its group from
    0, and ``n``, the group's rows; no task sees more than its range."""
    keys = [group, *order]
    # rows that agree in everything can still be dealt to several tasks
    dealt = rows.withColumn("_seq", F.monotonically_increasing_id()).repartitionByRange(*keys, "_seq")
    dealt = cut_lineage(dealt.sortWithinPartitions(*keys, "_seq").drop("_seq")
                        .withColumn("_at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("_task", F.shiftright("_at", 33))
    runs = dealt.groupBy(group, "_task").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_task")   # one row a task
    runs = (runs.withColumn("_before", F.sum("_rows").over(before) - F.col("_rows"))
            .withColumn("n", F.sum("_rows").over(Window.partitionBy(group))))
    return (dealt.join(runs, [group, "_task"])
            .withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_task", "_rows", "_first", "_before"))


# -- levels --------------------------------------------------------------------

def _up(level: Column) -> Column:
    """The next level of a group's nodes."""
    n = F.octet_length(level).cast("int")
    made = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / (32 * RUN)).cast("int")),
                       lambda i: _of_nodes(F.substring(level, i * (32 * RUN) + 1, F.lit(32 * RUN))))
    return _concat(made, lambda x: x)


def _concat(parts: Column, of) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, of(x)))


def grouped(nodes: DataFrame, carried: Sequence[str], name: str) -> DataFrame:
    """(tree, n, top, members, l0..l4): groups of 81 neighbours with the levels
    above them, up to four and no further than the tree's last node. ``nodes``:
    (tree, n, idx, hash, ``carried``)."""
    member = F.struct((F.col("idx") % GROUP).alias("p"), "hash", *carried)
    rows = (nodes.groupBy("tree", "n", F.floor(F.col("idx") / GROUP).alias("top"))
            .agg(F.sort_array(F.collect_list(member)).alias("members")))   # at most 81
    rows = rows.withColumn("l0", _concat(F.col("members"), lambda x: x["hash"]))
    for k in range(LEVELS):
        more = F.ceil(F.col("n") / RUN ** k) > 1
        rows = rows.withColumn(f"l{k + 1}", F.when(more, _up(F.col(f"l{k}"))))
    return cut_lineage(rows, name)


def path_of(p: Column) -> Column:
    """Siblings of a member's ancestors, level by level up to the group's last
    node: array of (left, right)."""
    out = []
    for k in range(LEVELS):
        level, at = F.col(f"l{k}"), F.floor(p / RUN ** k).cast("int")
        first = at - at % RUN
        out.append(F.when(F.col(f"l{k + 1}").isNotNull(), F.struct(
            F.substring(level, first * 32 + 1, (at - first) * 32).alias("left"),
            F.substring(level, (at + 1) * 32 + 1, (first + (RUN - 1) - at) * 32).alias("right"))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _last() -> Column:
    return F.coalesce(*[f"l{k}" for k in range(LEVELS, -1, -1)])


def build(nodes: DataFrame, carried: Sequence[str], most: int, name: str) -> list[DataFrame]:
    """Groups of all levels, four levels each; ``most``: leaves of the largest
    tree."""
    out = []
    while not out or most > 1:
        groups = grouped(nodes, carried, f"merkle-{name}-{len(out)}")
        out.append(groups)
        nodes = groups.where(f"n > {GROUP}").select(
            "tree", F.ceil(F.col("n") / GROUP).alias("n"), F.col("top").alias("idx"), _last().alias("hash"))
        carried, most = [], -(-most // GROUP)
    return out


def _steps(n: Column, most: int) -> Column:
    """Groups on the way from a leaf to the last node of a tree of n leaves."""
    out, size = F.lit(1), GROUP
    while size < most:
        out, size = out + (n > size).cast("int"), size * GROUP
    return out


def _paths(groups: DataFrame) -> DataFrame:
    """(tree, at, path): one row a member of a group, linked by its place to
    the group's last node."""
    made = F.transform("members", lambda m: F.struct(
        (F.col("top") * GROUP + m["p"]).alias("at"), path_of(m["p"]).alias("path")))
    return groups.select("tree", F.inline(made))


def manifest(docs: DataFrame, **columns: str) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one
    row per document; ``columns`` as of ``leaves``."""
    rows = cut_lineage(leaves(docs, **columns).withColumnRenamed("leaf", "hash"), "merkle-leaves")
    rows = cut_lineage(placed(rows, "tree", ["doc_id", "hash"], "merkle-order"), "merkle-places")
    sizes = rows.groupBy("tree").agg(F.max("n").alias("leaves"))
    most, trees = sizes.agg(F.max("leaves"), F.count("*")).first()

    # a tree each source, then the tree of subroots, whose leaves are the trees
    own = build(rows, ["doc_id", "changed"], most or 0, "source")
    subroots = [g.where(f"n <= {GROUP}").select("tree", _last().alias("subroot")) for g in own]
    ranked = reduce(DataFrame.union, subroots).join(sizes, "tree").withColumn("all", F.lit(0))
    ranked = cut_lineage(placed(cut_lineage(ranked, "merkle-subroots"), "all", ["tree"], "merkle-tree-order"), "merkle-trees")
    over = build(ranked.select(F.col("all").alias("tree"), "n", "idx", F.col("subroot").alias("hash")), [], trees, "root")
    root = over[-1].select(_last()).first()
    steps = _steps(F.col("leaves"), most or 0)
    ranked = ranked.select("tree", "subroot", "leaves", "idx", steps.alias("steps"), (steps + len(over)).alias("total"))

    spread = F.explode(F.sequence(F.lit(0), F.floor((F.col("leaves") - 1) / BLOCK))).alias("place")
    nodes = []
    for k, groups in enumerate(own[1:], 1):
        path = _paths(groups)
        if k <= 2:                              # under a node of step 1 is a group of leaves, of step 2 a block
            nodes.append(path.select("tree", F.lit(k).alias("step"), F.col("at").alias("place"), "path"))
        else:                                   # one row a block below the node
            below = F.lit(GROUP ** (k - 2))
            last = F.least((F.col("at") + 1) * below, F.ceil(F.col("leaves") / BLOCK)) - 1
            nodes.append(path.join(ranked.select("tree", "leaves"), "tree").select(
                "tree", F.lit(k).alias("step"), F.explode(F.sequence(F.col("at") * below, last)).alias("place"), "path"))
    for k, groups in enumerate(over):
        path = _paths(groups).drop("tree")
        nodes.append(ranked.withColumn("at", F.floor(F.col("idx") / F.lit(GROUP ** k))).join(path, "at").select(
            "tree", (F.col("steps") + k).alias("step"), spread, "path"))

    climbed = _climb(own[0].join(ranked.select("tree", "total"), "tree"), reduce(DataFrame.union, nodes))
    # the siblings below are the leaf's own, those above it shares with its group
    each = F.transform("members", lambda m: F.struct(
        m["doc_id"].alias("doc_id"), m["hash"].alias("leaf"), F.element_at("folded", m["i"]).alias("folded"),
        F.concat(F.aggregate(path_of(m["p"]), F.lit(b""), lambda a, x: F.concat(a, x["left"], x["right"])),
                 F.col("proof")).alias("proof")))
    numbered = own[0].withColumn("members", F.transform("members", lambda m, i: m.withField("i", i + 1)))
    out = numbered.join(climbed, ["tree", "top"]).join(ranked.select("tree", "subroot"), "tree")
    return _result(out.select("subroot", F.inline(each)).withColumn("root", F.lit(bytes(root[0]) if root else None)))


def _climb(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """The recursive ascent of every leaf: (tree, top, folded, proof). The
    leaves of a group go the same way, so they stand in one row: ``folded`` has
    the digest of each, ``proof`` the siblings that they meet above the group."""
    spark = groups.sparkSession
    start = groups.select("tree", "top", F.lit(1).alias("step"), "total", F.transform("members", lambda m: F.aggregate(
        path_of(m["p"]), F.coalesce(m["changed"], m["hash"]),
        lambda a, x: _of_nodes(F.concat(x["left"], a, x["right"])))).alias("folded"), F.lit(b"").alias("proof"))
    names = {"merkle_start": cut_lineage(start, "merkle-start"), "merkle_nodes": cut_lineage(nodes, "merkle-nodes")}
    for view, df in names.items():
        df.createOrReplaceTempView(view)
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")             # whole results
    try:
        return cut_lineage(spark.sql(f"""
            WITH RECURSIVE climb(tree, top, step, total, folded, proof) AS (
              SELECT tree, top, step, total, folded, proof FROM merkle_start
              UNION ALL
              SELECT c.tree, c.top, c.step + 1, c.total,
                     transform(c.folded, d -> aggregate(n.path, d, (a, x) ->
                       unhex(sha2(cast(lower(hex(concat(x.left, a, x.right))) AS binary), 256)))),
                     aggregate(n.path, c.proof, (a, x) -> concat(a, x.left, x.right))
              FROM climb c JOIN merkle_nodes n ON n.tree = c.tree AND n.step = c.step
               AND n.place = CASE c.step WHEN 1 THEN c.top ELSE c.top div {GROUP} END)
            SELECT tree, top, folded, proof FROM climb WHERE step = total"""), "merkle-climb")
    finally:
        spark.conf.set(ROW_LIMIT, limit)
        for view in names:
            spark.catalog.dropTempView(view)


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", text_of("leaf"), text_of("subroot"), text_of("root"),
        F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"),
        F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
