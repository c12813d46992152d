"""Daily feed files: all-text, header-agnostic CSV scan with provenance
(A1-A6).

The first line of each file is its header. Files of one header are read by one
scan whose columns carry that header's names, and the scans are united by name,
so a reordered or narrower file lands in the same fixed raw columns (a supplied
schema would map by position and silently swap columns). Files are split at
line ends; a quoted field that holds line breaks is put together again from the
lines of its record, wherever the splits fall. Header-only files still have
their header row, which is how empty files reach the monitoring operators.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlark.operators.cleaning import RAW_COLUMNS
from ledgerlark.operators.key_filter import maybe_among_lazy
from ledgerlark.functions.text import date_from_filename

STREAM_COLUMNS = 64       # a stream's scan is fixed before its files are seen
DATA_FIELDS = [c for c in RAW_COLUMNS if c not in ("source_file", "ingested_at")]


def csv_options(reader, width: int = STREAM_COLUMNS):
    """Positional all-text reading shared by the batch and streaming scans. A
    line with more cells than ``width`` is kept in ``_more``."""
    schema = ", ".join([*(f"_c{i} string" for i in range(width)), "_more string"])
    return (reader.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_more").option("nullValue", "").option("enforceSchema", "true"))


def file_cells(df: DataFrame) -> DataFrame:
    """Positional CSV rows -> (file, block, cells array); works on a
    streaming source too (file metadata must be taken at the scan). A line
    that is too wide for the scan is an error, never cut."""
    names = [c for c in df.columns if c.startswith("_c")]
    fits = F.when(F.col("_more").isNull() | (F.size(F.split("_more", ",")) <= len(names)), F.col(names[0]))
    first = fits.otherwise(F.raise_error(F.concat(
        F.lit(f"a feed line has more than {len(names)} cells: "), F.col("_metadata.file_name"))))
    return df.select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.array(first, *[F.col(c) for c in names[1:]]).alias("cells"))


POS_BITS = 40          # byte offsets inside one file (files up to 1 TB)
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << POS_BITS),
                "spark.sql.files.openCostInBytes": str(1 << POS_BITS)}


def first_lines(spark: SparkSession, paths: list[str] | str) -> dict[str, tuple[str, int]]:
    """File path -> first line that isn't blank and size in bytes, of every file
    that has such a line.

    One task a file, which stops reading at that line. The result is one line a
    file on the driver, where Spark keeps the list of the files as well."""
    text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"),
                                         F.col("_metadata.file_block_start").alias("block_start"),
                                         F.col("_metadata.file_size").alias("size"))

    def head(batches):
        for batch in batches:
            for i, line in enumerate(batch.column(0).to_pylist()):
                if line.strip():
                    yield batch.slice(i, 1)
                    return

    before = {k: spark.conf.get(k) for k in _WHOLE_FILES}
    try:
        for k, v in _WHOLE_FILES.items():
            spark.conf.set(k, v)
        rows = text.mapInArrow(head, text.schema).where("block_start = 0").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return {r.file_path: (r.value, r.size) for r in rows}


def header_names(line: str) -> list[str]:
    """The names of a header line: trimmed, without a UTF-8 byte-order mark."""
    return [name.strip() for name in next(csv.reader([line.lstrip("﻿")]))]


def header_groups(spark: SparkSession, paths: list[str] | str) -> dict[tuple[str, ...], dict[str, int]]:
    """Header -> paths and sizes of the files that begin with it."""
    groups: dict[tuple[str, ...], dict[str, int]] = {}
    for path, (line, size) in sorted(first_lines(spark, paths).items()):
        groups.setdefault(tuple(header_names(line)), {})[path] = size
    return groups


def literal_path(path: str) -> str:
    """A path as Spark lists it, to be read as it is: no percent codes, no globs."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(path))


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Every line of the files. Row ids are assigned at the scan, so a
    recomputed partition gets the same ids."""
    return spark.read.text([literal_path(f) for f in files]).select(
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"), "value",
        F.monotonically_increasing_id().alias("row_uid"))


# A quoted field begins with a quote at the start of a field and ends with one
# that isn't doubled; a quote within an unquoted field is a character like others.
_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'
_CLOSING = r'^[^"]*+(?:""[^"]*+)*+"'


def _opens(text: Column) -> Column:
    """Does text that begins outside quotes end inside a quoted field?"""
    return F.regexp_replace(text, _QUOTED, "$1").rlike('(^|,)"')


def _opens_from_within(text: Column) -> Column:
    """The same of text that begins inside a quoted field."""
    rest = F.concat(F.lit("x"), F.regexp_replace(text, _CLOSING, ""))
    return F.when(text.rlike(_CLOSING), _opens(rest)).otherwise(True)


def files_with_quoted_breaks(lines: DataFrame) -> list[str]:
    """Paths of the files in which some line leaves a quoted field open."""
    found = lines.where(F.col("value").contains('"') & _opens(F.col("value"))).select("file_path").distinct()
    return sorted(r.file_path for r in found.collect())


_BLOCK = ["file_path", "block_start"]


def _in_block() -> WindowSpec:
    return Window.partitionBy(*_BLOCK).orderBy("row_uid")


def _blocks_before() -> WindowSpec:
    return Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)


def _with_maps(lines: DataFrame) -> DataFrame:
    """A line maps "begins inside quotes" to "ends inside quotes": ``_out`` is
    the end of one that begins outside, ``_in`` of one that begins inside."""
    return lines.withColumns({"_out": _opens(F.col("value")), "_in": _opens_from_within(F.col("value"))})


def _with_states(t: DataFrame) -> DataFrame:
    """Lines with their maps -> also ``_start``, whether their block begins inside
    quotes, and ``_open``, whether they end inside. The maps of a block of a file
    compose by a window over the block, those of a file by a window over its
    blocks, which gives the state every block begins in. Lines without quotes leave
    the state as it is, and may be left out."""
    upto = _in_block().rowsBetween(Window.unboundedPreceding, 0)
    odd = lambda n: n % 2 == 1
    flip = lambda state, n: state != odd(n)

    # a line either fixes the state behind it, or turns it over, or leaves it
    t = t.withColumns({"_fixed": F.col("_out") == F.col("_in"), "_turn": (F.col("_out") & ~F.col("_in")).cast("int")})
    t = t.withColumn("_turns", F.sum("_turn").over(upto))
    t = t.withColumn("_last", F.last(F.when(F.col("_fixed"), F.struct("_out", "_turns")), True).over(upto))

    # state at the start of each block, by the maps of the blocks before it
    b = t.groupBy(*_BLOCK).agg(F.max_by(F.struct("_last", "_turns"), "row_uid").alias("_end"))
    b = b.select(*_BLOCK, F.col("_end._turns").alias("_n"),
                 flip(F.col("_end._last._out"), F.col("_end._turns") - F.col("_end._last._turns")).alias("_sets"))
    b = b.withColumn("_before", F.coalesce(F.sum("_n").over(_blocks_before()), F.lit(0)))
    b = b.withColumn("_set", F.last(F.when(F.col("_sets").isNotNull(), F.struct(
        F.col("_sets").alias("state"), (F.col("_before") + F.col("_n")).alias("turns"))), True).over(_blocks_before()))
    starts = b.select(*_BLOCK, F.when(
        F.col("_set").isNull(), odd(F.col("_before")))
        .otherwise(flip(F.col("_set.state"), F.col("_before") - F.col("_set.turns"))).alias("_start"))

    t = t.join(starts, _BLOCK)
    return t.withColumn("_open", F.when(F.col("_last").isNull(), flip(F.col("_start"), F.col("_turns")))
                        .otherwise(flip(F.col("_last._out"), F.col("_turns") - F.col("_last._turns"))))


LONG_GAP = 1000                # lines between two with quotes that are marked one by one
INNER_WORDS = 1 << 18          # of the filter of lines within records: 2 MB


def mark_perhaps_inside(lines: DataFrame, blocks: DataFrame, few_blocks: bool = False) -> DataFrame:
    """``lines`` with ``_perhaps``: all lines with a quote, all other lines of records of
    several lines, and few more. Only lines with quotes are moved for it, without
    their text; ``blocks`` has every block of the files, ``few_blocks`` says that they
    may be broadcast."""
    quoted = F.col("value").contains('"')
    s = _with_states(_with_maps(lines.where(quoted)).select(*_BLOCK, "row_uid", "_out", "_in"))
    s = s.withColumn("_next", F.lead("row_uid").over(_in_block()))
    between = F.col("_next") - F.col("row_uid") - 1
    gap, long = F.col("_open") & (between > 0), F.col("_open") & (between > LONG_GAP)
    inner = (s.where(gap & ~long).select(F.explode(F.sequence(F.col("row_uid") + 1, F.col("_next") - 1)).alias("_uid"))
             .select(F.xxhash64("_uid").alias("_d")))
    passes = maybe_among_lazy(inner, INNER_WORDS)

    # lines before the first quote of a block, after its last, or in a long gap
    q = s.groupBy(*_BLOCK).agg(
        F.min("row_uid").alias("_q0"), F.max("row_uid").alias("_q1"), F.max_by("_open", "row_uid").alias("_end"),
        F.min(F.when(long, F.col("row_uid"))).alias("_long_from"), F.max(F.when(long, F.col("_next"))).alias("_long_to"))
    b = blocks.select(*_BLOCK).join(q, _BLOCK, "left").withColumn("_entered", F.last("_end", True).over(_blocks_before()))
    ranges = b.select(*_BLOCK, F.when(F.col("_entered"), F.coalesce("_q0", F.lit((1 << 63) - 1))).alias("_head_to"),
                      F.when(F.col("_end"), F.col("_q1")).alias("_tail_from"), "_long_from", "_long_to")
    ranges = ranges.where(F.coalesce("_head_to", "_tail_from", "_long_from").isNotNull())
    uid = F.col("row_uid")
    within = (uid < F.col("_head_to"), uid > F.col("_tail_from"), (uid > F.col("_long_from")) & (uid < F.col("_long_to")))
    perhaps = quoted | passes(F.xxhash64("row_uid"))
    for w in within:
        perhaps = perhaps | F.coalesce(w, F.lit(False))
    return (lines.join(F.broadcast(ranges) if few_blocks else ranges, _BLOCK, "left").withColumn("_perhaps", perhaps)
            .select(*lines.columns, "_perhaps"))


def join_quoted_lines(lines: DataFrame, blocks: DataFrame | None = None, few_blocks: bool = False) -> DataFrame:
    """Lines of files with quoted line breaks -> records: ``value`` is the text
    of the whole record, its lines joined by a line feed, and the other columns
    are those of the record's first line. ``lines`` holds no header.

    A line that begins outside quotes begins a record; one that doesn't belongs to
    the last record begun, perhaps in an earlier block. Lines that neither have a quote
    nor lie between two of a record are records as they are read and stay where they are
    (:func:`mark_perhaps_inside`, with its ``blocks``). Only the lines of records of
    several lines are gathered, each record by itself.

    A quote that is never closed ends with the file: the lines from there on
    are records of their own, so a stray quote costs its own line alone."""
    cols = lines.columns
    marked = mark_perhaps_inside(lines, lines.select(*_BLOCK).distinct() if blocks is None else blocks, few_blocks)
    block, upto = _in_block(), _in_block().rowsBetween(Window.unboundedPreceding, 0)
    t = _with_states(_with_maps(marked.where("_perhaps").drop("_perhaps")))
    t = t.withColumn("_begins", ~F.coalesce(F.lag("_open").over(block), F.col("_start")))
    # a record's address: block and row id of its first line
    here = F.when(F.col("_begins"), F.struct("block_start", "row_uid"))
    t = t.withColumn("_first", F.last(here, True).over(upto))

    ends = t.groupBy(*_BLOCK).agg(
        F.max(here).alias("_mine"), F.max_by("_open", "row_uid").alias("_open_at_end"))
    whole_file = Window.partitionBy("file_path")
    ends = ends.select(*_BLOCK, F.last("_mine", True).over(_blocks_before()).alias("_carried"),
                       F.when(F.max_by("_open_at_end", "block_start").over(whole_file),
                              F.max("_mine").over(whole_file)).alias("_unclosed"))
    t = t.join(ends, _BLOCK)
    t = t.withColumn("_first", F.coalesce("_first", "_carried"))
    t = t.withColumn("_alone", (F.col("_begins") & ~F.col("_open"))
                     | F.coalesce(F.col("_first") == F.col("_unclosed"), F.lit(False)))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block_start", "row_uid", "value"))),
                                    lambda x: x["value"]), "\n")
    rest = [c for c in cols if c not in ("file_path", "value", "block_start", "row_uid")]
    gathered = (t.where(~F.col("_alone")).groupBy("file_path", "_first")
                .agg(text.alias("value"), *[F.min_by(c, F.struct("block_start", "row_uid")).alias(c) for c in rest])
                .select("*", "_first.block_start", "_first.row_uid"))
    return (marked.where(~F.col("_perhaps")).select(cols).unionByName(t.where("_alone").select(cols))
            .unionByName(gathered.select(cols)))


BROADCAST_BLOCKS = 100_000     # rows of two paths and four numbers: at most some 30 MB


def most_blocks(spark: SparkSession, sizes: list[int]) -> int:
    """The most splits a scan of files of these sizes can have."""
    size = lambda k: int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(f"spark.sql.files.{k}")))
    least = max(1, min(size("maxPartitionBytes"), size("openCostInBytes")))
    return sum(1 + n // least for n in sizes)


def group_records(spark: SparkSession, header: tuple[str, ...], files: dict[str, int], ranks: DataFrame) -> DataFrame:
    """The records of files of one header: ``source_file``, the header's raw
    columns as text, and ``raw_id``.

    ``ranks`` gives each file's place in the load. One aggregate finds where
    every block's row ids begin; joining its few rows is all that a file without
    quoted line breaks needs. They are broadcast where the sizes of the files
    show that they are few enough, so lines aren't shuffled; else the join is
    left to the optimizer."""
    lines = _lines(spark, list(files))
    shown = F.trim(F.col("value")) != ""
    blocks = lines.groupBy(*_BLOCK).agg(
        F.min("source_file").alias("source_file"), F.min("row_uid").alias("_base"),
        F.min(F.when(shown, F.col("row_uid"))).alias("_head")).join(ranks, "file_path")
    few_blocks = most_blocks(spark, list(files.values())) <= BROADCAST_BLOCKS
    place = F.col("block_start") + (F.col("row_uid") - F.col("_base"))
    raw_id = (F.when((F.col("_frank") < 1 << (63 - POS_BITS)) & (place < 1 << POS_BITS),
                     F.shiftleft(F.col("_frank"), POS_BITS) + place)
              .otherwise(F.raise_error(F.lit(f"a feed file above 2^{POS_BITS} bytes, or more than "
                                             f"2^{63 - POS_BITS} files, leaves no unique raw_id"))))

    def records(of: DataFrame) -> DataFrame:
        """The lines of these blocks' files, without headers."""
        return (lines.drop("source_file").join(F.broadcast(of) if few_blocks else of, _BLOCK)
                .where((F.col("block_start") > 0) | (F.col("row_uid") > F.col("_head"))))

    broken = files_with_quoted_breaks(lines)
    if broken:
        # files are told apart among their blocks, so no line is moved for it
        marks = spark.createDataFrame([(f,) for f in broken], "file_path string")
        of = blocks.join(marks, "file_path", "left_semi")
        # what is moved goes by the file's rank, which is shorter than its path; the rest
        # of a block's columns come back after
        ranked = [F.col("_frank").alias("file_path"), "block_start"]
        joined = join_quoted_lines(records(of).select(*ranked, "row_uid", "value"), of.select(*ranked), few_blocks)
        joined = joined.withColumnRenamed("file_path", "_frank").join(
            F.broadcast(of) if few_blocks else of, ["_frank", "block_start"])
        rows = records(blocks.join(marks, "file_path", "left_anti")).unionByName(joined)
    else:
        rows = records(blocks)
    names = ", ".join(f"_c{i} string" for i in range(len(header)))
    cells = F.from_csv("value", F.lit(names), {"escape": '"', "nullValue": "", "mode": "PERMISSIVE"})
    at = {c: header.index(c) for c in DATA_FIELDS if c in header}
    return (rows.where(shown).select("source_file", "file_path", cells.alias("_cells"), raw_id.alias("raw_id"))
            .select("source_file", "file_path",
                    *[F.nullif(F.col(f"_cells._c{i}"), F.lit("")).alias(c) for c, i in at.items()], "raw_id"))


def _file_name(path: str) -> str:
    return unquote(path).rsplit("/", 1)[-1]


def read_orders(spark: SparkSession, paths: list[str] | str, ingested_at: str | None = None,
                file_rank_offset: int = 0, keep_path: bool = False,
                groups: dict[tuple[str, ...], dict[str, int]] | None = None) -> DataFrame:
    """A1-A3: raw_orders rows from any mix of header variants.

    Every value is text; only an empty field is NULL (``NA`` stays text).
    Adds ``source_file``, ``ingested_at``, and ``raw_id`` = ``row_uid``: the
    load sequence, a unique long that increases with (file name, position in
    file): ``file rank << POS_BITS | block start + row offset in the block``. A
    block never holds more lines than bytes, so this is unique; "first in load
    order" is the ``min`` of a long, a hash aggregate. A later load passes
    ``file_rank_offset`` (one past the highest file rank already stored,
    ``raw_id >> POS_BITS``) so its rows sort after the earlier ones.

    Line breaks in quoted fields become line feeds. ``keep_path`` adds
    ``file_path``, which tells files of one name apart; ``groups`` is the result
    of :func:`header_groups` where the caller has it.
    """
    groups = header_groups(spark, paths) if groups is None else groups
    files = sorted((f for fs in groups.values() for f in fs), key=lambda f: (_file_name(f), f))
    ranks = spark.createDataFrame([(f, file_rank_offset + i) for i, f in enumerate(files)], "file_path string, _frank long")
    ts = F.lit(ingested_at) if ingested_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = spark.createDataFrame([], ", ".join(["source_file string", "file_path string", *[f"{c} string" for c in DATA_FIELDS], "raw_id long"]))
    for header, members in groups.items():
        out = out.unionByName(group_records(spark, header, members, ranks), allowMissingColumns=True)
    return out.select("source_file", ts.alias("ingested_at"), *DATA_FIELDS, "raw_id", F.col("raw_id").alias("row_uid"),
                      *(["file_path"] if keep_path else []))


def file_headers(spark: SparkSession, paths: list[str] | str,
                 groups: dict[tuple[str, ...], dict[str, int]] | None = None) -> DataFrame:
    """(source_file, file_path, header) for every file, including header-only ones."""
    groups = header_groups(spark, paths) if groups is None else groups
    rows = [(_file_name(f), f, list(header)) for header, files in groups.items() for f in files]
    return spark.createDataFrame(rows, "source_file string, file_path string, header array<string>").coalesce(1)


def file_list(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file_name, file_date) for every file (A4 date from the name)."""
    h = file_headers(spark, paths)
    return h.select(F.col("source_file").alias("file_name"),
                    date_from_filename(F.col("source_file")).alias("file_date"))


def file_sha256(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """SHA-256 of each file's bytes (binaryFile source; one file is one
    row, so this suits daily files; ``monitor.content_digest`` is the
    size-independent alternative)."""
    b = spark.read.format("binaryFile").load(paths)
    return b.select(F.element_at(F.split("path", "/"), -1).alias("source_file"),
                    F.sha2(F.col("content"), 256).alias("file_hash"))


def unreadable_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """B3 input: non-empty files in the landing set that yield no header
    line. The file listing comes from the ``binaryFile`` source with only
    path and length selected, so file bytes are not read for it. Spark's file
    sources skip zero-byte files altogether; such a day surfaces as a
    missing day (``monitor.missing_days``)."""
    listing = (spark.read.format("binaryFile").load(paths)
               .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length"))
    have = file_headers(spark, paths).select(F.col("source_file").alias("file_name"))
    missing = listing.join(have, "file_name", "left_anti")
    return missing.select("file_name", date_from_filename(F.col("file_name")).alias("file_date"),
                          F.lit("no header line").alias("error"))

