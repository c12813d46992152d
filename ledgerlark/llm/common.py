"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

#: ASCII white space; everything else belongs to a word.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

SLICE_BYTES = 4 << 20
#: Tasks that share the work on a bounded sample.
SAMPLE_TASKS = 16


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once a session: a
    worker imports it, so that what it keeps between tasks is found again, and
    may not have it on its own path."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.basename(package)
        path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-py-"), f"{name}.zip")   # Spark hands out copies
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(package):
                for f in sorted(files):
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.join(name, os.path.relpath(full, package)))
        spark.sparkContext.addPyFile(path)


def whole_text(df: DataFrame, text: str = "text") -> Column:
    """The whole text as a string; null reads as empty."""
    ship(df.sparkSession)
    return F.coalesce(df[text].cast(StringType()), F.lit(""))


def ids_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) only, so no other column of the input can clash with an
    operator's own names."""
    return docs.select(docs[doc_id].cast(LongType()).alias("doc_id"), whole_text(docs, text).alias("text"))


def one_text_each(rows: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) with one row a doc_id, whose ``label`` goes with
    the doc_id: the text with the smallest XXH64 (ties: the smaller text).
    Repeats are combined before the shuffle, so a doc_id that fills a third of
    the table reaches the next task as one row a task."""
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    return (rows.groupBy("doc_id", label).agg(first).select("doc_id", F.col("first.text").alias("text"), label)
            .repartition(SAMPLE_TASKS, "doc_id"))


def raw_bytes(values: pa.Array) -> pa.Array:
    return values.cast(pa.binary())


def slices(values: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The values of a binary array as lists of about ``limit`` bytes, so that
    no more than one such list of Python objects lives at a time."""
    out: list[bytes] = []
    size = 0
    for v in values:
        b = v.as_py() or b""
        out.append(b)
        size += len(b)
        if size >= limit:
            yield out
            out, size = [], 0
    if out:
        yield out


def row_ranges(values: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of a string or binary array of about ``limit``
    bytes each, at least one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(values):
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield start, end
        start = end


_HELD: dict = {}


def held(key, make: Callable):
    """What a Python worker keeps between tasks: one thing at a time, so a
    worker that serves one operator after another holds no more than the
    largest of their tables."""
    if key not in _HELD:
        _HELD.clear()
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Give memory that Arrow no longer uses back to the machine."""
    pa.default_memory_pool().release_unused()


class RecentCache(dict):
    """A dict that keeps the entries used of late: a second, older generation
    is dropped whole once the young one has ``limit`` entries. Memory is thus
    bounded by ``2 * limit`` entries however many words a worker meets."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
