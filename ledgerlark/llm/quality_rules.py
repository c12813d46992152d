"""Rule bitmask ledger: every rule is evaluated once and leaves a bit.

``measure`` takes the measurements of a text, ``ledger`` adds ``failure_bits``
(bit b set: rule b failed), ``apply_policy`` reads a verdict off the bits with
the mask of a policy version, and ``ablations`` says, for every rule of a
policy, what the policy would do without it. Texts are read once; a new policy
version only needs the ledger.

Native throughout: array functions inside the row, no shuffle, no Python.

Defined results
* null or empty text: all measurements 0, rule ``few_words`` fails;
* a text is measured whole, however long; memory is a few longs a word of the
  one text at hand;
* repeated rows give repeated rows, an empty table gives an empty table;
* other columns are dropped by ``ledger`` and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ids_and_text, whole_text

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL over the measurements

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: Integer arithmetic only, so every engine decides alike.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "short_words", "word_chars < 2 * n_words"),
    Rule(4, "long_words", "word_chars > 15 * n_words"),
    Rule(5, "repeated_lines", "n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines"),
)
BASE = ("few_words", "repeated_windows")

#: Policy versions: the rules that reject.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols"),
    3: (*BASE, "symbols", "short_words", "long_words", "repeated_lines"),
}
CURRENT_POLICY = 3


def policy_mask(version: int, rules: tuple[Rule, ...] = RULES) -> int:
    names = POLICIES[version]
    return sum(r.mask for r in rules if r.name in names)


def _joined(hashes: Column, span: int) -> Column:
    """Each hash with the one ``span`` places on; null past the end hashes to
    a shorter chain, which no caller reads."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + F.lit(span))))


def measure(df: DataFrame, text: Column, prefix: str = "") -> DataFrame:
    """``df`` with the measurements of ``text`` as columns ``prefix + name``.

    A window that occurs again is found by sorting the window hashes of the
    text (64-bit chained XXH64 over the word hashes), only in texts that have
    equal ones (``slice`` inside a lambda would copy the array for every word, so
    windows grow by doubling); the covered words follow from the sorted start positions.
    """
    t = prefix
    df = df.withColumn(f"{t}text", text)
    c = lambda n: F.col(f"`{t}{n}`")
    df = df.withColumn(f"{t}words", F.array_remove(F.split(c("text"), rf"[{SPACE}]+"), ""))
    df = df.withColumn(
        f"{t}lines", F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(rf"[^{SPACE}]")))
    df = df.withColumn(f"{t}n_words", F.size(c("words")).cast("long"))
    df = df.withColumn(f"{t}word_chars", F.char_length(F.array_join(c("words"), "")).cast("long"))
    df = df.withColumn(
        f"{t}n_symbols", F.char_length(F.regexp_replace(c("text"), r"[^#*$%&|<>]+", "")).cast("long"))
    df = df.withColumn(f"{t}n_lines", F.size(c("lines")).cast("long"))
    df = df.withColumn(f"{t}n_dup_lines", c("n_lines") - F.size(F.array_distinct(c("lines"))))
    df = df.withColumn(f"{t}wh", F.transform(c("words"), lambda w: F.xxhash64(w)))
    span, last = 1, "wh"
    while span < WINDOW:  # hashes of 2, 4, then 8 words from each word on
        df = df.withColumn(f"{t}w{span}", _joined(c(last), span))
        span, last = 2 * span, f"w{span}"
    df = df.withColumn(f"{t}win", F.slice(c(last), 1, F.greatest(c("n_words") - (WINDOW - 1), F.lit(0)).cast("int")))
    df = df.withColumn(
        f"{t}sorted",
        F.when(F.size(F.array_distinct(c("win"))) < F.size(c("win")), F.sort_array(
            F.transform(c("win"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn(
        f"{t}starts",
        F.sort_array(F.filter(
            F.transform(c("sorted"), lambda x, j: F.when(
                (x["h"] == F.get(c("sorted"), j - 1)["h"]) | (x["h"] == F.get(c("sorted"), j + 1)["h"]), x["i"])),
            lambda p: p.isNotNull())))
    covered = F.aggregate(
        c("starts"),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    df = df.withColumn(f"{t}n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return df.drop(*[f"{t}{n}" for n in ("text", "words", "lines", "wh", "w1", "w2", "w4", "win", "sorted", "starts")])


def failure_bits(rules: tuple[Rule, ...] = RULES, prefix: str = "") -> Column:
    """One bit a failed rule, from the measurement columns.

    The row id times zero keeps the optimizer from pushing a filter on the bits
    below the measurements, where it would repeat their expressions within each
    other."""
    names = sorted({*MEASURES, "n_lines"}, key=len, reverse=True)

    def over(sql: str) -> Column:
        for n in names:
            sql = sql.replace(n, f"\0{names.index(n)}\0")
        for i, n in enumerate(names):
            sql = sql.replace(f"\0{i}\0", f"`{prefix}{n}`")
        return F.expr(sql)

    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(over(r.fails), F.lit(r.mask)).otherwise(F.lit(0)).cast("long"))
    return bits + F.monotonically_increasing_id() * 0


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, measurements, n_lines, failure_bits), one row per input row."""
    base = ids_and_text(docs, doc_id, text)
    out = measure(base.withColumnRenamed("text", "body"), F.col("body")).drop("body")
    return out.withColumn("failure_bits", failure_bits(rules))


def apply_policy(led: DataFrame, version: int = CURRENT_POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and ``policy_version``."""
    base = sum(r.mask for r in rules if r.name in BASE)
    mask = policy_mask(version, rules)
    return (led.withColumn("base_failed", F.col("failure_bits").bitwiseAND(F.lit(base)) != 0)
            .withColumn("kept", F.col("failure_bits").bitwiseAND(F.lit(mask | base)) == 0)
            .withColumn("policy_version", F.lit(version)))


def ablations(led: DataFrame, version: int = CURRENT_POLICY, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents it fails, and documents that
    only it rejects (kept if the rule went). One aggregate over the distinct
    bit patterns, of which there are at most 2 ** rules."""
    mask = policy_mask(version, rules)
    patterns = (led.groupBy(F.col("failure_bits").bitwiseAND(F.lit(mask)).alias("bits"))
                .agg(F.count("*").alias("n")))
    table = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask"))
        for r in rules if r.mask & mask]))
    return (patterns.select("bits", "n", table.alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.mask")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.mask"), F.col("n")).otherwise(0)).alias("n_only_here")))


def keep_rows(docs: DataFrame, version: int = CURRENT_POLICY, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, all columns as they were."""
    cols = docs.columns
    p = "__rules_"
    base = sum(r.mask for r in RULES if r.name in BASE)
    bits = f"{p}failure_bits"
    judged = measure(docs, whole_text(docs, text), p).withColumn(bits, failure_bits(prefix=p))
    kept = judged.where(F.col(bits).bitwiseAND(F.lit(policy_mask(version) | base)) == 0)
    return kept.select(*[F.col(f"`{c}`") for c in cols])
