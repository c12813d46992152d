import re
from collections import Counter

from ledgerlark.llm import quality_rules as R

from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_odd_rows(spark, odd, empty):
    got = Counter((r.doc_id, *(r[m] for m in R.MEASURES)) for r in R.ledger(odd).collect())
    assert got == Counter((r[0], *brute(r[1])) for r in ODD)
    assert R.ledger(empty).count() == 0
    assert R.keep_rows(odd).columns == odd.columns


def test_windows_lines_symbols(spark):
    texts = ["a b c d e f g h " * 2, "a b c d e f g h i j k a b c d e f g h", "x " * 30, "l1\nl1\n\n l1\nl2\n", "#$ % &a|<>*",
             "w " * 7, "a b c d e f g h i " + "a b c d e f g h i j", "퟿𝒳 𝒳"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[m] for m in R.MEASURES) for r in R.ledger(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_policies_and_ablations(spark):
    texts = ["too short", "good words in a row " * 1 + " ".join(f"w{i}" for i in range(30)),
             " ".join(f"w{i}%%%" for i in range(30)), "spam again and again so on and on " * 10]
    led = R.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    kept = lambda v: {r.doc_id for r in R.apply_policy(led, v).collect() if r.kept}
    assert kept(1) == {1, 2} and kept(2) == {1} and kept(3) == {1}
    table = {r.rule: (r.n_failed, r.n_only_here) for r in R.ablations(led, 3).collect()}
    assert table["few_words"] == (1, 1) and table["symbols"] == (1, 1) and table["repeated_windows"] == (1, 1)
    assert table["long_words"] == (0, 0)


def test_no_python(spark, odd):
    plan = R.keep_rows(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
