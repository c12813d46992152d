"""Only lines with quotes, and those within records, move to be put together."""
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import feed_csv
from tests.test_quoted_records import HEADER, expected, small_blocks  # noqa: F401


def write(tmp, name, body):
    with open(os.path.join(tmp, name), "w", newline="") as f:
        f.write(body)
    return os.path.join(tmp, name)


def test_lines_outside_of_records_stay(spark, tmp):
    rows = [f"o{i},2026-09-01,S001,P1,1,1.00,0,pickup,Y" for i in range(2000)]
    for i in range(0, 2000, 100):
        rows[i] = f'o{i},2026-09-01,S001,P1,1,1.00,0,"two\nplain\n""lines""",Y'
    lines = feed_csv._lines(spark, [write(tmp, "orders_2026-09-01.csv", "\n".join(rows) + "\n")])
    perhaps = feed_csv.mark_perhaps_inside(lines, lines.select("file_path", "block_start").distinct()).where("_perhaps")
    assert 60 <= perhaps.count() <= 70
    assert {"plain", '""lines""",Y'} <= {r.value for r in perhaps.collect()}
    assert feed_csv.join_quoted_lines(lines).count() == 2000


@pytest.mark.parametrize("gap", [1, 1000])
def test_long_and_short_gaps(spark, small_blocks, tmp, monkeypatch, gap):  # noqa: F811
    monkeypatch.setattr(feed_csv, "LONG_GAP", gap)
    rng = random.Random(11)
    want = {}
    for k in range(12):
        body = "".join(rng.choices(["a", ",", '"', "\n", '""', ',"', '",', "\nbc\nde\n"], [8, 4, 1, 4, 1, 1, 1, 4], k=400)) + "\n"
        want[f"f{k}.csv"] = body
        write(tmp, f"f{k}.csv", body)
    got = {}
    rows = feed_csv.join_quoted_lines(feed_csv._lines(spark, [os.path.join(tmp, n) for n in want]))
    for r in sorted(rows.select("source_file", "block_start", "row_uid", "value").collect(), key=lambda r: (r.block_start, r.row_uid)):
        got.setdefault(r.source_file, []).append(r.value)
    for name, body in want.items():
        assert got[name] == expected(body), name


def test_files_are_told_apart_without_moving_lines(spark, tmp):
    row = "o{},2026-09-01,S001,P1,1,1.00,0,pickup,Y"
    for k in range(3):
        body = [HEADER, *(row.format(i) for i in range(400))]
        if k == 1:
            body[200] = 'o,2026-09-01,S001,P1,1,1.00,0,"two\nlines",Y'
        write(tmp, f"orders_2026-09-0{k + 1}.csv", "\n".join(body) + "\n")
    raw = feed_csv.read_orders(spark, tmp)
    assert raw.count() == 1200 and raw.where(F.col("sales_channel") == "two\nlines").count() == 1
    raw.collect()
    text = raw._jdf.queryExecution().optimizedPlan().toString().split("\n")
    # a join by file stands above blocks, which are aggregates, not above lines
    by_file = [i for i, x in enumerate(text) if "Join LeftSemi" in x or "Join LeftAnti" in x]
    assert by_file
    for i in by_file:
        depth = len(text[i]) - len(text[i].lstrip(" :+-"))
        below = []
        for x in text[i + 1:]:
            if len(x) - len(x.lstrip(" :+-")) <= depth:
                break
            below.append(x)
        assert any("Aggregate [file_path" in x for x in below), "\n".join(text[i:i + 8])
