"""A1/A2 on files with quoted line breaks, split anywhere, and mixed headers."""
import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import feed_csv

HEADER = "order_id,order_date,store_id,product_id,quantity,unit_price,discount_pct,sales_channel,loyalty_member"


@pytest.fixture()
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "64")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def records_by_hand(text):
    """One character at a time: the records of a body, and whether it ends in quotes."""
    out, record, quoted, at_field_start, i = [], "", False, True, 0
    starts = []
    while i < len(text):
        ch = text[i]
        if quoted and ch == '"' and text[i + 1:i + 2] == '"':
            record += '""'
            i += 2
            continue
        if ch == '"' and (quoted or at_field_start):
            quoted, at_field_start = not quoted, False
        elif ch == "\n" and not quoted:
            out.append(record)
            starts.append(i + 1)
            record, at_field_start, i = "", True, i + 1
            continue
        else:
            at_field_start = ch == "," and not quoted
        record += ch
        i += 1
    return out, record, quoted


def expected(body):
    out, tail, quoted = records_by_hand(body)
    if quoted:                      # never closed: the lines of the tail stand alone
        return out + tail[:-1].split("\n")
    return out + ([tail] if tail else [])


def test_records_of_random_text(spark, small_blocks, tmp):
    rng = random.Random(5)
    want = {}
    for k in range(40):
        n = rng.choice([30, 200, 900])
        body = "".join(rng.choices(['a', ',', '"', '\n', '""', 'b"c', ',"', '",'], [8, 4, 2, 3, 1, 1, 2, 2], k=n)) + "\n"
        want[f"f{k}.csv"] = body
        with open(os.path.join(tmp, f"f{k}.csv"), "w") as f:
            f.write(body)
    lines = feed_csv._lines(spark, [os.path.join(tmp, name) for name in want])
    assert lines.groupBy("file_path").agg(F.count_distinct("block_start").alias("n")).agg(F.max("n")).first()[0] > 5
    got = {}
    rows = feed_csv.join_quoted_lines(lines).select("source_file", "block_start", "row_uid", "value").collect()
    for r in sorted(rows, key=lambda r: (r.block_start, r.row_uid)):
        got.setdefault(r.source_file, []).append(r.value)
    for name, body in want.items():
        assert got[name] == expected(body), name


def test_fields_with_line_breaks(spark, small_blocks, tmp):
    """What a CSV writer writes is read back, in load order, whatever the split."""
    rng = random.Random(9)
    odd = ['plain', 'two\nlines', 'a "quoted" word', ' \n\n ', 'x,y\n"z"\n', '5" pipe', '\n', "", "tail\n" * 30]
    rows = [[f"o{i:05d}", "2026-09-01", "S001", rng.choice(odd), "2", "$1.50", rng.choice(odd), "pickup", "Y"]
            for i in range(300)]
    with open(os.path.join(tmp, "orders_2026-09-01.csv"), "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([HEADER.split(","), *rows])
    got = feed_csv.read_orders(spark, tmp).orderBy("raw_id").select(*HEADER.split(",")).collect()
    # white space is part of a quoted value
    assert [list(r) for r in got] == [[v or None for v in r] for r in rows]


def test_stray_quote_costs_one_line(spark, tmp):
    good = [f"o{i},2026-09-02,S001,P1,1,1.00,0,pickup,Y" for i in range(50)]
    bad = good[:20] + ['"o20,2026-09-02,S001,P1,1,1.00,0,pickup,Y'] + good[21:]
    with open(os.path.join(tmp, "orders_2026-09-02.csv"), "w") as f:
        f.write("\n".join([HEADER, *bad]) + "\n")
    ids = [r.order_id for r in feed_csv.read_orders(spark, tmp).orderBy("raw_id").collect()]
    assert len(ids) == 50 and ids[:20] + ids[21:] == [f"o{i}" for i in range(50) if i != 20]


def test_header_groups_without_row_joins(spark, tmp):
    """One scan a header; the files' names may hold spaces, percent signs and globs."""
    names = HEADER.split(",")
    for name, order in (("orders_2026-09-03 [a].csv", names), ("orders_2026-09-04%20b.csv", names[::-1]),
                        ("orders_2026-09-05{c}.csv", names)):
        with open(os.path.join(tmp, name), "w") as f:
            f.write("\n\n" + ",".join(order) + "\n" + ",".join(f"v_{c}" for c in order) + "\n")
    groups = feed_csv.header_groups(spark, tmp)
    assert sorted(len(files) for files in groups.values()) == [1, 2]
    raw = feed_csv.read_orders(spark, tmp)
    rows = raw.orderBy("raw_id").collect()
    assert [r.source_file[:17] for r in rows] == [f"orders_2026-09-0{d}" for d in (3, 4, 5)]
    assert all(r[c] == f"v_{c}" for r in rows for c in names)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan
