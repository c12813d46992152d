from ledgerlark.llm import licenses as L

MIT = dict(L.KNOWN[1:2])["MIT"]


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r.doc_id, r.scope, r.license_id, r.n_matches) for r in L.scan(df).collect())


def test_equal_up_to_form(spark):
    altered = ("Copyright (c) 2024 Somebody Else\nAll rights reserved.\n\n" + MIT.upper()
               .replace("COPYRIGHT HOLDERS", "Copyright Owners").replace("SUBLICENSE", "sub-licence").replace(",", " , ")
               .replace(" THE ", "\n * the "))
    assert scan(spark, [MIT, altered, MIT + " But not on Sundays.", MIT.replace("free of charge", "for a fee")]) == [
        (0, "text", "MIT", 1), (1, "text", "MIT", 1)]


def test_notices_by_line(spark):
    text = ("Some words.\n  Licensed under the Apache License, Version 2.0  \nmore\n"
            "# Licensed under the Apache Licence Version 2.0.\nlicensed under the apache license version 2.0 or not")
    assert scan(spark, [text, "Released under the MIT License."]) == [
        (0, "line", "Apache-2.0", 2), (1, "line", "MIT", 1), (1, "text", "MIT", 1)]


def test_whole_licences(spark):
    texts = {}
    for i, text in L.whole_texts():
        texts.setdefault(i, text)   # as published
    assert set(texts) >= {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"}
    ids = sorted(texts)
    rewrapped = [" ".join(line.split()) + "\r\n" for line in texts["Apache-2.0"].splitlines()]
    filled = texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 Jane Doe")
    moved = texts["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
                                     "59 Temple Place - Suite 330, Boston, MA  02111-1307, USA")
    terms = texts["GPL-3.0"].split("How to Apply These Terms")[0]
    altered = [texts["MPL-2.0"] + " But not on Sundays.", texts["CC0-1.0"].replace("waive", "keep", 1)]
    got = scan(spark, [*[texts[i] for i in ids], "".join(rewrapped), filled, moved, terms, *altered])
    want = [*ids, "Apache-2.0", "Apache-2.0", "GPL-2.0", "GPL-3.0"]
    assert [(d, i) for d, scope, i, n in got if scope == "text" and n == 1] == list(enumerate(want))


def test_odd_rows(spark, odd, empty):
    assert L.scan(odd).count() == 0 and L.scan(empty).count() == 0
    assert L.scan(empty).columns == ["doc_id", "scope", "license_id", "n_matches"]
    assert scan(spark, [None, "", "Copyright 2020 by me", "...", "Copyright 2020 by me\nReleased under CC0 1.0"]) == [
        (4, "line", "CC0-1.0", 1), (4, "text", "CC0-1.0", 1)]


def test_known_has_no_clash(spark):
    known = L.known_digests(spark).collect()
    assert len({k.digest for k in known}) == len(known) >= 18


def test_native(spark, odd):
    plan = L.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Nested" not in plan
