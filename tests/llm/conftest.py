import os
import sys

import pytest

# Python workers import the package too
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
sys.path.insert(0, ROOT)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, score double, n_tokens long, "
          "`n words` int")
LONG = " ".join(f"word{i % 997} of{i}" for i in range(60_000))

#: nulls, empty and long texts, ties, repeated rows, clashing extra columns
ODD = [
    (1, "The cat sat on the mat and looked at the moon.", "en", "a", 1, 7, 0.5, 3, 1),
    (1, "The cat sat on the mat and looked at the moon.", "en", "a", 1, 7, 0.5, 3, 1),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "en", "a", 0, 0, 0.0, 0, 0),
    (4, " \t\n\x0b\x0c\r ", "en", "a", 7, 0, 0.0, 0, 0),
    (5, LONG, "en", "b", 5, 1, 1.0, 1, 1),
    (6, "la la la la " * 40, "fr", "b", 5, 1, 1.0, 1, 1),
    (None, "no id at all", "fr", "b", 5, 1, 1.0, 1, 1),
    (7, "é ñ 日本語 \x1c x y <|endoftext|> z\x00", "de", "c", 5, 1, 1.0, 1, 1),
    (8, "THE Cat Sat on the mat and looked at the moon.", "en", "a", 1, 7, 0.5, 3, 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, int(i in (1, 6))) for i in (1, 3, 5, 6, 7, 8)] + [(1, 1, 1), (2, None, None), (None, 1, 1), (5, 9, 9)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
