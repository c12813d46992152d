import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from pyspark.sql import functions as F
from ledgerlark.llm import html_text, merkle, pivot_search, simhash
v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "vec_id long, embedding array<double>")
assert pivot_search.top_k(pivot_search.quantized(v), F.expr('vec_id % 10 = 0')).count() == 10
p = spark.createDataFrame([(1, "u", "<article><p>One</p></article>")], "page_id long, url string, html string")
assert html_text.extract(p).first().text == "One"
d = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
assert simhash.near_duplicates(d).count() == 2
print("all done")
"""


def test_workers_get_the_package_in_a_foreign_folder(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, str(script), ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all done" in got.stdout, got.stderr[-2000:]
