"""Steps in Python run where the workers do not find this package by themselves."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import types as T
from streetloom.session import build_session
from streetloom.operators.pair_counts import pair_counts
from streetloom.sources import read_csv

spark = build_session("local[1]", 1, **{"spark.ui.enabled": "false"})
left = spark.sql("select 40D as lat, -75D as lon, id % 2 as kind from range(6)")
right = spark.sql("select 40D as latitude, -75D as longitude from range(5)")
counted = pair_counts(left, right, ["kind"], []).groupBy("kind").sum("n_pairs").orderBy("kind").collect()
schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
with open("a.csv", "w") as f:
    f.write('n,t\\n1,"a\\nb"\\n2,c\\n')
print("found", [tuple(r) for r in counted], read_csv(spark, "a.csv", schema).count())
"""


def test_python_steps_run_from_another_folder(tmp_path):
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found [(0, 15), (1, 15)] 2" in done.stdout, done.stderr[-2000:]
