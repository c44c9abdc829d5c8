import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from sluice.operators import nested
from sluice.session import ship
ship(spark)
ship(spark)
df = spark.createDataFrame([("1", '{{"a": [{{}}]}}')], "id string, attributes string")
print("rows", nested.element_nodes(df, ["id"], ["attributes"]).count())
"""


def test_workers_get_the_package(tmp_path):
    """Also where only the driver's path has it, as with a session made elsewhere."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "rows 1" in done.stdout, done.stderr[-2000:]
