"""The driver brings its own session: nothing may depend on ``build_session``."""

import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# One query of each group of the README's table.
GROUPS = ("compact_latest", "app_bounds", "metric_total", "dq_range", "page_explode", "load_watermarks", "drift_keys", "stored_watermarks")

SCRIPT = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
assert len(E.entry(spark).columns) == 14 and E.entry(spark).count() > 0
found = E.queries()
for name in {GROUPS!r}:
    assert found[name](spark, {SF_SMALL!r}).count() > 0, name
for key in ("spark.sql.adaptive.enabled", "spark.sql.session.timeZone"):
    assert spark.conf.get(key).lower() in ("true", "utc")
print("FINE")
"""


def test_entry_and_queries_on_a_session_built_elsewhere():
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert "FINE" in done.stdout, done.stderr[-3000:]
