"""Queries in a session made elsewhere, whose workers do not start in the package's folder."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as driver

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", f"{sys.argv[2]}/shared")
    .config("spark.sql.warehouse.dir", f"{sys.argv[2]}/warehouse")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
# Each reading has 300 steps, and the goal is 500: met by the second one of a day.
spark.sql(
    "SELECT id AS event_id, 7L AS user_id, 'click' AS event_type, 1.5D AS value, "
    "'{\\"k\\": 60}' AS props, timestamp_seconds(1704067200 + id * 30000) AS ts FROM range(12)"
).write.parquet(f"{sys.argv[2]}/events.parquet")
from pacefold.plans.queries import registry
rows = registry()["stream_goal_achieved"](spark, sys.argv[2])
print(sorted(tuple(row) for row in rows.collect()))
spark.stop()
"""


def test_goals(tmp_path):
    root = str(Path(driver.__file__).resolve().parent)
    found = subprocess.run(
        [sys.executable, "-c", CODE, root, str(tmp_path)],
        cwd=tmp_path, capture_output=True, text=True, check=False,
    )
    assert found.returncode == 0, found.stderr[-2000:]
    assert eval(found.stdout) == [
        ("user_7", "2024-01-01", "2024-01-01 08:20:00"),
        ("user_7", "2024-01-02", "2024-01-02 09:20:00"),
        ("user_7", "2024-01-03", "2024-01-03 10:20:00"),
        ("user_7", "2024-01-04", "2024-01-04 11:20:00"),
    ]
