"""All corpus queries where only the driver has the package: workers start elsewhere and find nothing to import."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from textjury.llm.queries import QUERIES

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's path alone; workers take PYTHONPATH and their own folder
from pyspark.sql import SparkSession
from textjury.llm.queries import QUERIES
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.warehouse.dir", sys.argv[2] + "/warehouse").getOrCreate()
)
def probe(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({"found": [importlib.util.find_spec("textjury") is not None]})
assert not spark.range(1).mapInArrow(probe, "found boolean").first()["found"]
for name in sys.argv[3:]:
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
    print("ran", name)
"""


@pytest.mark.parametrize("part", range(3))
def test_queries_run_without_the_package_on_executors(tmp_path, part):
    names = sorted(QUERIES)[part::3]
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(REPO), str(tmp_path), *names],
        cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=600,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")] == names
