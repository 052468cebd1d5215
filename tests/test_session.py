"""The scratch folder of a session without configuration."""

import os
import subprocess
import sys

import pyarrow as pa

from ledgerflow.session import configure

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
from ledgerflow.session import new_run_dir, session, shared_dir
spark = session(master="local[1]", **{"spark.ui.enabled": "false"})
assert spark.conf.get("spark.checkpoint.dir", None) is None
path = new_run_dir(spark, "x")
assert path.startswith(shared_dir(spark) + "/") and shared_dir(spark) == shared_dir(spark)
spark.range(3).write.parquet(path)
print("rows", spark.read.parquet(path).count())
"""


def test_local_master_without_a_configured_folder(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=200)
    assert "rows 3" in done.stdout, done.stderr[-2000:]


def test_batches_for_python_are_bounded_by_their_bytes(spark):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    texts = configure(spark).range(0, 4000, 1, 1).selectExpr("repeat('x', 8000) AS text")
    sizes = [row.bytes for row in texts.mapInArrow(size, "bytes long").collect()]
    assert sum(sizes) > 32_000_000 and max(sizes) < 10_000_000
