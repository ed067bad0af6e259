"""Tasks get all code they need from the driver: workers here cannot import the package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from spindlewave.session import build_session
spark = build_session("far", "local[2]", **{{
    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {work!r}, "spark.driver.memory": "2g"}})

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("spindlewave") is not None])], ["there"])

assert not spark.range(1).mapInArrow(importable, "there boolean").first().there
import __spark_entry__
queries = __spark_entry__.queries()
for name in {names!r}:
    print(name, queries[name](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize(
    "names",
    [
        ["op1_best_fit_packing", "op2_warc_derivatives", "op4_rans_token_files", "op5_grammar_secrets", "op6_pca_tiled_dedup"],
        ["op8_kmeans_tree_search", "op10_boosted_quality", "op11_era_collocations", "op12_midstate_manifest", "op13_boosted_toxicity"],
        ["op7_superminhash_dedup", "pipeline"],
    ],
)
def test_workers_need_no_package(tmp_path, names):
    # Neither the working folder nor PYTHONPATH leads to the package; only the driver knows where it is.
    script = SCRIPT.format(root=str(ROOT), work=str(tmp_path / "work"), names=names)
    import os

    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert all(name in done.stdout for name in names)
