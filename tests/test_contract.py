"""The driver contract: bench.py prints one JSON line; every oracle has a query."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_REPEAT="1", BENCH_DUCKDB="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "delays_by_state", "cohort"],
                         env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["metric"] and result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"delays_by_state", "cohort"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert set(result["duckdb"]) == {"delays_by_state", "cohort"}


def test_oracles_with_pyspark_from_its_zip():
    """``spark-submit`` imports pyspark from ``pyspark.zip``, without a jars folder
    beside it; every oracle must still be built."""
    import glob

    import pyspark

    home = os.path.dirname(pyspark.__file__)
    libs = glob.glob(os.path.join(home, "python", "lib", "*.zip"))
    assert any(p.endswith("pyspark.zip") for p in libs)
    code = ("import pyspark; assert 'pyspark.zip' in pyspark.__file__, pyspark.__file__; "
            "import __spark_entry__ as e; print(len(e.oracle_sql()))")
    env = dict(os.environ, SPARK_HOME=home, PYTHONPATH=os.pathsep.join([*libs, ROOT]))
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=ROOT, capture_output=True,
                         text=True, timeout=300, check=True)
    assert int(out.stdout.strip().splitlines()[-1]) == len(entry.oracle_sql())
