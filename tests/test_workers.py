"""Queries run in a fresh process of another folder: workers get the package from the session alone."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

SCRIPT = """
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
qs = entry.queries()
for name in {names!r}:
    if name in qs:
        print(name, qs[name](spark, {sf!r}).count())
"""

NAMES = ["magic_check", "verdict", "scrape_hook", "blocklog_extract", "blocklog_stream",
         "op3_license_scan", "op4_quality", "op5_bpe", "op6_toxicity"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_queries_from_an_empty_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    if "PYTHONPATH" in os.environ:  # Spark itself may come from there
        keep = [p for p in os.environ["PYTHONPATH"].split(os.pathsep) if os.path.abspath(p or ".") != REPO]
        env["PYTHONPATH"] = os.pathsep.join(keep)
    script = SCRIPT.format(entry=os.path.join(REPO, "__spark_entry__.py"), names=NAMES, sf=SF)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    done = dict(line.split() for line in out.stdout.splitlines() if line.split()[0:1] and line.split()[0] in NAMES)
    assert {"magic_check", "verdict", "scrape_hook", "blocklog_extract", "blocklog_stream"} <= set(done)
    assert all(int(n) > 0 for n in done.values())


def test_the_zip_can_be_imported(spark, tmp_path):
    """The archive that executors get holds importable packages."""
    code = "import sys; sys.path.insert(0, sys.argv[1]); import sweepframe.operators.validate as v; print(v.__file__)"
    out = subprocess.run([sys.executable, "-c", code, spark.sparkContext._sweepframe_pyfile], cwd=tmp_path,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and ".zip" in out.stdout, out.stderr[-500:]
