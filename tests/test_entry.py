import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
CODE = """
import sys; sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert e.entry(spark).count() > 0
q, o = e.queries(), e.oracle_sql()
assert set(o) <= set(q) and "rain_fortnight_total" in o
assert q["zonal_exact_coverage"](spark, "/root/testdata/sf0.001").count() > 0
print("LLM", sum(n.startswith("op") for n in q), "pipeline" in q)
"""


def run(repo, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(repo=str(repo))], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.split("LLM")[-1].split()


def test_entry_from_any_folder(tmp_path):
    """Workers get the package although the working folder isn't the repository."""
    got = run(REPO, tmp_path)
    assert got[0] in ("0", "13")


def test_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    assert run(copy, copy) == ["0", "False"]
