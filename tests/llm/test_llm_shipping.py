"""Tasks find the package wherever the driver was started."""

import os
import subprocess
import sys
import zipfile

import tagloom
from tagloom.llm import batches

JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from tagloom.session import local_session
from tagloom.llm import packing
spark = local_session(1, 1, scratch=sys.argv[2])
docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
print("ROWS", packing.pack(docs).count())
"""


def test_a_job_started_elsewhere(tmp_path):
    root = os.path.dirname(os.path.dirname(tagloom.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", JOB, root, str(tmp_path / "scratch")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in out.stdout, out.stderr[-2000:]


def test_shipped_once(spark):
    batches.ship_package(spark)
    before = list(spark.sparkContext._python_includes)
    batches.ship_package(spark)
    assert spark.sparkContext._python_includes == before and before.count(batches.PACKAGE) == 1
    path = next(os.path.join(p) for p in sys.path if os.path.basename(p) == batches.PACKAGE)
    assert "tagloom/llm/batches.py" in zipfile.ZipFile(path).namelist()
