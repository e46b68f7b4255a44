"""Jobs that need Python in tasks must run where only the driver has the package."""

import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
from pyspark.sql import SparkSession
from cuota.sources.workbooks import read_workbooks
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("links", module.queries()["link_first"](spark, "/root/testdata/sf0.001").count())
print("rows", read_workbooks(spark, sys.argv[2]).count())
"""


def test_entry_loaded_by_path_from_another_folder(tmp_path):
    from test_workbooks import workbook

    (tmp_path / "b.xlsx").write_bytes(workbook({"A": [["x"], ["y", 1]]}))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py"), str(tmp_path / "b.xlsx")],
                         cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "links 100" in run.stdout and "rows 2" in run.stdout, run.stderr[-2000:]
