import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.session.timeZone": "UTC"}
    session = SparkSession.builder.master("local[8]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
