import os
import sys

import pytest
from helpers import DATA

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (HERE, f"{HERE}/tests", os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    place = tmp_path_factory.mktemp("spark")
    settings = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": f"file:{place}/warehouse",
    }
    session = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con
