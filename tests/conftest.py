import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def source(spark):
    """Build an Erp from rows: ``source(variant, relation=("ddl", [rows]))``."""
    from quayside.sources.catalog import Catalog, Erp

    def build(variant="19", languages=("en_US",), price_key=None, **relations):
        made = {name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in relations.items()}
        return Erp(Catalog({n: (lambda df=df: df) for n, df in made.items()}), variant, languages, price_key)

    return build
