import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="sluice-test-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder, as the cluster would via spark.checkpoint.dir
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_root(spark):
    from sluice.session import scratch_path
    return scratch_path(spark, "test")


@pytest.fixture(scope="session")
def tiny(spark):
    """FIXTURES.md §4: (id, quantity, address, date)."""
    import datetime as dt
    d = dt.date
    rows = [(1, 10, "Texas", d(2024, 1, 1)), (2, -1, "Washington", d(2024, 1, 1)), (3, None, None, d(2024, 1, 1)),
            (None, 5, "Texas", d(2024, 1, 1)), (None, 6, "Texas", d(2024, 2, 1)), (3, 7, "Texas", d(2026, 2, 1))]
    return spark.createDataFrame(rows, "id bigint, quantity int, address string, date date")


@pytest.fixture(scope="session")
def tiny_rules():
    from sluice.functions.rules import Rule
    return [Rule("id_not_null", "id IS NOT NULL"), Rule("validQuantity", "quantity > 0"),
            Rule("validAddress", "address in ('Texas')"),
            Rule("dateWithinRange", "date between '2020-01-01' and '2025-01-01'")]
