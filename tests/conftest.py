import contextlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from nightledger.session import build_session
    s = build_session("local[4]", app="nightledger-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/events.parquet"):
        pytest.skip("driver test data not present")
    return SF_SMALL


@pytest.fixture(scope="session")
def many_ranges(spark):
    """Within it small tables too are cut into as many ranges as there are shuffle partitions."""
    @contextlib.contextmanager
    def cut():
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            yield
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return cut
