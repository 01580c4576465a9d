import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tagloom.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]")
         .appName("tagloom-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="tagloom-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tagloom-test-", dir="/tmp")


@pytest.fixture(scope="session", autouse=True)
def one_replay_per_table():
    """Queries that read the full state share one replay per fixture and options (the replay itself is compared once)."""
    from tagloom.plans import queries
    from tagloom.session import cut_lineage

    real, known = queries._full_state, {}

    def shared(spark, sf, **options):
        key = (sf, tuple(sorted(options.items())))
        if key not in known:
            known[key] = cut_lineage(real(spark, sf, **options), "shared-state")
        return known[key]

    queries._full_state = shared
    yield
    queries._full_state = real
