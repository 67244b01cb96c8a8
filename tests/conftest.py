import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from farelens.session import build_session

    scratch = tempfile.mkdtemp(prefix="farelens-tests-")
    spark = build_session(
        "local[*]",
        app_name="farelens-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.farelens.storage.root": os.path.join(scratch, "storage"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def scratch_root(spark):
    from farelens.session import storage_root

    return storage_root(spark)
