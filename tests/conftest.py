import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bazaar.session import get_spark
    s = get_spark("local[4]", app="bazaar-tests", shuffle_partitions=4,
                  # several tasks even for the tiny tables of the tests
                  **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                     "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"},
                  **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bazaar-test-ckpt-")})
    yield s
    s.stop()
