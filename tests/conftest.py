import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimspark.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="claimspark-tests-")
    s = get_session("local[4]", app_name="claimspark-tests", shuffle_partitions=4,
                    conf={"spark.local.dir": scratch, "spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s
    s.stop()


def rows(df, order=None):
    if order:
        df = df.orderBy(*order)
    return [tuple(r) for r in df.collect()]
