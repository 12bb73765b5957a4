import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellscope.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_spark("local[4]", 4, app_name="cellscope-tests",
                  extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples, sorted."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
