import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from priceflow.session import get_spark
    session = get_spark("local[2]", app="priceflow-tests", shuffle_partitions=4, driver_memory="4g")
    yield session
    session.stop()


@pytest.fixture
def rows_of(spark):
    """Evaluate column expressions over a small literal table."""
    def run(data, schema, **exprs):
        df = spark.createDataFrame(data, schema)
        return [r.asDict() for r in df.select(*[e.alias(k) for k, e in exprs.items()]).collect()]
    return run
