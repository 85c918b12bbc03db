import pytest

from brindle.sources.tables import SCHEMAS, read

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table", sorted(SCHEMAS))
def test_declared_schema_is_the_stored_one(spark, table):
    stored = spark.read.parquet(f"{BASE}/{table}.parquet")
    assert read(spark, BASE, table).dtypes == stored.dtypes
