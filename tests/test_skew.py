"""One part and one supplier hold a third of all order lines."""

import shutil

import pytest
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries

# Join partitions this small and uneven count as skewed, and no side is broadcast.
FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("part", "supplier", "nation", "region"):
        shutil.copy(f"{SMALL}/{name}.parquet", folder)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    hot = F.col("l_orderkey") % 3 == 0
    parts = lines.withColumns(
        {
            "l_partkey": F.when(hot, 7).otherwise(F.col("l_partkey")).cast("bigint"),
            "l_suppkey": F.when(hot, 3).otherwise(F.col("l_suppkey")).cast("bigint"),
        }
    )
    parts.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.fixture(params=["usual", "forced"])
def settings(spark, request):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for key, value in FORCED.items():
        if request.param == "forced":
            spark.conf.set(key, value)
    yield request.param
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name", ["feature_table", "duplicate_rows", "top_items_by_volume", "wrmsse_units", "missing_steps"]
)
def test_hot_keys_change_no_result(spark, skewed, settings, name):
    con = connect(skewed)
    con.execute(f"CREATE VIEW lineitem AS FROM read_parquet('{skewed}/lineitem.parquet/*.parquet')")
    assert differences(queries()[name](spark, skewed), oracle_sql()[name], con) == []
