"""Pages made of the customers' rows: however few files hold the rows, all cores read pages."""

import pytest
from pyspark.sql import functions as F

from sluice.plans import built


@pytest.mark.parametrize("name", ["built_content", "built_lists", "built_metadata"])
def test_pages_of_one_row_group_are_read_by_many_tasks(spark, tmp_path, name):
    rows = spark.range(400).select(F.col("id").alias("c_custkey"), F.concat(F.lit("Customer "), "id").alias("c_name"), F.lit("BUILDING").alias("c_mktsegment"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    tasks = built.QUERIES[name](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(t["count"] for t in tasks) == 400
    assert len(tasks) >= 4 and max(t["count"] for t in tasks) <= 110
