from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.plans.fixtures import event_log


def test_offsets_are_dense_and_no_window_holds_the_rows_of_a_partition(spark):
    log = event_log(spark, "/root/testdata/sf0.001")
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(topic" in plan and "_hour" in plan.split("row_number() windowspecdefinition(", 1)[1].split("timestamp", 1)[0]
    own = Window.partitionBy("topic", "partition").orderBy("timestamp", "event_id")
    assert log.withColumn("want", F.row_number().over(own) - 1).where("not offset <=> want").count() == 0
    assert log.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
