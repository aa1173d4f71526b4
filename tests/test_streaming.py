from pyspark.sql import functions as F

from tallgrass.streaming import incremental_landing, landed


def test_landing_processes_only_new_files(spark, scratch):
    df = spark.range(20).select(F.col("id"), (F.col("id") * 2).alias("v"))
    df.repartition(2).write.parquet(f"{scratch}/in")
    args = (spark, f"{scratch}/in", df.schema, f"{scratch}/out", f"{scratch}/_ckpt")
    assert incremental_landing(*args).rows == 20
    assert incremental_landing(*args).rows == 0
    spark.range(20, 25).select(F.col("id"), (F.col("id") * 2).alias("v")).write.mode("append").parquet(f"{scratch}/in")
    assert incremental_landing(*args).rows == 5
    assert landed(spark, f"{scratch}/out", df.schema).count() == 25
