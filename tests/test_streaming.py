from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shelfmark.sources.catalog import Catalog
from shelfmark.streaming import folds

SCHEMA = StructType([StructField("k", StringType()), StructField("name", StringType()), StructField("price", DoubleType())])


def land(spark, folder, part, rows):
    temp = f"{folder}-temp"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(temp)
    import glob
    import os
    import shutil

    os.makedirs(folder, exist_ok=True)
    shutil.move(glob.glob(f"{temp}/part-*.parquet")[0], f"{folder}/{part}.parquet")


def test_stream_folds_like_batches(spark, tmp_path):
    folder, catalog = f"{tmp_path}/parts", Catalog(spark, f"file://{tmp_path}/cat")
    land(spark, folder, "2024-01-02", [("a", "x", 1.0), ("b", "y", 2.0)])
    go = lambda: folds.fold_stream(folds.parts_stream(spark, folder, SCHEMA), catalog, "t", ["k"], ["name", "price"], f"{tmp_path}/cp").awaitTermination()
    go()
    land(spark, folder, "2024-01-03", [("a", "", 5.0)])
    land(spark, folder, "2024-01-01", [("b", "late", 9.0)])
    go()
    assert {tuple(r) for r in catalog.table("t").collect()} == {("a", "x", 5.0), ("b", "y", 2.0)}


def test_weekly_window_begins_on_monday(spark, tmp_path):
    folder = f"{tmp_path}/w"
    spark.createDataFrame([("2024-01-03 10:00:00", "s", 2.0), ("2024-01-08 00:00:00", "s", 3.0)], "ts string, k string, v double").select(F.to_timestamp("ts").alias("ts"), "k", "v").write.parquet(folder)
    stream = spark.readStream.schema("ts timestamp, k string, v double").parquet(folder)
    q = folds.weekly(stream, "ts", ["k"], "v").writeStream.outputMode("complete").format("memory").queryName("weekly").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {str(r["week"])[:10]: r["total"] for r in spark.table("weekly").collect()}
    assert got == {"2024-01-01": 2.0, "2024-01-08": 3.0}


def test_price_events_keep_state(spark, tmp_path):
    folder = f"{tmp_path}/p"
    land(spark, folder, "1", [("a", "", 1.0)])
    def go():
        stream = folds.parts_stream(spark, folder, SCHEMA)
        q = folds.price_events(stream, "k", "price").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination()

    go()
    land(spark, folder, "2", [("a", "", 3.0), ("b", "", 4.0)])
    go()
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {("a", "new", None, 1.0), ("a", "price", 1.0, 3.0), ("b", "new", None, 4.0)}
