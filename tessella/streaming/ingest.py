"""An extension: detections that arrive as files, merged image by image as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.naming import image_prefix
from ..plans.pipelines import merge_detections
from ..schema import DETECTION


#: Most images of a batch that are named in the filter of the store.
NAMED = 1000


def arriving_detections(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the CSV files that appear in ``folder``, with each row's image."""
    rows = spark.readStream.schema(DETECTION).option("header", True).option("maxFilesPerTrigger", files_per_trigger).csv(folder)
    return rows.withColumn("image_id", image_prefix(F.col("tile")))


def merge_arriving(stream: DataFrame, store: str, checkpoint: str, **merge: float) -> StreamingQuery:
    """Appends each batch to ``store`` by image, then merges anew the images it touched into ``store``-merged.

    A batch replayed after a failure replaces its own rows, so results are exactly once.
    """

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("image_id", "batch").parquet(store)
        touched = batch.select("image_id").distinct()
        names = [r[0] for r in touched.limit(NAMED + 1).collect()]
        # With a schema, as else a folder's name such as "007" would be read as a number.
        every = spark.read.schema(T.StructType([*batch.schema, T.StructField("batch", T.LongType())])).parquet(store)
        # Named images are folders of the store: the others are not read.
        if len(names) <= NAMED and None not in names:
            every = every.filter(F.col("image_id").isin(names))
        else:
            every = every.join(touched, every["image_id"].eqNullSafe(touched["image_id"]), "left_semi")
        det_id = F.xxhash64(*DETECTION.names)
        merged = merge_detections(every.dropDuplicates(["image_id", *DETECTION.names]).withColumn("det_id", det_id), **merge)
        merged.drop("det_id", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("image_id").parquet(f"{store}-merged")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
