"""Incremental matching of a growing inventory (an extension: batch semantics, record by record, no state)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from typolens.functions.domains import address_matching_sld
from typolens.functions.keys import strip
from typolens.operators.match import match_inventory


def new_addresses(spark: SparkSession, folder: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """Files that arrive in ``folder`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def match_stream(addresses: DataFrame, keywords: DataFrame, out: str, checkpoint: str, available_now: bool = True, suffixes: list[str] | None = None) -> StreamingQuery:
    """Matches each micro-batch with the static keywords and appends the rows under the batch's number.

    A batch that is repeated after a failure overwrites its own folder, so every address counts once per batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        a = batch.select(strip(F.col("address")).alias("address")).dropDuplicates(["address"]).withColumn("address_sld", address_matching_sld(F.col("address"), suffixes)).filter("address_sld != ''")
        match_inventory(keywords, a, suffixes=suffixes).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = addresses.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
