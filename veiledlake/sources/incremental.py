"""Reading each input file once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from veiledlake.storage import read_text


# Longer than any file can be old: Spark itself would pass over files after a week.
NO_LIMIT = "36500000d"


def read_new(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    checkpoint: str,
    handle: Callable[[DataFrame, str, int], None],
    max_files_per_batch: int | None = None,
    max_file_age: str | None = None,
) -> None:
    """Hand all files not seen yet to ``handle``, as one or more batches, and return.

    ``handle`` gets the rows, the id of this reader, which lasts as long as its
    checkpoint, and the batch number. After a failure it may get the same
    batch again, with the same id and number.

    Every file is read, however old its change time. The driver keeps the names
    of all files read. ``max_file_age`` bounds that list, at a price: files
    older than this, counted back from the newest, are then passed over for good.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age or NO_LIMIT)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def on_batch(batch: DataFrame, number: int) -> None:
        reader_id = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
        handle(batch, reader_id, number)

    query = (
        reader.parquet(path)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
