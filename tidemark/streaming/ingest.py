"""Streams into bronze: JSON messages and landing CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.clock import use_utc
from tidemark.operators.ingest import skip_ingested_files
from tidemark.plans.warehouse import Warehouse


def _load_label(batch: DataFrame, batch_id: int) -> str:
    """The same for every replay of a batch, and another one for every new checkpoint."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"stream_{query_id}_{batch_id:08d}"


def _start(stream: DataFrame, load_batch, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Progress is committed after the batch is written: at least once, and loads make a replay harmless."""
    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def messages_to_bronze(
    warehouse: Warehouse, messages: DataFrame, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the well-formed messages of a stream with a ``value`` column, set the others aside.

    By default reads what is there and ends, in batches as the source limits them (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``). Batches are labelled ``stream_<query>_<batch>`` and have a row in the warehouse's ledger.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load = _load_label(batch, batch_id)
        warehouse.append_messages(batch, load)

    return _start(messages, load_batch, checkpoint, trigger)


def arriving_files(spark: SparkSession, directory: str, archive_dir: str | None = None, **options: str) -> DataFrame:
    """Stream of the names (``path, _file_name``) of CSV files that land in a directory; their content is not read.

    Files of finished batches move to ``archive_dir``. ``options`` go to the source, such as ``maxFilesPerTrigger``.
    """
    listed = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(listed).option("pathGlobFilter", "*.csv").option("fileNameOnly", True)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.options(**options).load(directory).select("path", F.substring_index("path", "/", -1).alias("_file_name"))


def csv_to_bronze(
    warehouse: Warehouse,
    directory: str,
    checkpoint: str,
    archive_dir: str | None = None,
    trigger: dict | None = None,
    on_bad_row: str = "quarantine",
    on_bad_layout: str = "quarantine",
    **options: str,
) -> StreamingQuery:
    """Append landing files as they come; files whose name the ledger already holds are passed over.

    Each batch goes the way of ``Warehouse.load_files``: by its header's names, rows that do not fit to quarantine, and
    files without the required columns line by line as well, so that one odd file stops neither the others nor the
    query. ``options`` go to the source, such as ``maxFilesPerTrigger``; a batch's file names pass the driver.
    """
    use_utc(warehouse.spark)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = skip_ingested_files(batch, warehouse.ledger.read())
        paths = [r["path"] for r in fresh.select("path").collect()]
        warehouse.load_files(paths, None, on_bad_row=on_bad_row, on_bad_layout=on_bad_layout)

    return _start(arriving_files(warehouse.spark, directory, archive_dir, **options), load_batch, checkpoint, trigger)
