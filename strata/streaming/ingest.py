"""Incremental CSV landing-folder -> bronze table ingest (at least once, restartable).

Re-reading every landed file on each daily run grows with history; the file
stream source remembers processed files in its checkpoint, so each run reads
only new drops.  ``trigger(availableNow=True)`` processes everything available
in bounded micro-batches and stops, which fits a scheduled batch job.

Batches are appended by the ordinary table writer, so the table carries no sink log and batch jobs may append to
or overwrite it between runs.  The last batch of each stream is kept as a table property, named by the id in the checkpoint's
metadata (every fresh checkpoint has its own, even at the path of an old one): a batch that is replayed after it was
recorded is skipped; only a run killed between an append and its record appends that one batch again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import create_table
from ..sources.csv import CORRUPT_COL, READ_OPTIONS, SOURCE_COL, with_corrupt, write_quarantine


def ingest_incremental(spark: SparkSession, landing_dir: str, schema: T.StructType, table: str, *,
                       checkpoint: str, table_comment: str | None = None,
                       max_files_per_trigger: int | None = None, quarantine: str | None = None) -> str:
    """Append every not-yet-ingested CSV file under ``landing_dir`` to ``table``; returns the checkpoint used.

    Pass the same ``checkpoint`` (a shared folder) on every run; a fresh one ingests the whole folder again.  With ``quarantine``
    lines that do not parse go to that table instead, with their file, as in the batch ingest.
    """
    if not spark.catalog.tableExists(table):
        create_table(spark, table, schema, table_comment)

    def append(batch: DataFrame, batch_id: int) -> None:
        mark = f"strata.stream.{_stream_id(spark, checkpoint)}"
        done = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        if int(done.get(mark, -1)) < batch_id:
            if quarantine:
                batch = batch.persist()  # both tables are written from one read of the files
                write_quarantine(batch, table, quarantine)
                batch.where(F.col(CORRUPT_COL).isNull()).select(*schema.fieldNames()).write.insertInto(table)
                batch.unpersist()
            else:
                batch.write.insertInto(table)
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{mark}' = '{batch_id}')")

    reader = spark.readStream.schema(with_corrupt(schema) if quarantine else schema).options(**READ_OPTIONS).option("recursiveFileLookup", "true")
    if quarantine:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    source = reader.csv(landing_dir)
    if quarantine:
        source = source.select("*", F.col("_metadata.file_path").alias(SOURCE_COL))
    q = (source.writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).foreachBatch(append).start())
    q.awaitTermination()
    return checkpoint


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the checkpoint's stream, which Spark writes there before the first batch."""
    return json.loads("".join(r[0] for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()))["id"]
