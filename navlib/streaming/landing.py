"""Follow a landing folder of feed files with Structured Streaming.

New files are read as text, parsed (OP01) and appended idempotently (OP05)
in ``foreachBatch``.  A batch replayed after a failure adds nothing and
refreshes the master again, whatever its load id, since ingest appends only
keys that differ from their current version; the file source's checkpoint
records which files were taken.  ``availableNow`` processes what has landed
and stops, which suits a daily schedule; a processing-time trigger keeps the
query running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from navlib.sources.feed import parse_nav_text
from navlib.sources.store import ingest_nav


def follow_landing(
    spark: SparkSession,
    landing_dir: str,
    nav_path: str,
    master_path: str | None = None,
    checkpoint_location: str | None = None,
    house_map: DataFrame | None = None,
    available_now: bool = True,
    processing_time: str = "1 hour",
    max_files_per_trigger: int | None = None,
    newest_path: str | None = None,
) -> StreamingQuery:
    """Start the landing-folder ingest; returns the running query."""
    # next to the table, so that a restarted query finds its progress again (the
    # session's checkpoint folder is a new one for every application)
    location = checkpoint_location or f"{nav_path.rstrip('/')}_stream"
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_dir)

    def _batch(batch: DataFrame, epoch_id: int) -> None:
        ingest_nav(parse_nav_text(batch, house_map), nav_path, master_path, newest_path=newest_path)

    writer = lines.writeStream.foreachBatch(_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
