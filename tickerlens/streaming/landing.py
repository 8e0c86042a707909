"""Landing: a message stream into raw text files (JOB-10, SNK-7, STM-10).

The text sink with a checkpoint replaces the consumer loop: offsets are
committed with the files of each micro-batch (no commit-before-flush gap,
quirk Q14), files roll at ``max_records_per_file`` lines, and each line goes
under the folder of its time block (DAT-8 label). ``land_by_bytes`` rolls by
bytes instead, into files named ``<block>_<n>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlens.functions.timefn import floor_minutes, wall_clock_instant
from tickerlens.session import session_conf, start_stream


def land_raw(stream: DataFrame, path: str, checkpoint: str, block_minutes: int = 15,
             max_records_per_file: int = 100_000, time_col: str | None = None,
             available_now: bool = True, processing_time: str = "60 seconds",
             state_partitions: int | None = None):
    """Start the landing query; ``time_col`` names an arrival-time column
    (e.g. the bus ``timestamp``), else processing time labels the block."""
    t = F.col(time_col).cast("timestamp_ntz") if time_col else F.localtimestamp()
    out = stream.select(F.col("value").cast("string").alias("value"),
                        floor_minutes(t, block_minutes).alias("block"))
    w = (out.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
         .option("maxRecordsPerFile", max_records_per_file).partitionBy("block"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return start_stream(w, stream.sparkSession, state_partitions)


#: Fixed value: a landed file is closed once it holds this many bytes.
ROLL_BYTES = 10_000_000


def byte_files(lines: DataFrame, time: Column, block_minutes: int = 15, max_bytes: int = ROLL_BYTES,
               deals: int = 16) -> DataFrame:
    """``value`` and ``file``, ``<block>_<n>``: the lines of a time block, cut
    where its running bytes (a line end each) pass a multiple of ``max_bytes``,
    so a file ends at most one line beyond its share.

    Lines run in the order of seconds; those of one second are dealt over
    ``deals`` slices by hash, so a busy second is not one task. Slices are summed
    first, running sums over a block's slices give the offsets, and each slice
    runs on from its own: no block is gathered in one place."""
    t = lines.select(F.col("value").cast("string").alias("value"), time.cast("timestamp_ntz").alias("_t")).where(F.col("_t").isNotNull())
    cut = t.select("value", "_t", floor_minutes(F.col("_t"), block_minutes).alias("block"),
                   F.unix_seconds(wall_clock_instant(F.col("_t"))).alias("_s"),
                   F.pmod(F.xxhash64("value"), F.lit(deals)).alias("_d"),
                   (F.octet_length("value") + 1).cast("long").alias("_b"))
    # One struct is the key, which is never null: no filters of the join go down into the scan.
    cut = cut.withColumn("_key", F.struct("block", "_s", "_d"))
    keys = ["block", "_s", "_d"]
    sums = cut.groupBy(*keys).agg(F.sum("_b").alias("_sum"))
    across = Window.partitionBy("block").orderBy("_s", "_d").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.struct(*keys).alias("_key"), F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_key").orderBy("_t", "value").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_b").over(inside), F.lit(0))
    number = F.floor(start / max_bytes).cast("string")
    return cut.join(offsets, "_key").select("value", F.concat_ws("_", "block", number).alias("file"))


def write_byte_files(files: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder a file of ``byte_files``, with the one text file in it. Tasks
    move their own files to their place (version 2 of the commit), since the
    driver would take one folder after the other."""
    (files.repartition("file").write.mode(mode).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy("file").text(path))


def read_byte_files(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and ``file`` of the files in ``path``; many folders are listed
    by a few tasks each, not by a task a folder."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    with session_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": tasks}):
        return spark.read.schema("value string, file string").text(path)


def land_by_bytes(stream: DataFrame, path: str, checkpoint: str, block_minutes: int = 15,
                  max_bytes: int = ROLL_BYTES, time_col: str | None = None, available_now: bool = True,
                  processing_time: str = "60 seconds", state_partitions: int | None = None):
    """``land_raw`` with files that roll by bytes. Each micro-batch numbers its
    files from 0 under its own folder ``batch=<id>``, which a replay writes anew.
    Without ``time_col`` the start of the micro-batch labels its lines."""
    t = F.col(time_col) if time_col else F.current_timestamp()
    stamped = stream.select("value", t.cast("timestamp_ntz").alias("_t"))

    def land(batch: DataFrame, batch_id: int) -> None:
        write_byte_files(byte_files(batch, F.col("_t"), block_minutes, max_bytes), f"{path}/batch={batch_id}")

    w = stamped.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return start_stream(w, stream.sparkSession, state_partitions)
