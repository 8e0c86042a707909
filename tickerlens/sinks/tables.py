"""Result-table sinks (SNK-1..4, SNK-10..13).

Serving tables become Parquet directories partitioned for their read path
(slices of tickers for series and bars, time parts for rankings) and clustered inside
each file the way the store clustered rows. Keyed replacement rewrites the blocks
of time that a batch touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlens.functions.timefn import grain_columns, normalize_grain
from tickerlens.operators.mentions import FOLDS, fold_series, mention_series

# Rows per output file; keeps files bounded when one ticker or hour is hot.
MAX_RECORDS_PER_FILE = 5_000_000


def time_block(grain: str) -> Column:
    """The block of time that a bucket's rows are stored with: hours for
    seconds, days up to hours, months for days, years beyond."""
    parts = list(grain_columns(grain))
    n = {"SEC": 4, "MIN": 3, "HR": 3, "DAY": 2}.get(normalize_grain(grain), 1)
    return F.concat_ws("-", *[F.lpad(F.col(c).cast("string"), 4 if c == "year" else 2, "0") for c in parts[:n]])


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], sort_by: list, block: list[str],
                      mode: str = "overwrite", max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Partitioned Parquet write. Rows are first spread by the partition
    columns and ``block``, a coarser part of the key: a cold folder gets one
    file a block, and a hot one is split over as many tasks as it has blocks.
    Each task sorts its rows by the partition columns, then the clustering
    order, and streams them out file by file."""
    (df.repartition(*partition_by, *block).sortWithinPartitions(*partition_by, *sort_by)
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partition_by).parquet(path))


def _block(grain: str) -> list[str]:
    """The two coarsest parts of a bucket: months (or ISO weeks) at most."""
    return list(grain_columns(grain))[:2]


#: Fixed value: tickers are dealt over so many folders, however many there are.
SLICES = 64


def ticker_slice(ticker) -> Column:
    """The folder of a ticker. A filter on it beside the one on the ticker opens this folder alone."""
    return F.pmod(F.crc32(F.encode(ticker, "UTF-8")), F.lit(SLICES)).cast("int")


def _write_by_ticker(rows: DataFrame, path: str, grain: str, mode: str) -> None:
    sliced = rows.withColumn("slice", ticker_slice(F.col("ticker")))
    write_partitioned(sliced, path, ["slice"], ["ticker", *[F.desc(c) for c in grain_columns(grain)]], _block(grain), mode)


def write_series(series: DataFrame, path: str, grain: str, mode: str = "overwrite") -> None:
    """Mention series, one folder per slice of tickers, by ticker and time
    descending inside (SNK-2, SRT-3). A folder per ticker took as many files as
    there are tickers, of a few rows each."""
    _write_by_ticker(series, path, grain, mode)


def write_all_grains(posts: DataFrame, path: str) -> dict[str, DataFrame]:
    """The six series tables ``<path>/<grain>``, MIN to YEAR (JOB-1, SNK-2).

    Posts are scanned and shuffled once, for the minutes; each coarser table
    folds from the one before it as stored, which is smaller at every step."""
    spark = posts.sparkSession

    def stored(series: DataFrame, grain: str) -> DataFrame:
        write_series(series, f"{path}/{grain}", grain)
        return spark.read.schema(series.schema).parquet(f"{path}/{grain}").select(*series.columns)

    tables = {"MIN": stored(mention_series(posts, "MIN"), "MIN")}
    for grain, finer in FOLDS:
        tables[grain] = stored(fold_series(tables[finer], finer, grain), grain)
    return tables


def write_bars(bars: DataFrame, path: str, grain: str, mode: str = "overwrite") -> None:
    """Price bars, one folder per slice of tickers, by ticker and time descending inside (SNK-1, SRT-3)."""
    _write_by_ticker(bars, path, grain, mode)


def write_trending(ranked: DataFrame, path: str, grain: str, mode: str = "overwrite") -> None:
    """Rankings, one folder per bucket, frequency descending inside (SNK-3, SRT-3)."""
    write_partitioned(ranked, path, list(grain_columns(grain)), [F.desc("frequency"), F.asc("ticker")], [], mode)


def write_colocated(df: DataFrame, table: str, path: str, buckets: int, keys: tuple[str, ...] = ("ticker", "epoch_ms")) -> DataFrame:
    """``df`` as the table ``table`` in ``path``, bucketed and sorted by ``keys``.

    Tables with the same keys and ``buckets`` join on all keys without an
    exchange. The time is a key too, so a ticker that holds a third of all rows
    is spread over all buckets, and Spark's default settings see the join as
    co-partitioned. Rows are dealt like the buckets first, so each bucket is one
    file. For one ticker, the row groups of others are skipped, since they are
    sorted by it."""
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def write_results(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Per-grain result files, written by the executors, never collected (SNK-11)."""
    df.write.mode("overwrite").format(fmt).save(path)


def compact_lines(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Merge many small landed text files (SNK-12). The scan packs small files
    into splits of ``spark.sql.files.maxPartitionBytes``, and each split
    becomes one file, so their number follows the size of the feed."""
    spark.read.text(src).write.mode("overwrite").text(dst)
    return spark.read.text(dst)


def show(df: DataFrame, n: int = 20) -> None:
    """Console sink (SNK-10)."""
    df.show(n, truncate=False)


def write_batch(df: DataFrame, path: str, batch_id: int, block: Column) -> None:
    """Append what a micro-batch finished, under ``block=<b>/batch_id=<n>``. A
    replay of the batch replaces exactly the folders it wrote before, and a
    filter on ``block`` opens the files of those blocks only."""
    rows = df.withColumns({"block": block, "batch_id": F.lit(int(batch_id)).cast("long")})
    (rows.hint("rebalance", F.col("block")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("block", "batch_id").parquet(path))


def make_folder(spark: SparkSession, path: str) -> None:
    """A table folder without files, so that it can be read before the first write."""
    spark.createDataFrame([], "value int, block int").write.mode("append").partitionBy("block").parquet(path)


class BlockTable:
    """A table with one live row per key (SNK-4, SNK-5), cut into blocks of time.

    ``block`` is a column of the keys (a day, say). Merging a batch reads the
    blocks that the batch touches, and only those, and writes them again with a
    dynamic partition overwrite. Each block has two generations,
    ``block=<b>/gen=<0|1>``, and a batch overwrites the one that does not hold
    the block's state before it. So

    * a write that is lost half-way never takes the state before it along;
    * a replayed batch starts from the same state and writes the same rows,
      also where it adds to what is there;
    * a read takes, of each block, the newest generation up to the last batch
      that is committed, and never part of a batch.

    Files per block, and bytes read per batch, don't grow with the number of
    batches. A frame from ``read`` is good until the second batch after it
    rewrites what it reads. A batch has to have a greater id than the one before.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], block: Column, schema: T.StructType):
        self.spark, self.keys, self.block = spark, list(keys), block.cast("string")
        self.data, self.marks = f"{path.rstrip('/')}/data", f"{path.rstrip('/')}/commits"
        self.columns = schema.names
        self.schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("block", T.StringType()), T.StructField("gen", T.IntegerType())])
        make_folder(spark, self.data)
        make_folder(spark, self.marks)

    def committed(self) -> int:
        """The last batch that is committed; -1 before the first."""
        marks = self.spark.read.schema("batch_id long, slot int").parquet(self.marks)
        last = marks.agg(F.max("batch_id")).first()[0]
        return -1 if last is None else last

    def _rows(self, upto: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.data).where(F.col("batch_id") <= upto)

    def read(self, blocks: tuple[str, str] | None = None) -> DataFrame:
        """The live rows; ``blocks`` (first, last) prunes the others' folders."""
        rows = self._rows(self.committed())
        if blocks is not None:
            rows = rows.where(F.col("block").between(*blocks))
        newest = rows.groupBy("block").agg(F.max("batch_id").alias("batch_id"))
        return rows.join(newest, ["block", "batch_id"], "left_semi").select(*self.columns)

    def merge(self, changed: DataFrame, batch_id: int, add: bool = False) -> None:
        """Replace the rows of equal keys by those of ``changed``, which has
        each key once; with ``add``, add its values to theirs.

        The labels of the blocks that the batch touches come to the driver, as
        many as it spans, so that the scan opens their live folders alone."""
        rows = changed.select(*self.columns).withColumn("block", self.block).persist()
        try:
            touched = [r["block"] for r in rows.select("block").distinct().collect()]
            if touched:
                self._rewrite(rows, touched, int(batch_id), add)
        finally:
            rows.unpersist()
        mark = self.spark.range(1).select(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit(int(batch_id) % 2).alias("slot"))
        mark.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(self.marks)

    def _rewrite(self, rows: DataFrame, touched: list[str], batch_id: int, add: bool) -> None:
        held = self._rows(batch_id - 1).where(F.col("block").isin(touched))
        live = {r["block"]: r["at"]["gen"] for r in held.groupBy("block").agg(F.max(F.struct("batch_id", "gen")).alias("at")).collect()}
        both = rows.select("block", *self.columns, F.lit(1).alias("_newer"))
        if live:
            folder = F.concat_ws("/", "block", F.col("gen").cast("string"))
            before = held.where(folder.isin([f"{b}/{g}" for b, g in live.items()]))
            both = before.select("block", *self.columns, F.lit(0).alias("_newer")).unionByName(both)
        values = [c for c in self.columns if c not in self.keys]
        made = [(F.sum(c) if add else F.max_by(F.col(c), F.col("_newer"))).alias(c) for c in values]
        first = F.col("block").isin([b for b, g in live.items() if g == 0])
        out = both.groupBy("block", *self.keys).agg(*made).select(
            *self.columns, F.lit(batch_id).cast("long").alias("batch_id"), "block", F.when(first, 1).otherwise(0).alias("gen"))
        # One file for a small block; a large one is split over as many tasks as it fills.
        (out.hint("rebalance", F.col("block")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("block", "gen").parquet(self.data))
