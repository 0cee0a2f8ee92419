"""Micro-batch intake of landing files into bronze."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fabspark.session import drop_path, scratch, settled
from fabspark.sources.events import parse_events, rejected_events
from fabspark.sources.files import conform, read_landing, with_ingest_meta, with_source_file
from fabspark.sources.tables import batch_path, overwrite_batch, run_id


def stream_landing(spark: SparkSession, base: str, schema: T.StructType, max_files: int = 5) -> DataFrame:
    """New landing files, at most ``max_files`` per trigger, with their file name."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
         .option("basePath", base).parquet(base))
    return with_source_file(s)


def stream_messages(spark: SparkSession, path: str, max_files: int = 5) -> DataFrame:
    """Event messages as text, however late; see ``accept``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def _day() -> Column:
    """Landing day of a file by its path; empty for a path without one."""
    day = r"year=(\d+)/month=(\d+)/day=(\d+)"
    return F.concat_ws("-", *(F.nullif(F.regexp_extract("file_path", day, i), F.lit("")) for i in (1, 2, 3)))


def accept(messages: DataFrame, root: str, run: str, batch_id: int,
           place: Callable[[str], str] | None = None) -> DataFrame:
    """The announcements of a micro-batch whose files are new; nothing is too late.

    Accepted paths are kept in ``root/accepted`` by landing day, and only the days
    in the batch are looked up. Messages that cannot be read go to
    ``root/rejected`` with a reason. With ``place``, which says where a path lies,
    announcements of files that are not there go there too; they are not accepted,
    so announcing them anew once they are there works. Both tables are written under
    the batch's id, which a replay leaves out of the lookup and replaces. The new
    paths of one micro-batch pass the driver, so the trigger's size bounds them.
    """
    spark = messages.sparkSession
    rejected = rejected_events(messages).withColumn("reason", F.lit("names no file"))
    e = parse_events(messages).withColumn("generated_at", F.try_to_timestamp("generation_timestamp")) \
        .withColumn("landing_day", _day())
    first = Window.partitionBy("file_path").orderBy(F.col("generated_at").asc_nulls_last(), "line_id")
    new = settled(e.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn"), "messages")
    schema = "file_path string, landing_day string, run string, batch_id string"
    own = batch_path(f"{root}/accepted", run, batch_id)
    drop_path(spark, own)
    days = [r[0] for r in new.select("landing_day").distinct().collect()]  # few: those that files landed on
    if exists(spark, f"{root}/accepted"):
        known = spark.read.schema(schema).parquet(f"{root}/accepted").filter(F.col("landing_day").isin(days)) \
            .select("file_path")
        new = new.join(known, "file_path", "left_anti")
    new = settled(new, "accepted")
    if place is not None:
        absent = [(r[0],) for r in new.select("file_path").collect() if not exists(spark, place(r[0]))]
        gone = spark.createDataFrame(absent, "file_path string")
        rejected = rejected.unionByName(gone.select(F.col("file_path").alias("message"), F.lit("file not found").alias("reason")))
        new = new.join(gone, "file_path", "left_anti") if absent else new
    overwrite_batch(rejected, f"{root}/rejected", run, batch_id)
    new.select("file_path", "landing_day").write.mode("overwrite").partitionBy("landing_day").parquet(own)
    return new


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingest_messages(messages: DataFrame, root: str, bronze: str, base: str, schema: T.StructType, checkpoint: str,
                    version: str, every: str | None = None,
                    after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Message-driven intake: read exactly the files announced, conform them, append them to bronze, then call ``after``.

    Announced paths may be relative to ``base``. Files that are not there are
    rejected, the others of the batch are read.
    """
    def place(p: str) -> str:
        return p if p.startswith(("/", base)) or "://" in p else f"{base}/{p}"

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id(spark, checkpoint)
        with scratch(spark):
            full = [place(r[0]) for r in accept(batch, root, run, batch_id, place).select("file_path").collect()]
            if full:
                rows = with_source_file(read_landing(spark, sorted(full), base, schema))
                rows = conform(rows, T.StructType([*schema.fields, T.StructField("source_file", T.StringType())]))
                overwrite_batch(with_ingest_meta(rows, version), bronze, run, batch_id)
        if full and after is not None:
            after(spark.read.parquet(batch_path(bronze, run, batch_id)), batch_id)

    return start(messages, work, checkpoint, every)


def start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
          every: str | None = None) -> StreamingQuery:
    """Run ``work`` per micro-batch, until the input is used up or on a clock."""
    w = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    return w.start()


def ingest(stream: DataFrame, bronze: str, checkpoint: str, version: str,
           after: Callable[[DataFrame, int], None] | None = None, every: str | None = None) -> StreamingQuery:
    """Append each micro-batch to bronze with lineage, then call ``after``.

    A batch is written as its own folder under the stream's id, so a batch
    replayed after a failure replaces itself, and a second stream into the same
    table replaces nothing of the first.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id(spark, checkpoint)
        overwrite_batch(with_ingest_meta(batch, version), bronze, run, batch_id)
        if after is not None:
            after(spark.read.parquet(batch_path(bronze, run, batch_id)), batch_id)

    return start(stream, work, checkpoint, every)
