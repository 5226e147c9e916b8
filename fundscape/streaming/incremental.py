"""Incremental loads as streams: keyed upserts of monthly values and windowed counts of log events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.files import shared_path, stored


def _parts(target: str):
    """A writer of each batch's rows to its own part of a table; a batch that is repeated replaces its part."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return write


def _run(spark: SparkSession, rows: DataFrame, mode: str, target: str, offsets: str) -> DataFrame:
    """Run a stream to its source's present end; the parts written so far, with their ``batch``. A later call with the
    same folders goes on where this one ended."""
    nothing = spark.createDataFrame([], rows.schema)
    nothing.write.mode("overwrite").parquet(f"{target}/batch=-1")
    query = rows.writeStream.foreachBatch(_parts(target)).outputMode(mode).option("checkpointLocation", offsets).trigger(availableNow=True).start()
    query.awaitTermination()
    schema = nothing.withColumn("batch", F.lit(0).cast("long")).schema
    return spark.read.schema(schema).parquet(target)


CHANGES = "isin long, date date, nav double, at timestamp"


STATE = f"{CHANGES}, seen timestamp"


def open_months(kept: DataFrame, new: DataFrame, reopen: int, idle_days: int) -> DataFrame:
    """(isin, date, nav, at, seen, fresh, opened): of each fund and month the latest of the ``kept`` values, (isin, date, nav, at,
    seen), and of the (isin, at, nav) rows of a batch.

    ``fresh`` marks values that the batch changes: those later than the one kept (equal times: larger), and those of a month
    that is closed already, as nothing is kept to compare them with: where the table is read the later value wins. ``opened``
    marks what stays in the state: a fund's newest month and ``reopen`` months before it, so a fund takes a few numbers however
    long its history. Funds that bring nothing for ``idle_days`` leave the state, which costs no value for the same reason.
    """
    last = new.where("at is not null").groupBy("isin", F.last_day("at").alias("date")).agg(F.max(F.struct("at", "nav")).alias("v"))
    both = kept.select("isin", "date", "at", "nav", "seen", F.lit(True).alias("known"))
    both = both.unionByName(last.select("isin", "date", "v.at", "v.nav", F.current_timestamp().alias("seen"), F.lit(False).alias("known")))
    # Of equal values the kept one, which is no change.
    v = both.groupBy("isin", "date").agg(F.max(F.struct("at", "nav", "known")).alias("v"), F.max("seen").alias("seen"))
    fund = Window.partitionBy("isin")
    opened = (F.col("date") > F.last_day(F.add_months(F.max("date").over(fund), -reopen - 1))) & (F.max("seen").over(fund) > F.current_timestamp() - F.make_dt_interval(F.lit(idle_days)))
    return v.select("isin", "date", "v.nav", "v.at", F.max("seen").over(fund).alias("seen"), (~F.col("v.known")).alias("fresh"), opened.alias("opened"))


def _upserts(target: str, state: str, reopen: int, idle_days: int):
    """A writer of what each batch changes. The state after batch n lies in ``state/after=n``; a batch that is repeated reads
    the state before it again, which is kept until the next one ends."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at = {int(n.split("=")[1]): path for n, path in _folders(spark, state).items() if n.startswith("after=")}
        before = max((n for n in at if n < number), default=None)
        kept = spark.createDataFrame([], STATE) if before is None else spark.read.schema(STATE).parquet(f"{state}/after={before}")
        rows = stored(open_months(kept, batch, reopen, idle_days), "nav-batch")
        _parts(target)(rows.where("fresh").select("isin", "date", "nav", "at"), number)
        rows.where("opened").select("isin", "date", "nav", "at", "seen").write.mode("overwrite").parquet(f"{state}/after={number}")
        for n, path in at.items():
            if before is not None and n < before:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return write


def _folders(spark: SparkSession, target: str) -> dict[str, object]:
    """The parts of a table by name, with their paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return {f.getPath().getName(): f.getPath() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}


def _current(spark: SparkSession, target: str) -> tuple[list[str], int, list[str]]:
    """(the parts that count: the last whole compaction and the batches after it; the last batch; parts that no longer count)."""
    names = list(_folders(spark, target))
    number = lambda n: int(n.split("=")[1])
    whole = max((number(n) for n in names if n.startswith("upto=") and "_SUCCESS" in _folders(spark, f"{target}/{n}")), default=None)
    batches = [n for n in names if n.startswith("batch=")]
    used = [n for n in batches if whole is None or number(n) > whole] + ([f"upto={whole}"] if whole is not None else [])
    return used, max((number(n) for n in batches), default=-1 if whole is None else whole), [n for n in names if n not in used]


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """(isin, date, nav, at): the parts that count, of each fund and month the latest value."""
    used = _current(spark, target)[0]
    if not used:
        return spark.createDataFrame([], CHANGES)
    rows = spark.read.schema(CHANGES).parquet(*[f"{target}/{n}" for n in used])
    return rows.groupBy("isin", "date").agg(F.max_by("nav", F.struct("at", "nav")).alias("nav"), F.max("at").alias("at"))


def compact(spark: SparkSession, target: str) -> None:
    """Merge all parts into one; the old ones go once it is whole. Broken off anywhere, the table reads the same."""
    last = _current(spark, target)[1]
    read_upserted(spark, target).select("isin", "date", "nav", "at").write.mode("overwrite").parquet(f"{target}/upto={last}")
    folders = _folders(spark, target)
    for name in _current(spark, target)[2]:
        folders[name].getFileSystem(spark._jsc.hadoopConfiguration()).delete(folders[name], True)


def upsert_stream(spark: SparkSession, source: str, schema: str, *, target: str | None = None, offsets: str | None = None, files_per_batch: int = 2, reopen: int = 2, idle_days: int = 90, most_parts: int = 16) -> DataFrame:
    """(isin, date, nav): monthly last values of (isin, at, nav) files read batch by batch; the last write wins.

    Keyed state (see ``open_months``) lets a batch write only the values that it changes, as one part; a repeated batch replaces
    its part. Once there are more than ``most_parts`` they are compacted, so a read costs the table and a few parts, however
    many batches there were. All state lies in ``target`` and ``offsets``, so a restarted stream keeps the earlier table.
    """
    target, offsets = target or shared_path(spark, "nav-state"), offsets or shared_path(spark, "nav-offsets")
    state = f"{offsets}/kept"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source).select("isin", "at", "nav")
    spark.createDataFrame([], CHANGES).write.mode("overwrite").parquet(f"{target}/batch=-1")
    spark.createDataFrame([], STATE).write.mode("ignore").parquet(f"{state}/after=-1")
    write = _upserts(target, state, reopen, idle_days)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", offsets).trigger(availableNow=True).start()
    query.awaitTermination()
    if len(_current(spark, target)[0]) > most_parts:
        compact(spark, target)
    return read_upserted(spark, target).select("isin", "date", "nav")


def log_counts(spark: SparkSession, source: str, schema: str, *, window: str = "1 day", late: str = "2 days", target: str | None = None, offsets: str | None = None) -> DataFrame:
    """(start, status, n): tumbling counts of (ts, status) events. Every batch writes the counts that it changed, so open
    windows are in the result as well; the watermark only bounds the state that is kept."""
    target, offsets = target or shared_path(spark, "log-counts"), offsets or shared_path(spark, "log-offsets")
    events = spark.readStream.schema(schema).parquet(source).withWatermark("ts", late)
    counts = events.groupBy(F.window("ts", window), "status").agg(F.count("*").alias("n"))
    parts = _run(spark, counts.select(F.col("window.start").alias("start"), "status", "n"), "update", target, offsets)
    return parts.groupBy("start", "status").agg(F.max_by("n", "batch").alias("n"))
