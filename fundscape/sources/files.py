"""Readers of time-series files, and where tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which driver and executors share; a temporary one in local runs only."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="spark-shared-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, however often it is used."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_keyed(rows: DataFrame, path: str, by: str, *keys: str) -> None:
    """Put ``rows`` into a table partitioned by ``by``: a row replaces the one of the same partition and keys, others stay.

    Only the partitions that ``rows`` has are read and rewritten (dynamic partition overwrite, moved into place when the
    job commits); no file of another one is touched. A run that is repeated leaves the same table. NaN counts as null, and of
    rows with equal keys one is kept, the one with the largest values.
    """
    spark = rows.sparkSession
    plain = [F.nanvl(c, F.lit(None)).alias(c) if t in ("double", "float") else F.col(c) for c, t in rows.dtypes]
    others = [c for c in rows.columns if c not in (by, *keys)]
    new = rows.select(*plain).groupBy(by, *keys).agg(F.max(F.struct(*others)).alias("_v")).select(by, *keys, "_v.*").select(*rows.columns)
    new = stored(new, "replacing")
    table = spark._jvm.org.apache.hadoop.fs.Path(path)
    if table.getFileSystem(spark._jsc.hadoopConfiguration()).exists(table):
        touched = [r[0] for r in new.select(by).distinct().collect()]  # partitions, not rows
        old = read_partitioned(spark, path, rows.schema).where(F.col(by).isin(touched) | F.col(by).isNull())
        new = old.join(new.select(by, *keys), [old[c].eqNullSafe(new[c]) for c in (by, *keys)], "left_anti").unionByName(new)
    new.repartition(by, F.pmod(F.xxhash64(*keys), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table written by partitions; a filter on them prunes folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def jdbc_run(spark: SparkSession, url: str, *statements: str, **properties: str) -> None:
    """SQL statements in one transaction of a database."""
    given = spark._jvm.java.util.Properties()
    for name, value in properties.items():
        given.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        work = connection.createStatement()
        for sql in statements:
            work.executeUpdate(sql)
        work.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def jdbc_sink(df: DataFrame, url: str, table: str, key: str, *, tasks: int = 16, **properties: str) -> None:
    """Put rows into a database table by ``key``: a row replaces the one with its key, others stay; a null key is an error.

    At most ``tasks`` connections write a staging table. Each write of a row has a name of its own, so that a task that runs
    twice leaves copies with different names; one transaction then moves one copy of each key and drops the staging table.
    Readers see all rows or none; a failed run leaves the table as it was and may be repeated. Of rows with equal keys one
    is kept.
    """
    spark, part = df.sparkSession, uuid.uuid4().hex[:10]
    staging, copy, index = f"{table}_{part}", f"copy_{part}", f"by_key_{part}"
    present = F.when(F.col(key).isNotNull(), F.col(key)).otherwise(F.raise_error(F.lit(f"{key} is null")).cast(df.schema[key].dataType))
    named = df.withColumn(key, present).repartition(tasks, key).withColumn(copy, F.reflect(F.lit("java.util.UUID"), F.lit("randomUUID")))
    df.where(F.lit(False)).write.jdbc(url, table, mode="append", properties=properties)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    try:
        named.write.option("createTableColumnTypes", f"{copy} VARCHAR(36)").jdbc(url, staging, mode="error", properties=properties)
        jdbc_run(
            spark, url, f'CREATE INDEX {index} ON {staging} ("{key}", "{copy}")',
            f'DELETE FROM {staging} WHERE EXISTS (SELECT 1 FROM {staging} x WHERE x."{key}" = {staging}."{key}" AND x."{copy}" < {staging}."{copy}")',
            f'DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} x WHERE x."{key}" = {table}."{key}")',
            f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}", **properties,
        )
    finally:
        jdbc_run(spark, url, f"DROP TABLE {staging}", **properties)


def jdbc_source(spark: SparkSession, url: str, table: str, key: str, *, tasks: int = 16, **properties: str) -> DataFrame:
    """A database table read through at most ``tasks`` connections, each for a range of a whole-number ``key``."""
    low, high = spark.read.jdbc(url, f'(SELECT MIN("{key}") AS low, MAX("{key}") AS high FROM {table}) ends', properties=properties).first()
    if low is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high + 1, numPartitions=tasks, properties=properties)


def database(spark: SparkSession) -> str | None:
    """The url that ``spark.fundscape.jdbc.url`` names; in local runs else a new embedded database; else none."""
    url = spark.conf.get("spark.fundscape.jdbc.url", None)
    if url or not spark.sparkContext.master.startswith("local["):
        return url
    path = shared_path(spark, "database").removeprefix("file:")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", path + ".log")
    return f"jdbc:derby:{path};create=true"


LOG = "event_id long, ts timestamp, status string, step string"


def append_log(rows: DataFrame, path: str, step: str) -> None:
    """Add (event_id, ts, status) rows of a step to a log; earlier rows stay."""
    rows.withColumn("step", F.lit(step)).select(*[F.col(c).cast(t) for c, t in (p.split(" ") for p in LOG.split(", "))]).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(path)


def time_value_csv(spark: SparkSession, path: str) -> DataFrame:
    """(date, value) of files with a point for missing values; rows without value are left out."""
    rows = spark.read.csv(path, schema="date date, value double", nullValue=".", mode="PERMISSIVE")
    return rows.where("value is not null")


def period_end(text: Column) -> Column:
    """Last day of ``YYYY``, ``YYYY-MM`` or ``YYYYQn``."""
    year, quarter = F.substring(text, 1, 4).try_cast("int"), F.regexp_extract(text, r"^\d{4}-?Q([1-4])$", 1).try_cast("int")
    month = F.regexp_extract(text, r"^\d{4}-(\d{2})$", 1).try_cast("int")
    return F.last_day(F.make_date(year, F.coalesce(month, quarter * 3, F.lit(12)), F.lit(1)))


def json_stat(payloads: DataFrame, column: str = "json") -> DataFrame:
    """(date, value) of payloads {"value": {index: number}, "time": {period: index}}."""
    parsed = payloads.select(F.from_json(column, "value map<string,double>, time map<string,int>").alias("p"))
    times = parsed.select("p.value", F.explode("p.time").alias("period", "index"))
    return times.select(period_end(F.col("period")).alias("date"), F.col("value")[F.col("index").cast("string")].alias("value")).where("value is not null")
