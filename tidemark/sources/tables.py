"""Tables on disk: event tables, aggregates, CSV lookups, and their writers."""

from __future__ import annotations

import secrets
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import EVENTS, GRANULARITIES, YEARLY, Granularity
from tidemark.sources.dump import decode_all


def read_events(spark: SparkSession, base: str, table: str, where: Column | None = None) -> DataFrame:
    """An event table; `where` reaches the scan."""
    df = spark.read.parquet(f"{base}/{table}")
    return df if where is None else df.filter(where)


PARTS = ("metric", "level", "year")


def level_of(code: Column) -> Column:
    """The name of a granularity's code."""
    return F.coalesce(*[F.when(code == g.code, F.lit(g.name)) for g in GRANULARITIES])


def read_aggregate(spark: SparkSession, base: str, metric: str, g: Granularity) -> DataFrame:
    """One metric at one granularity; both are partitions, so other files are not opened."""
    df = spark.read.parquet(f"{base}/aggregates")
    return df.filter((F.col("metric") == metric) & (F.col("level") == g.name)).drop(*PARTS)


def write_aggregates(aggregates: DataFrame, base: str, overwrite: bool = False) -> None:
    """Rows of (metric, granularity, ..) as one table by metric, level and year (of 365 days from the epoch)."""
    parted = aggregates.withColumns({"level": level_of(F.col("granularity")), "year": F.floor(F.col("time") / YEARLY.millis).cast("int")})
    # one shuffle, so that a task writes few files; adaptive execution splits a hot metric over tasks
    write_table(parted.hint("rebalance", *PARTS), f"{base}/aggregates", overwrite, by=PARTS)


def write_table(df: DataFrame, path: str, overwrite: bool = False, by: tuple[str, ...] = ()) -> None:
    """Parquet; an existing path is an error unless it may be overwritten."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_events(fields: DataFrame, base: str, overwrite: bool = False) -> None:
    """One table for each event type of a dump's split lines, which are first written by type, so each table reads its own lines."""
    spark, lines = fields.sparkSession, f"{base}/_lines"
    write_table(fields.hint("rebalance", "type"), lines, True, by=("type",))
    try:
        for table, df in decode_all(spark.read.schema(fields.schema).parquet(lines)).items():
            write_table(df, f"{base}/{table}", overwrite)
    finally:
        remove(spark, lines)


def write_sorted(df: DataFrame, path: str, by: tuple[str, ...] = ("userId", "time"), find: tuple[str, ...] = ("userId",), group_bytes: int = 8 << 20) -> None:
    """A table in order of `by`, in row groups of about `group_bytes` with bloom filters of the columns `find`.

    A read of one user, or of a span of one user's time, then skips the files and row groups that can't hold it.
    """
    writer = df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("errorifexists").option("parquet.block.size", group_bytes)
    for column in find:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int = 64, by: str = "userId") -> DataFrame:
    """df as the catalog's table `name` with its files in `path`, dealt by a hash of `by`: windows and joins by it need no further shuffle."""
    df.repartition(buckets, by).write.option("path", path).bucketBy(buckets, by).sortBy(by).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, under a given schema."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(key, category) from columns 2 and 3 of a headless CSV; short lines are skipped, of equal keys the last in the file counts."""
    cells = F.split("value", ",")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    rows = lines.select(F.get(cells, F.lit(1)).alias("key"), F.get(cells, F.lit(2)).alias("category"), "file", "line").filter("category is not null")
    return rows.groupBy("key").agg(F.max_by("category", F.struct("file", "line")).alias("category"))


def write_csv(df: DataFrame, path: str, mode: str = "ignore") -> None:
    """CSV with a header; an existing path is left alone unless the mode says otherwise."""
    df.write.mode(mode).option("header", True).csv(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder, if there is one."""
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str, force: bool = False) -> bool:
    """Rename; with `force` what stood at the target is deleted first."""
    fs, p = _fs(spark, source)
    if force:
        remove(spark, target)
    return fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target))


def copy(spark: SparkSession, source: str, target: str) -> bool:
    fs, p = _fs(spark, source)
    other, q = _fs(spark, target)
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, other, q, False, spark._jsc.hadoopConfiguration())


def random_name(length: int = 12) -> str:
    """Letters and digits, for a folder of one's own."""
    return "".join(secrets.choice(string.ascii_lowercase + string.digits) for _ in range(length))


def make_temporary(spark: SparkSession, base: str) -> str:
    """A new folder below `base`, hidden from readers of it."""
    folder = f"{base}/_tmp-{random_name()}"
    make_folder(spark, folder)
    return folder


def copy_to_temporary(spark: SparkSession, source: str, folder: str) -> str:
    """A copy of a file or table under its own name in `folder`; tables are copied by a job, files as they are."""
    name = source.rstrip("/").rsplit("/", 1)[1]
    fs, p = _fs(spark, source)
    if fs.getFileStatus(p).isDirectory() and not name.endswith(".csv"):
        spark.read.parquet(source).write.parquet(f"{folder}/{name}")
    else:
        copy(spark, source, f"{folder}/{name}")
    return f"{folder}/{name}"


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers find the old one or the new one, whole."""
    beside = f"{path}.{random_name()}"
    fs, p = _fs(spark, beside)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(p, jvm.org.apache.hadoop.fs.Path(path), options)


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(1 << 20)).decode()
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


EVENT_TABLES = tuple(dict.fromkeys(name for name, _ in EVENTS.values()))
