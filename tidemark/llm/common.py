"""Shared pieces: staged tables, projections of inputs, Arrow batch helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_RUN = f"tidemark-{uuid.uuid4().hex}"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Where a session on a local master has none (tests) a temporary folder is set; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = f"file://{folder}"
    return f"{folder}/{_RUN}"


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session has ended before Python did
        pass


_cleaned: set[str] = set()
_path_of: dict[int, tuple[DataFrame, str]] = {}  # of staged tables, by the DataFrame's identity


def staged(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors. group_bytes: of a row group, which a task holds."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if folder not in _cleaned:
        _cleaned.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("compression", "zstd")
    (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _path_of[id(out)] = (out, path)
    return out


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again: what was made of them has been written."""
    for df in tables:
        _, path = _path_of.pop(id(df), (None, None))
        if path:
            _remove(df.sparkSession, path)


def row_key(docs: DataFrame) -> Column:
    """128 bits of a row's id and text: rows that share it are equal in both."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary")))


SMALL = 100_000  # rows of a few numbers that may be broadcast


def joinable(table: DataFrame, most: int = SMALL, otherwise: str = "merge") -> DataFrame:
    """A staged table as the right side of a join: broadcast if it has at most `most` rows, else joined by a shuffle.

    Rows are counted, as the size of a compressed file bounds no memory. otherwise: "merge", or "shuffle_hash" where
    the left side is too wide to sort and the table's rows are narrow.
    """
    return F.broadcast(table) if table.count() <= most else table.hint(otherwise)


SIEVE_BITS = 1 << 27  # 16 MB, of 4 KB a row


def sieve(rows: DataFrame, key: str, keys: DataFrame, least: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among `keys`, the others), so that a join with `keys` need shuffle only the former.

    keys: a staged table with the same column, without repeats. A bitmap of 16 bits a counted key, SIEVE_BITS at most, is
    broadcast; where it would hold less than two bits a key all rows may be among them. Null keys are among the others.
    """
    n = keys.count()
    bits = min(SIEVE_BITS, max(least, 1 << (16 * n).bit_length()))
    if n > bits // 2:
        return rows, rows.limit(0)
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    own, chunk, bit = (fresh(rows, x) for x in ("_chunk", "_bits", "_bit"))
    maps = keys.select(place.alias(bit)).groupBy(F.bitmap_bucket_number(bit).alias(own)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias(chunk))
    marked = rows.withColumn(bit, F.when(F.col(key).isNotNull(), place)).withColumn(f"{own}_", F.bitmap_bucket_number(bit))
    marked = marked.join(F.broadcast(maps), F.col(f"{own}_") == F.col(own), "left")
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col(chunk), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    found = marked.withColumn(chunk, there).drop(bit, own, f"{own}_")
    return found.filter(F.col(chunk)).drop(chunk), found.filter(~F.col(chunk)).drop(chunk)


def without(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """rows whose key is not in the one column of the staged `keys`; only those that may be are shuffled. Null keys stay."""
    own = fresh(rows, "_key")
    kind = keys.schema[0].dataType
    cast, gone = rows.withColumn(own, F.col(key).cast(kind)), keys.toDF(own)
    if keys.count() <= SMALL:
        return cast.join(F.broadcast(gone), own, "left_anti").drop(own)
    may, others = sieve(cast, own, gone)
    return others.unionByName(may.join(gone, own, "left_anti")).drop(own)


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, body): the id and the UTF-8 bytes of the whole text, null as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layout(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow binary column, without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, at, data = column.buffers()
    n = len(column)
    if at is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def blocks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `most` bytes (a longer row alone): (lo, hi, bytes, offsets from 0)."""
    buf, offsets = layout(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi, buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
