"""Table-level sources: existence, optional reads, pruned and catalog reads.

Paths go through the Hadoop FileSystem of the session, so the same code
works on local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob_matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a Hadoop glob (empty list when none)."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return [] if st is None else [s.getPath().toString() for s in st]


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    """A small text file (bookkeeping: no job is started for it)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def leaf_files(spark: SparkSession, path: str) -> list[str]:
    """Every data file under a file or folder path (hidden ones left out)."""
    fs, p = _fs(spark, path)
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in f[len(path.rstrip("/")):].split("/") if part):
            out.append(f)
    return sorted(out)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file (None when empty)."""
    fs, p = _fs(spark, path)
    io = spark.sparkContext._jvm.java.io
    reader = io.BufferedReader(io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def first_data_file(spark: SparkSession, path: str) -> str | None:
    """Some Parquet data file under ``path`` (None when there is none). Listing
    stops at the first; empty folders, partition folders included, hold none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    it = fs.listFiles(p, True)
    while it.hasNext():
        rel = it.next().getPath().toString()
        name = rel.rsplit("/", 1)[-1]
        if name.endswith(".parquet") and not name.startswith(("_", ".")) and "/_temporary/" not in rel:
            return rel
    return None


def table_exists(spark: SparkSession, path: str) -> bool:
    """A Parquet table exists at ``path``: some data file lies under it."""
    return first_data_file(spark, path) is not None


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_optional_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read a Parquet table if present, else a typed empty frame.

    Only absence is tolerated; any other error (bad schema, corrupt file)
    surfaces. The contract schema fixes column order and types either way.
    """
    st = spark.createDataFrame([], schema).schema
    if not table_exists(spark, path):
        return empty_frame(spark, st)
    df = spark.read.parquet(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])


def scan_partition_pruned(spark: SparkSession, path: str, column: str, values) -> DataFrame:
    """Scan of a partitioned Parquet table restricted to some partition
    values; the filter is a partition filter, so other folders are not read."""
    vals = list(values)
    return spark.read.parquet(path).where(F.col(column).isin(vals))


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a table registered in the session catalog."""
    return spark.table(name)
