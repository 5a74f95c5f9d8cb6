"""Landing-zone readers for partner feeds and internal change files.

A landing file belongs to an arrival date named in its path: the feed's
file prefix followed by the date, dashed or compact (``telco_a_20240115`` or
``telco_a_2024-01-15``). One scan covers any set of arrival dates; the date
is taken from ``_metadata.file_path`` per row, so listing and reading stay
distributed and many days load in one job.
"""

from __future__ import annotations

import datetime as _dt
import re
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import FeedSpec
from .tables import first_line, glob_matches, leaf_files


# A landing name carries its arrival date after the prefix: telco_a_20240115
# or telco_a_2024-01-15, as a folder (batch=...) or a file of its own.
ARRIVAL_TOKEN = r"_(\d{4}-?\d{2}-?\d{2})"


def _token_date(token: Column) -> Column:
    return F.try_to_date(F.nullif(F.regexp_replace(token, "-", ""), F.lit("")), "yyyyMMdd")


def arrival_date_from_path(prefix: str) -> Column:
    """Arrival date encoded in the file path after the prefix."""
    return _token_date(F.regexp_extract(F.col("_metadata.file_path"), prefix.replace(".", r"\.") + ARRIVAL_TOKEN, 1))


def arrival_date_of_any(path: Column) -> Column:
    """Arrival date of a landing path of any feed or table: the last dated
    folder or file name in it. NULL when no name carries a date."""
    dated = r"(?:^|.*[/=])[A-Za-z0-9]+(?:_[A-Za-z0-9]+)*?" + ARRIVAL_TOKEN + r"(?=[/._]|$)"
    return _token_date(F.regexp_extract(path, dated, 1))


def _tokens(dates) -> list[str]:
    out = []
    for d in dates:
        d = d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))
        out += [d.strftime("%Y%m%d"), d.isoformat()]
    return out


def landing_paths(spark: SparkSession, folder: str, prefix: str, dates=None, file_glob: str | None = None) -> list[str]:
    """Entries to scan: all that carry the prefix, or only those whose name
    carries one of the arrival dates. Folders count whatever is in them; of
    single files only those that match ``file_glob``. Empty when nothing
    landed (source skipped)."""
    if dates is None:
        found = glob_matches(spark, f"{folder}/*{prefix}_*")
    else:
        alts = ",".join(_tokens(dates))
        found = glob_matches(spark, f"{folder}/*{prefix}_{{{alts}}}*")
    if file_glob is None:
        return found
    name = lambda p: p.rstrip("/").rsplit("/", 1)[-1]
    return [p for p in found if "." not in name(p) or fnmatch(name(p), file_glob)]


def all_string_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def scan_csv_feed(spark: SparkSession, root: str, feed: FeedSpec, dates=None) -> DataFrame | None:
    """Delimited feed, every column as text, plus ``file_arrival_date``.

    Columns go by each file's own header, so files may add columns (kept as
    text) or order them differently; a file that lacks a contract column is an
    error. Files with equal headers are read by one scan; only first lines
    pass through the driver.
    """
    paths = landing_paths(spark, f"{root}/{feed.operator_code}", feed.operator_code, dates, feed.file_glob)
    files = [f for p in paths for f in leaf_files(spark, p)]
    by_header: dict[tuple, list[str]] = {}
    sep = feed.csv_options.get("sep", ",")
    for f in files:
        line = first_line(spark, f)
        if line:
            names = tuple(n.strip().strip('"') for n in line.lstrip("\ufeff").split(sep))
            by_header.setdefault(names, []).append(f)
    out = None
    for names, group in sorted(by_header.items()):
        lacking = [c for c in feed.raw_columns if c not in names]
        if lacking:
            raise ValueError(f"{group[0]} lacks the contract columns {lacking}")
        part = (spark.read.options(**feed.csv_options).option("enforceSchema", "false")
                .schema(all_string_schema(names)).csv(group)
                .withColumn("file_arrival_date", arrival_date_from_path(feed.operator_code)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return None
    extra = [c for c in out.columns if c not in feed.raw_columns and c != "file_arrival_date"]
    return out.select(*feed.raw_columns, *extra, "file_arrival_date")


def _with_unlisted(spark: SparkSession, paths: list[str], contract: StructType) -> StructType:
    """The contract plus every other field that occurs in the files, as text.
    The names come from one pass over the files."""
    seen = (spark.read.option("recursiveFileLookup", "true").option("primitivesAsString", "true")
            .json(paths).schema)
    extra = [f.name for f in seen.fields if f.name not in contract.fieldNames()]
    return StructType(contract.fields + all_string_schema(extra).fields)


def _scan_json(spark: SparkSession, paths: list[str], contract: StructType, prefix: str) -> DataFrame:
    schema = _with_unlisted(spark, paths, contract)
    df = spark.read.option("recursiveFileLookup", "true").schema(schema).json(paths)
    return df.withColumn("file_arrival_date", arrival_date_from_path(prefix))


def scan_json_feed(spark: SparkSession, root: str, feed: FeedSpec, dates=None) -> DataFrame | None:
    """JSON-lines feed as text: numbers keep their source text, and fields the
    contract does not list are kept as text too."""
    paths = landing_paths(spark, f"{root}/{feed.operator_code}", feed.operator_code, dates, feed.file_glob)
    if not paths:
        return None
    return _scan_json(spark, paths, all_string_schema(feed.raw_columns), feed.operator_code)


def scan_feed(spark: SparkSession, root: str, feed: FeedSpec, dates=None) -> DataFrame | None:
    """Dispatch on the feed's format; an unknown format is an error."""
    if feed.file_format == "csv":
        return scan_csv_feed(spark, root, feed, dates)
    if feed.file_format == "json":
        return scan_json_feed(spark, root, feed, dates)
    raise ValueError(f"unsupported file_format {feed.file_format!r} for {feed.operator_code}")


def scan_json_cdc(spark: SparkSession, root: str, folder: str, schema: StructType, dates=None,
                  operators=None) -> DataFrame | None:
    """Internal change files (JSON lines) read with the table's contract
    schema, so a file whose key column is all NULL types the same as others;
    fields beyond the contract are kept as text. With ``operators``, the files lie in
    one folder per operator, named ``folder`` and the operator, which gives ``operator_code``:
    one scan reads them all."""
    folders = [folder] if operators is None else [f"{folder}_{op}" for op in operators]
    paths = [p for f in folders for p in landing_paths(spark, f"{root}/{f}", f, dates, f"{f}_*.json")]
    if not paths:
        return None
    if operators is None:
        return _scan_json(spark, paths, schema, folder)
    some = "|".join(map(re.escape, operators))
    df = _scan_json(spark, paths, schema, f"{folder}_(?:{some})")
    return df.withColumn("operator_code", F.regexp_extract(F.col("_metadata.file_path"), f".*/{folder}_({some})/", 1))
