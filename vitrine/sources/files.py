"""Drop files in, extract and report files out."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..functions.derive import as_number
from ..functions.text import rating_number, timestamp
from ..schemas import TABLES, drop_schema
from ..session import stored

log = logging.getLogger(__name__)

# File name stamp and timestamp text of the exports.
STAMP = "%Y%m%d_%H%M%S"
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
CORRUPT = "_corrupt_record"


def read_json_drops(spark: SparkSession, schema: StructType, *paths: str, lines: bool = False) -> DataFrame:
    """Files with a JSON array of records each (`lines`: one record per line), plus `_file` and `_corrupt_record`.

    A file that is no JSON gives one row with only those two columns set.
    """
    wide = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    return (spark.read.schema(wide).option("multiLine", not lines).option("columnNameOfCorruptRecord", CORRUPT)
            .json(list(paths)).withColumn("_file", F.col("_metadata.file_path")))


def read_parquet_drops(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    """Parquet files as text or typed columns of `schema`, plus `_file` and `_corrupt_record`.

    Files may differ in their columns and in the columns' types: they are read in groups of one layout each. A file
    that cannot be read gives one row with only the last two columns set.
    """
    return read_inspected(spark, schema, inspect_files(list_files(spark, list(paths), "*.parquet")))


def inspect_files(files: DataFrame) -> DataFrame:
    """(_file, layout, problem) per file of `files` (`_file`): the columns and types of a Parquet file, or whether a JSON
    file holds one record per line. A task opens each file for its first bytes or its footer only."""
    def look(name: str) -> tuple[str, str | None]:
        system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name) if ":/" in name else f"file://{name}")
        with system.open_input_file(path) as stream:
            if name.endswith(".parquet"):
                try:
                    return "parquet " + ", ".join(f"{f.name} {f.type}" for f in pq.read_schema(stream)), None
                except (pa.ArrowInvalid, OSError) as error:
                    return "unreadable", f"not readable as Parquet: {error}"
            head = stream.read(1 << 16).lstrip(b"\xef\xbb\xbf \t\r\n")
            if not head:
                return "lines", None
            first = head.split(b"\n", 1)[0]
            if head[:1] != b"{" or len(first) == len(head) == 1 << 16:
                return ("array" if head[:1] == b"[" else "lines"), None
            try:
                json.loads(first)
                return "lines", None
            except ValueError:  # an object over several lines, or a bad first line before good ones
                rest = [line for line in head.split(b"\n")[1:-1] if line.startswith(b"{")]
                return ("lines" if rest else "array"), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [look(name) for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (names, *zip(*found))] if names else
                                             [pa.array([], pa.string())] * 3, names=["_file", "layout", "problem"])
    return files.select("_file").mapInArrow(run, "_file string, layout string, problem string")


def read_inspected(spark: SparkSession, schema: StructType, inspected: DataFrame) -> DataFrame:
    """The rows of inspected files, a group of files per layout. What reaches the driver is the list of files, as it
    does in every read of a folder."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType()), StructField("_file", StringType())])
    parts = [spark.createDataFrame([], wide)]
    for group in inspected.groupBy("layout").agg(F.collect_list("_file").alias("files"), F.collect_list("problem").alias("problems")).collect():
        if group.layout == "unreadable":
            bad = spark.createDataFrame(list(zip(group.problems, group.files)), f"{CORRUPT} string, _file string")
            parts.append(bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], CORRUPT, "_file"))
        elif group.layout in ("array", "lines"):
            parts.append(read_json_drops(spark, schema, *group.files, lines=group.layout == "lines"))
        else:
            own = spark.read.parquet(*group.files)
            parts.append(own.select(*[
                F.col(f.name).cast(f.dataType).alias(f.name) if f.name in own.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema.fields], F.lit(None).cast("string").alias(CORRUPT), F.col("_metadata.file_path").alias("_file")))
    return reduce(DataFrame.unionByName, parts[1:] or parts)


def list_files(spark: SparkSession, folder: str | list[str], pattern: str) -> DataFrame:
    """The paths of the files below `folder` whose names match `pattern`; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
            .load(folder).select(F.col("path").alias("_file")))


def coerce_to_raw(df: DataFrame, shop: str) -> DataFrame:
    """Text columns of drop rows in the types of the shop's raw table; bad numbers and times become NULL.

    Fractions of counts are cut off; a number too large for its column becomes NULL.
    """
    def typed(field):
        kind = field.dataType.simpleString()
        if field.name not in df.columns:
            value = F.lit(None)
        elif field.name == "rating":
            words = F.col("rating").cast("string")
            value = F.coalesce(as_number(df, field.name), rating_number(words).cast("double"))
        elif kind == "timestamp":
            value = timestamp(F.col(field.name))
        elif kind == "string":
            value = F.col(field.name).cast("string")
        else:
            value = as_number(df, field.name)
        return value.try_cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in TABLES[f"raw.{shop}"].schema.fields])


def read_shop_drops(spark: SparkSession, data_dir: str, shop: str) -> DataFrame | None:
    """All drop files of a shop below `<data_dir>/<shop>` (`*.json`, `*.jsonl`, `*.parquet`) as text rows, or None without
    any. What a JSON file holds, an array or lines, is read from it, not from its name."""
    folder = f"{data_dir}/{shop}"
    if not _any(spark, folder):
        return None
    inspected = stored(inspect_files(list_files(spark, folder, "*.{json,jsonl,parquet}")), "inspected")
    return None if inspected.isEmpty() else read_inspected(spark, drop_schema(shop), inspected)


def _any(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def export_items(df: DataFrame, output_dir: str, shop: str, run_time: datetime,
                 formats: tuple[str, ...] = ("json", "parquet")) -> list[str]:
    """Write items as `<shop>/<shop>_<stamp>.jsonl` and `.parquet`; nothing for no items.

    The JSON copy is written from the Parquet one, so the items are computed once. Without a Parquet copy (not
    wanted, or failed, which is logged) it is written from the items.
    """
    if df.isEmpty():
        return []
    base, written = f"{output_dir}/{shop}/{shop}_{run_time.strftime(STAMP)}", []
    rows = df
    if "parquet" in formats:
        try:
            df.write.parquet(f"{base}.parquet")
            rows = df.sparkSession.read.schema(df.schema).parquet(f"{base}.parquet")
            written.append(f"{base}.parquet")
        except Exception as error:
            if "json" not in formats:
                raise
            log.error("parquet export of %s failed: %s", shop, error)
    if "json" in formats:
        rows.write.option("ignoreNullFields", False).json(f"{base}.jsonl")
        written.append(f"{base}.jsonl")
    return written


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, timestamps in ISO form."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", ISO_OUT).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, NULLs written, timestamps in ISO form."""
    (df.write.mode("overwrite").option("ignoreNullFields", False).option("timestampFormat", ISO_OUT).json(path))
