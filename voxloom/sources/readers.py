"""Scans with declared schemas; nothing is inferred from the data."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.functions.dates import epoch_to_ts, iso_to_ts, post_date_to_ts
from voxloom.operators.corpus import valid_labels
from voxloom.operators.shaping import union_by_name
from voxloom.schema import LABELLED_SCHEMA, REVIEW_SCHEMA, empty_frame, require_columns

RAW = "_raw_record"
HEADER_LINES = 100   # lines that the quoted names of a header may span
READERS = 16
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "mode": "PERMISSIVE"}


class NoInputError(ValueError):
    """No input at all was found."""


def input_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Data files of paths, folders and globs, by name; folders are read to their end.

    Names are listed by the file system itself, so any character may stand in them. Files that
    begin with ``_`` or ``.`` are no data. A path that matches nothing is an error.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def below(status, fs) -> list[str]:
        if not status.isDirectory():
            return [status.getPath().toString()]
        inside = [s for s in fs.listStatus(status.getPath()) if s.getPath().getName()[0] not in "_."]
        return [f for s in inside for f in below(s, fs)]

    found = []
    for one in [path] if isinstance(path, str) else path:
        at = hadoop.Path(one)
        fs = at.getFileSystem(conf)
        matches = fs.globStatus(at)
        if not matches:
            raise NoInputError(f"no files match {one}")
        found += [f for status in matches for f in below(status, fs)]
    return sorted(set(found))


def _first_record(spark: SparkSession, file: str) -> str:
    """The first line of a file, and those behind it while a quote is open. Reads no more than a buffer of it."""
    java, conf, at = spark._jvm.java.io, spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        lines = java.BufferedReader(java.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        record = lines.readLine() or ""
        for _ in range(HEADER_LINES):
            more = lines.readLine() if record.count('"') % 2 else None
            if more is None:
                return record
            record += "\n" + more
        return record
    finally:
        stream.close()


def csv_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the files that begin with them, in the order of the file names.

    Headers are read by the driver, which lists the files of any scan, some at a time: no pass over
    their bytes.
    """
    files = input_files(spark, path)
    with ThreadPoolExecutor(READERS) as pool:
        records = list(pool.map(lambda f: _first_record(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, record in zip(files, records, strict=True):
        names = tuple(next(csv.reader([record.lstrip("\ufeff")]), []))
        found.setdefault(names, []).append(file)
    return found


def _typed(c: Column, kind: T.DataType) -> Column:
    """A CSV field as its declared type; a date may be ISO, a forum date or epoch seconds."""
    if isinstance(kind, T.TimestampType):
        return F.coalesce(iso_to_ts(c), post_date_to_ts(c), epoch_to_ts(c.try_cast("double")))
    return c.try_cast(kind)


def _literal(path: str) -> str:
    """A path with no meaning as a glob."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _malformed(names: Sequence[str]) -> Column:
    """Why a record does not fit its header, null if it does.

    A quote that is never closed takes the lines behind it into its field: to the end of the file,
    or to the next quote, in which case the field keeps its opening quote and one of its lines has
    as many fields as a record.
    """
    def swallowed(field: Column) -> Column:
        lines = F.split(field, "\n")
        lines = F.slice(lines, 2, F.size(lines))
        return F.startswith(field, F.lit('"')) & F.exists(lines, lambda line: F.size(F.split(line, ",")) >= len(names))

    raw = F.col(f"`{RAW}`")
    quotes = F.length(raw) - F.length(F.replace(raw, F.lit('"'), F.lit("")))
    broken = reduce(lambda a, b: a | b, [F.coalesce(swallowed(F.col(f"`{n}`")), F.lit(False)) for n in names])
    return (F.when(broken | (raw.isNotNull() & (quotes % 2 == 1)), F.lit("broken quote"))
            .when(raw.isNotNull() & F.col(f"`{names[-1]}`").isNull(), F.lit("missing fields"))
            .when(raw.isNotNull(), F.lit("extra fields")))


def _csv_frames(spark: SparkSession, path: str | list[str], tolerant: bool) -> list[tuple[list[str], DataFrame]]:
    """Per header its names and one frame of strings, with ``_file``, ``_reason`` and ``_record`` of each row."""
    frames = []
    for names, files in csv_headers(spark, path).items():
        if not any(names):
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, RAW)])
        reader = spark.read.schema(schema).options(**CSV_OPTIONS, columnNameOfCorruptRecord=RAW)
        if tolerant:
            reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        rows = reader.csv([_literal(f) for f in files])
        record = F.coalesce(F.col(f"`{RAW}`"), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]), {"escape": '"'}))
        frames.append((list(names), rows.select(
            *[F.col(f"`{n}`") for n in names], F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))").alias("_file"),
            _malformed(names).alias("_reason"), record.alias("_record"))))
    return frames


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             tolerant: bool = False) -> DataFrame:
    """CSV files of a path, a list or a glob, united by column name; fields may span lines.

    Files may order their columns differently or lack some (null). A multi-line file is one task, so
    large corpora should be many files or Parquet. Malformed records fill what columns they can;
    ``tolerant`` leaves them out, as it does files that are corrupt or vanish. ``malformed_records``
    keeps the former and ``csv_report`` counts them per file.
    """
    frames = []
    for names, df in _csv_frames(spark, path, tolerant):
        rows = df.filter(F.col("_reason").isNull()) if tolerant else df
        frames.append(rows.select(*[
            (_typed(F.col(f"`{f.name}`"), f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]))
    return union_by_name(frames) if frames else empty_frame(spark, schema)


def malformed_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, reason, record) of every record that does not fit the header of its file."""
    frames = [df.filter(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_record").alias("record"))
        for _, df in _csv_frames(spark, path, True)]
    return union_by_name(frames) if frames else spark.createDataFrame([], "file string, reason string, record string")


def csv_report(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """(file, rows, bad_fields, bad_records): what each file gave, fields of well-formed records that do
    not fit their type, and malformed records.

    A file that cannot be read at all has no row here; compare with the listing.
    """
    counted = []
    for names, df in _csv_frames(spark, path, True):
        good = F.col("_reason").isNull()
        bad = [good & F.col(f"`{f.name}`").isNotNull() & _typed(F.col(f"`{f.name}`"), f.dataType).isNull()
               for f in schema.fields if f.name in names]
        counted.append(df.groupBy(F.col("_file").alias("file")).agg(
            F.count_if(good).alias("rows"), sum((F.count_if(b) for b in bad), F.lit(0).cast("long")).alias("bad_fields"),
            F.count_if(~good).alias("bad_records")))
    return union_by_name(counted) if counted else spark.createDataFrame([], "file string, rows long, bad_fields long, bad_records long")


def read_reviews(spark: SparkSession, glob: str, tolerant: bool = False) -> DataFrame:
    """Every raw review file below a glob. No file at all is an error."""
    return read_csv(spark, glob, REVIEW_SCHEMA, tolerant)


def read_optional(spark: SparkSession, paths: Sequence[str], schema: T.StructType,
                  fmt: str = "csv") -> DataFrame:
    """Union of the inputs that exist; absent ones are skipped, none at all is an error."""
    found = []
    for path in paths:
        try:
            found.append(read_csv(spark, path, schema, True) if fmt == "csv"
                         else spark.read.schema(schema).format(fmt).load(path))
        except (AnalysisException, NoInputError) as error:
            if isinstance(error, AnalysisException) and error.getCondition() != "PATH_NOT_FOUND":
                raise
            print(f"skipping {path}: not found")
    if not found:
        raise NoInputError(f"none of {list(paths)} exists")
    return union_by_name(found)


def read_labelled(spark: SparkSession, path: str, fmt: str = "parquet",
                  label: str = "sentiment_label") -> DataFrame:
    """A labelled set with ``label_id``; rows with an unknown label are dropped."""
    df = (read_csv(spark, path, LABELLED_SCHEMA) if fmt == "csv"
          else spark.read.format(fmt).load(path))
    return valid_labels(require_columns(df, [label]), label)


def read_tiers(spark: SparkSession, tiers: dict[str, str], schema: T.StructType,
               fmt: str = "csv") -> DataFrame:
    """One frame for all tiers that exist, with ``tier`` and its position ``tier_ord``."""
    frames = []
    for ord_, (name, path) in enumerate(tiers.items()):
        try:
            frame = read_optional(spark, [path], schema, fmt)
        except NoInputError:
            continue
        frames.append(frame.withColumns({"tier": F.lit(name), "tier_ord": F.lit(ord_)}))
    if not frames:
        raise NoInputError("no evaluation tier exists")
    return union_by_name(frames)
