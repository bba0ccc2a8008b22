"""Position-report files: CSV, zipped CSV, tolerant folder loads.

Files are cut into records by ranges (``csv_records``), archives by member
(``archive_source``).  Parsing stays in Spark's CSV parser (``from_csv``) with
the database's COPY rules: header skipped, RFC quotes, unquoted empty = NULL,
quoted empty = '' , a bad value fails the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.prefix import with_row_id  # noqa: F401  (B7 belongs to loading: offered here too)
from ..operators.records import parse_multi_timestamp
from ..session import pin_utc, stash
from .archive_source import register
from .csv_records import RANGE_BYTES, csv_records, files

# fixed values: the 26 columns of a position report file, in file order, with their types
POSITION_COLUMNS = [
    ("# Timestamp", "timestamp"), ("Type of mobile", "string"), ("MMSI", "bigint"), ("Latitude", "double"),
    ("Longitude", "double"), ("Navigational status", "string"), ("ROT", "double"), ("SOG", "double"),
    ("COG", "double"), ("Heading", "double"), ("IMO", "string"), ("Callsign", "string"), ("Name", "string"),
    ("Ship type", "string"), ("Cargo type", "string"), ("Width", "double"), ("Length", "double"),
    ("Type of position fixing device", "string"), ("Draught", "double"), ("Destination", "string"),
    ("ETA", "string"), ("Data source type", "string"), ("A", "double"), ("B", "double"), ("C", "double"),
    ("D", "double"),
]
_SPARK_TYPE = {"timestamp": T.StringType(), "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType()}

# COPY ... CSV: unquoted empty -> NULL, quoted empty -> ''
COPY_CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "emptyValue": "",
                    "nullValue": "\\N", "multiLine": "true", "encoding": "UTF-8"}
_RECORD_OPTIONS = {k: v for k, v in COPY_CSV_OPTIONS.items() if k not in ("header", "multiLine", "encoding")}


def raw_schema() -> T.StructType:
    """File schema: the timestamp is read as text and parsed afterwards."""
    return T.StructType([T.StructField(n, _SPARK_TYPE[t]) for n, t in POSITION_COLUMNS])


def raw_ddl(extra: str = "") -> str:
    """DDL form of the file schema (quoted names: they contain spaces and '#')."""
    cols = [f"`{n}` {'string' if t == 'timestamp' else t}" for n, t in POSITION_COLUMNS]
    return ", ".join(cols + ([extra] if extra else []))


def _finish(df: DataFrame, strict: bool = True) -> DataFrame:
    """Timestamp text -> TIMESTAMP_NTZ (``dd/MM/yyyy HH:mm:ss`` or ISO, as the
    database's DMY date style accepts); unparsable non-empty text fails the load."""
    ts_txt = F.col("`# Timestamp`")
    parsed = parse_multi_timestamp(ts_txt)
    if strict:
        parsed = F.when(ts_txt.isNotNull() & (F.trim(ts_txt) != "") & parsed.isNull(),
                        F.raise_error(F.concat(F.lit("bad timestamp: "), ts_txt)).cast("timestamp_ntz")
                        ).otherwise(parsed)
    return df.withColumn("# Timestamp", parsed)


def read_positions_csv(spark: SparkSession, path: str, *, strict: bool = True, split: bool = True, keep_source: bool = False,
                       range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A1: position CSV files (a file, folder or glob), 26 fixed columns.

    A file is read in ranges of ``range_bytes`` by as many tasks, quoted
    newlines included (``csv_records``); ``keep_source`` adds path and
    record_no.  ``split=False`` leaves each file to one task of Spark's own
    multi-line reader, for storage that ``pyarrow.fs`` does not reach.
    """
    pin_utc(spark)
    if not split:
        mode = "FAILFAST" if strict else "PERMISSIVE"
        df = spark.read.schema(raw_schema()).options(**COPY_CSV_OPTIONS).option("mode", mode).csv(path)
        return _finish(df, strict)
    return parse_records(csv_records(files(spark, path), range_bytes), ["path", "record_no"] if keep_source else [], strict)


def parse_records(records: DataFrame, keep: list[str], strict: bool = True) -> DataFrame:
    """The columns of a position file from ``record``, by the COPY rules; a bad value fails the load when ``strict``."""
    opts = _RECORD_OPTIONS | {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    parsed = records.select(*keep, F.from_csv(F.col("record"), raw_ddl(), opts).alias("r"))
    return _finish(parsed.select(*keep, *[F.col("r").getField(n).alias(n) for n, _ in POSITION_COLUMNS]), strict)


def archive_records(spark: SparkSession, path: str, *, suffix: str = ".csv", case_insensitive: bool = True, tolerant: bool = False) -> DataFrame:
    """A2 raw: every record of every matching member of every ``*.zip`` under ``path``: (path, member, record_no, record).

    One partition per member, read by ranges (``ZipRecords``).  With
    ``tolerant`` a file that is no archive, or a member that breaks off, gives
    a row without a record number, whose record is the reason; otherwise it
    fails the job.
    """
    register(spark)
    return (spark.read.format("zip_records").option("suffix", suffix).option("ignoreCase", str(case_insensitive).lower())
            .option("tolerant", str(tolerant).lower()).load(path))


def read_archives(spark: SparkSession, path: str, *, suffix: str = ".csv", case_insensitive: bool = True,
                  strict: bool = True, keep_source: bool = True) -> DataFrame:
    """A2: position reports from zipped CSV members, parsed with the COPY rules."""
    pin_utc(spark)
    raw = archive_records(spark, path, suffix=suffix, case_insensitive=case_insensitive)
    return parse_records(raw, ["path", "member", "record_no"] if keep_source else [], strict)


def read_folder_tolerant(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A3: a folder with ``.csv`` and ``.zip`` files; a file (or a whole archive) with any bad record, or an archive that
    cannot be opened, is rejected and reported, the others load.

    Returns ``(rows, rejects)``; rejects = (source, reason).  Rows have
    ``_source``, ``member`` (null for plain files) and ``record_no``, so ids can
    be given with ``with_row_id``.  Every file is read and parsed once: the
    parsed records are written to the shared folder, and both results read them
    from there.
    """
    pin_utc(spark)
    plain = csv_records(files(spark, folder, "*.csv")).select(F.col("path").alias("_source"), F.lit(None).cast("string").alias("member"), "record_no", "record")
    zipped = archive_records(spark, folder, case_insensitive=False, tolerant=True).select(F.col("path").alias("_source"), "member", "record_no", "record")
    opts = _RECORD_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    r = F.from_csv(F.col("record"), raw_ddl("`_corrupt_record` string"), opts)
    cols = [F.col("r").getField(n).alias(n) for n, _ in POSITION_COLUMNS]
    both = plain.unionByName(zipped).select("_source", "member", "record_no", r.alias("r")).select(
        "_source", "member", "record_no", (F.col("record_no").isNull() | F.col("r._corrupt_record").isNotNull()).alias("_bad"), *cols)
    both = both.withColumn("_bad", F.col("_bad") | _bad_ts())
    # names of a position file hold spaces and signs that no file format takes: the columns travel as one struct by number
    names = [n for n, _ in POSITION_COLUMNS]
    flat = stash(both.select("_source", "member", "record_no", "_bad", *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]))
    rejects = flat.where("_bad").groupBy("_source").agg(F.count(F.lit(1)).alias("bad_records")).select(
        F.col("_source").alias("source"), F.concat(F.col("bad_records").cast("string"), F.lit(" bad record(s)")).alias("reason"))
    good = flat.join(rejects, flat["_source"] == rejects["source"], "left_anti")
    good = good.select("_source", "member", "record_no", *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    return _finish(good, strict=False), rejects


def _bad_ts():
    t = F.col("`# Timestamp`")
    return t.isNotNull() & (F.trim(t) != "") & parse_multi_timestamp(t).isNull()
