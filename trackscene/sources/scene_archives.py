"""Scene archives and object listings.

Listings read only file metadata (``binaryFile`` with the content column
pruned), so listing a bucket of large archives moves no archive bytes.
"""

from __future__ import annotations

import io
import os
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin_utc
from .archive_source import register

_INDEX_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("file_name", T.StringType()),
                              T.StructField("sensing_time_text", T.StringType())])


def _sensing_time(xml: str | None) -> str | None:
    """The SENSING_TIME text of tile metadata; broken XML, or XML without it, has none."""
    if xml is None:
        return None
    try:
        return next((e.text for _, e in ET.iterparse(io.BytesIO(xml.encode())) if e.tag == "SENSING_TIME"), None)
    except (ET.ParseError, ValueError):
        return None


def index_scene_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per scene archive: ``file_name`` = basename without
    ``.SAFE.zip``, ``sensing_time`` from the tile metadata (NULL when absent or
    malformed; the row is still emitted).  Only the central directory and the
    one metadata member of each archive are read, whatever the archive's size."""
    pin_utc(spark)
    register(spark)
    found = spark.read.format("zip_member_text").option("contains", "MTD_TL.xml").load(path)

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "path": pdf["path"],
                "file_name": [os.path.basename(p).removesuffix(".SAFE.zip") for p in pdf["path"]],
                "sensing_time_text": [_sensing_time(t) for t in pdf["text"]],
            })
    idx = found.mapInPandas(run, _INDEX_SCHEMA)
    return idx.select("path", "file_name",
                      F.coalesce(F.col("sensing_time_text").try_cast("timestamp"),
                                 F.try_to_timestamp(F.regexp_replace("sensing_time_text", "Z$", ""))
                                 ).alias("sensing_time"))


def list_objects(spark: SparkSession, root: str, suffixes: tuple[str, ...] | None = None,
                 exclude_dirs: bool = True) -> DataFrame:
    """Recursive listing (key relative to ``root``, length, modification
    time); optional case-insensitive suffix filter.  Spark's file index already
    leaves out hidden paths (``.x`` / ``_x``) and empty files; the training
    filter's ``/.`` rule (``manifests.training_listing``) still applies to
    listings that come from elsewhere."""
    base = root.rstrip("/")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
          .select("path", "length", "modificationTime"))
    plain = (base[len("file:"):] if base.startswith("file:") else base) + "/"
    pos = F.instr(F.col("path"), plain)
    key = F.when(pos > 0, F.col("path").substr(pos + F.lit(len(plain)), F.lit(1 << 30))).otherwise(F.col("path"))
    out = df.withColumn("key", key)
    if suffixes:
        low = F.lower(F.col("key"))
        cond = None
        for s in suffixes:
            c = low.endswith(s.lower())
            cond = c if cond is None else cond | c
        out = out.where(cond)
    if exclude_dirs:
        out = out.where(~F.col("key").endswith("/"))
    return out.select("key", "path", "length", "modificationTime")

