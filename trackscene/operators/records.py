"""Record cleaning, nested JSON flattening, key uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """A4: a string that is empty or only whitespace becomes NULL."""
    c = _c(c)
    return F.when(F.regexp_replace(c, r"^\s+|\s+$", "") != "", c)


def parse_multi_timestamp(c) -> Column:
    """A4: the position-report timestamp rules, in order:
    contains '/' -> ``dd/MM/yyyy HH:mm:ss``; else 'T' -> ' ' and 'Z' dropped ->
    ``yyyy-MM-dd HH:mm:ss``; else ISO; else NULL.  Result is TIMESTAMP_NTZ."""
    s = F.regexp_replace(_c(c), r"^\s+|\s+$", "")
    dmy = F.when(s.contains("/"), F.try_to_timestamp(s, F.lit("d/M/yyyy H:m:s")))
    s2 = F.replace(F.replace(s, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    ymd = F.try_to_timestamp(s2, F.lit("yyyy-MM-dd HH:mm:ss"))
    iso = F.replace(s, F.lit("Z"), F.lit("")).try_cast("timestamp_ntz")
    out = F.coalesce(dmy.cast("timestamp_ntz"), ymd.cast("timestamp_ntz"), iso)
    return F.when(s != "", out)


def clean_records(df: DataFrame, time_cols: Sequence[str] = ("# Timestamp", "ETA")) -> DataFrame:
    """A4: blanks -> NULL in every string column; time columns parsed with the
    multi-format rule (session time zone must be UTC; ``pin_utc`` does it)."""
    from ..session import pin_utc
    pin_utc(df.sparkSession)
    cols = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if f.name in time_cols:
            cols.append(parse_multi_timestamp(F.col(name)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(blank_to_null(F.col(name)).alias(f.name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


# fixed values: the scene-catalog fields kept from a STAC feature, in output order
STAC_FIELDS = (
    ("api_id", "id"),
    ("datetime", "properties.datetime"),
    ("cloud_cover", "properties.`eo:cloud_cover`"),
    ("platform", "properties.platform"),
    ("constellation", "properties.constellation"),
    ("proj_epsg", "properties.`proj:epsg`"),
)

STAC_FEATURE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("datetime", T.StringType()),
        T.StructField("eo:cloud_cover", T.DoubleType()),
        T.StructField("platform", T.StringType()),
        T.StructField("constellation", T.StringType()),
        T.StructField("proj:epsg", T.IntegerType()),
    ])),
    T.StructField("geometry", T.StringType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())),
])
STAC_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(STAC_FEATURE))])


def flatten_stac(pages: DataFrame, json_col: str = "json") -> DataFrame:
    """A5 + C7: one row per feature of each search-result page, the stable
    fields projected (a missing path is NULL), geometry kept as JSON text, bbox
    as its text form, rows without ``api_id`` or ``datetime`` dropped."""
    parsed = pages.select(F.from_json(F.col(json_col), STAC_COLLECTION).alias("_doc"))
    feats = parsed.select(F.explode("_doc.features").alias("f"))
    cols = [F.col(f"f.{path}").alias(name) for name, path in STAC_FIELDS]
    out = feats.select(*cols, F.col("f.geometry").alias("geom_geojson"),
                       F.when(F.col("f.bbox").isNotNull(),
                              F.concat(F.lit("["), F.array_join(F.col("f.bbox").cast("array<string>"), ", "),
                                       F.lit("]"))).alias("bbox"))
    return out.dropna(subset=["api_id", "datetime"])


def read_stac(pages: DataFrame, page: str = "page", json_col: str = "json") -> tuple[DataFrame, DataFrame]:
    """A5 + C7 with a report: ``(features, rejects)`` of search-result pages.

    Pages are parsed as VARIANT, so one odd value costs its own field and not
    the page.  ``features`` has the columns of ``flatten_stac`` with
    ``datetime`` as a timestamp; rows without ``api_id`` or ``datetime`` are
    dropped, as in the reference.  ``rejects`` has (page, feature, reason): a
    page that is no JSON, a page without a list of features, a feature whose
    datetime cannot be read (``feature`` is its position, null for whole pages).
    A null page is no JSON.
    """
    d = pages.select(F.col(page).alias("_page"), F.try_parse_json(json_col).alias("_doc"))
    d = d.withColumn("_features", F.try_variant_get("_doc", "$.features", "array<variant>"))
    bad = d.where(F.col("_features").isNull()).select(
        F.col("_page").alias("page"), F.lit(None).cast("int").alias("feature"),
        F.when(F.col("_doc").isNull(), "no JSON").otherwise("no features").alias("reason"))
    f = d.select("_page", F.posexplode("_features").alias("_at", "_f"))
    text = F.try_variant_get("_f", "$.properties.datetime", "string")
    get = {"string": lambda path: F.try_variant_get("_f", path, "string"), "double": lambda path: F.try_variant_get("_f", path, "double"),
           "int": lambda path: F.try_variant_get("_f", path, "int")}
    f = f.select("_page", "_at", get["string"]("$.id").alias("api_id"), text.alias("_text"), F.try_to_timestamp(text).alias("datetime"),
                 get["double"]('$.properties["eo:cloud_cover"]').alias("cloud_cover"), get["string"]("$.properties.platform").alias("platform"),
                 get["string"]("$.properties.constellation").alias("constellation"), get["int"]('$.properties["proj:epsg"]').alias("proj_epsg"),
                 F.to_json(F.try_variant_get("_f", "$.geometry", "variant")).alias("geom_geojson"),
                 F.try_variant_get("_f", "$.bbox", "array<double>").alias("_bbox"))
    bbox = F.concat(F.lit("["), F.array_join(F.col("_bbox").cast("array<string>"), ", "), F.lit("]"))
    late = f.where(F.col("_text").isNotNull() & F.col("datetime").isNull()).select(
        F.col("_page").alias("page"), F.col("_at").alias("feature"), F.lit("bad datetime").alias("reason"))
    out = f.withColumn("bbox", bbox).drop("_page", "_at", "_text", "_bbox").dropna(subset=["api_id", "datetime"])
    return out, bad.unionByName(late)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once (partial aggregation, one shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The primary-key rule of the reference: any duplicate fails the load."""
    dups = duplicate_keys(df, keys).limit(1).collect()
    if dups:
        raise ValueError(f"duplicate key {dict(zip(keys, dups[0][:len(keys)]))} in {list(keys)}")
    return df


def dedupe_on_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A6 lenient variant: one row per key."""
    return df.dropDuplicates(list(keys))
