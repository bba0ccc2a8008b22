"""Object-key manifests: listing filters, type buckets, image pairing, labels
(A8, A11, B12-B17, E9, G6, K2, K3).

All operators take a listing DataFrame (one row per object key) and return a
DataFrame; copying/moving objects is left to whoever executes the manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (basename, is_tci, label_from_path, label_index,
                              ship_type_from_key, tci_base_name)
from .archives import skip_existing


def training_listing(keys: DataFrame, key_col: str = "key") -> DataFrame:
    """A8 (training flavour): drop folder markers, hidden paths, notebook
    checkpoints, companion images (basename contains 'tci', any case) and
    anything that is not .tif/.tiff."""
    k = F.col(key_col)
    low = F.lower(k)
    return keys.where(~k.endswith("/") & ~k.contains("/.") & ~k.contains(".ipynb_checkpoints")
                      & ~F.lower(basename(k)).contains("tci")
                      & (low.endswith(".tif") | low.endswith(".tiff")))


def image_listing(keys: DataFrame, key_col: str = "key") -> DataFrame:
    """A8 (cleaning flavour): .tif/.tiff keys, case-insensitive."""
    low = F.lower(F.col(key_col))
    return keys.where(low.endswith(".tif") | low.endswith(".tiff"))


def rebucket(keys: DataFrame, src_prefix: str, dest_prefix: str, existing: DataFrame | None = None,
             key_col: str = "key") -> DataFrame:
    """K2 (B12, G6, A11): destination ``dest_prefix/type/basename`` per source
    key.  Buckets flatten scene folders, so equal basenames collide: the first
    source key in listing (lexicographic) order wins.  Destinations already
    present are skipped; sources are untouched."""
    dp = dest_prefix if dest_prefix.endswith("/") else dest_prefix + "/"
    k = F.col(key_col)
    plan = keys.where(~k.endswith("/")).select(
        k.alias("src_key"), ship_type_from_key(k, src_prefix).alias("ship_type"),
        F.concat(F.lit(dp), ship_type_from_key(k, src_prefix), F.lit("/"), basename(k)).alias("dest_key"))
    first = (plan.groupBy("dest_key")
             .agg(F.min_by(F.struct("src_key", "ship_type"), F.col("src_key")).alias("_w"))
             .select("dest_key", "_w.src_key", "_w.ship_type"))
    if existing is not None:
        first = skip_existing(first, existing, "dest_key")
    return first


def split_image_keys(keys: DataFrame, images_prefix: str, key_col: str = "key") -> DataFrame:
    """Class (first segment after the prefix), kind (TCI by basename,
    case-insensitive) and base key ``class/base name``; keys with fewer than two
    segments are dropped."""
    pre = images_prefix if images_prefix.endswith("/") else images_prefix + "/"
    k = F.col(key_col)
    rel = F.when(k.startswith(pre), k.substr(len(pre) + 1, 1 << 30)).otherwise(k)
    parts = F.split(rel, "/")
    cls = F.element_at(parts, 1)
    name = F.element_at(parts, -1)
    tci = is_tci(k)
    base = F.when(tci, tci_base_name(k)).otherwise(name)
    return (keys.where(F.size(parts) >= 2)
            .select(k.alias("key"), cls.alias("class"), F.when(tci, "TCI").otherwise("MERGED").alias("kind"),
                    F.concat(cls, F.lit("/"), base).alias("base_key")))


def pair_images(keys: DataFrame, images_prefix: str, key_col: str = "key") -> DataFrame:
    """Every merged image with its true-colour companion (left join on the
    base key; a companion without a merged image is ignored).  On duplicate
    base keys the last key in listing order wins, as in the reference."""
    s = split_image_keys(image_listing(keys, key_col), images_prefix, key_col)
    merged = (s.where(F.col("kind") == "MERGED").groupBy("base_key")
              .agg(F.max("key").alias("merged_key"), F.max("class").alias("class")))
    tci = s.where(F.col("kind") == "TCI").groupBy("base_key").agg(F.max("key").alias("tci_key"))
    return merged.join(tci, "base_key", "left").select("class", "base_key", "merged_key", "tci_key")


def training_manifest(keys: DataFrame, taxonomy: int | dict = 4, key_col: str = "key") -> DataFrame:
    """K3 (A8, B13): training images with their label and label index; labels
    outside the taxonomy are dropped."""
    t = training_listing(keys, key_col)
    lab = label_from_path(F.col(key_col), taxonomy)
    return (t.select(F.col(key_col).alias("key"), lab.alias("label"))
            .withColumn("label_idx", label_index(F.col("label"), taxonomy))
            .where(F.col("label_idx").isNotNull()))
