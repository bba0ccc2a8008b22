"""Scene catalog operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import envelope
from ..functions.text import parse_bbox
from ..functions.timefn import utc_ntz
from ..session import pin_utc


def scene_boxes(catalog: DataFrame, bbox: str = "bbox") -> DataFrame:
    """B2 + D2 + C2: footprint box from the bbox text; rows with NULL/empty
    bbox keep NULL boxes (the reference leaves their geometry unset)."""
    p = parse_bbox(F.col(bbox))
    ok = F.col(bbox).isNotNull() & (F.col(bbox) != "")
    env = envelope(p["min_lon"], p["min_lat"], p["max_lon"], p["max_lat"])
    out = catalog
    for name, c in env.items():
        out = out.withColumn(name, F.when(ok, c))
    return out


def clear_scenes(scenes: DataFrame, max_cloud: float = 5.0, cloud: str = "cloud_cover") -> DataFrame:
    """The cloud half of C1, for use before water is measured; NULLs drop out."""
    return scenes.where(F.col(cloud) < F.lit(float(max_cloud)))


def select_scenes(scenes: DataFrame, max_cloud: float = 5.0, min_water: float = 1e7,
                  cloud: str = "cloud_cover", water: str = "water_area") -> DataFrame:
    """Strict ``cloud < max_cloud AND water > min_water``; NULLs drop out."""
    return clear_scenes(scenes, max_cloud, cloud).where(F.col(water) > F.lit(float(min_water)))


def images_per_day(scenes: DataFrame, time_col: str = "sensing_time", min_images: int = 1,
                   out: str = "image_count") -> DataFrame:
    """G2 + C5: number of scenes on the same UTC calendar day (window count
    over the whole day partition), then keep days with >= ``min_images``.

    The window shuffles by day only; one day holds at most the scenes of that
    day, which is bounded by the satellite revisit, not by the data volume.
    """
    pin_utc(scenes.sparkSession)
    t = F.col(time_col)
    w = Window.partitionBy(F.year(t), F.month(t), F.dayofmonth(t))
    return scenes.withColumn(out, F.count(F.lit(1)).over(w).cast("bigint")).where(F.col(out) >= min_images)


def scenes_per_day(scenes: DataFrame, time_col: str = "sensing_time") -> DataFrame:
    """F1 + B4 + H1: scene count per UTC date, NULL times dropped, date order."""
    pin_utc(scenes.sparkSession)
    return (scenes.where(F.col(time_col).isNotNull())
            .groupBy(F.to_date(F.col(time_col)).alias("date"))
            .agg(F.count(F.lit(1)).alias("count_per_day"))
            .orderBy("date"))


def with_utc_wall_clock(df: DataFrame, col: str = "sensing_time",
                        out: str = "sensing_time_without_tz") -> DataFrame:
    """Zoned sensing time -> UTC wall clock without a zone."""
    pin_utc(df.sparkSession)
    return df.withColumn(out, utc_ntz(col))
