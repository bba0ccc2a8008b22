"""Position-archive planning.

Everything works on *listings* (key names, dates), so partition pruning by
file name happens before any archive content is read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import archive_date_range, archive_name, archive_url, basename, member_date


def archive_plan(dates: DataFrame, base_url: str, date_col: str = "date") -> DataFrame:
    """Distinct archives (url, zipname) for a set of dates; a monthly
    archive is emitted once however many of its days are asked for."""
    d = F.col(date_col)
    return (dates.where(d.isNotNull())
            .select(archive_name(d).alias("zipname"), archive_url(d, F.lit(base_url)).alias("url"))
            .dropDuplicates(["zipname"]))


def with_archive_range(keys: DataFrame, key_col: str = "key") -> DataFrame:
    """[zip_start, zip_end) of every archive key (NULLs for other names)."""
    r = archive_date_range(F.col(key_col))
    return keys.withColumn("zip_start", r["zip_start"]).withColumn("zip_end", r["zip_end"])


def _as_date(v):
    if v is None or isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v))


def filter_archives(keys: DataFrame, start=None, end=None, key_contains: str | None = None,
                    key_col: str = "key") -> DataFrame:
    """C4 then C3: keep keys whose basename contains ``key_contains`` and whose
    date range overlaps [start, end) (half-open).  With no bound every key
    passes; with any bound names that are not archive names are dropped."""
    out = keys
    if key_contains:
        out = out.where(basename(F.col(key_col)).contains(key_contains))
    start, end = _as_date(start), _as_date(end)
    if start is None and end is None:
        return out
    r = archive_date_range(F.col(key_col))
    cond = r["zip_start"].isNotNull()
    if start is not None:
        cond = cond & (r["zip_end"] > F.lit(start))
    if end is not None:
        cond = cond & (r["zip_start"] < F.lit(end))
    return out.where(cond)


def needed_members(members: DataFrame, wanted_dates: DataFrame, name_col: str = "member",
                   date_col: str = "date") -> DataFrame:
    """B11 + C8: archive members whose daily date is in the wanted set
    (a semi join on the date; monthly or unparsable names never match)."""
    m = members.withColumn("member_date", member_date(F.col(name_col)))
    w = wanted_dates.select(F.col(date_col).alias("_wd")).distinct()
    return m.join(w, m["member_date"] == w["_wd"], "left_semi")


def skip_existing(candidates: DataFrame, existing: DataFrame, key: str, existing_key: str | None = None) -> DataFrame:
    """Candidates whose target key is not present yet (anti join)."""
    ek = existing_key or key
    e = existing.select(F.col(ek).alias("_ek")).distinct()
    return candidates.join(e, candidates[key] == e["_ek"], "left_anti")


def skip_existing_all(candidates: DataFrame, existing: DataFrame, base: str, target: str,
                      required: int) -> DataFrame:
    """A11 patch variant: a candidate is done only when *all* ``required``
    outputs of its base exist (count per base first, then anti join)."""
    done = (existing.groupBy(F.col(base).alias("_b")).agg(F.countDistinct(target).alias("_n"))
            .where(F.col("_n") >= required).select("_b"))
    return candidates.join(done, candidates[base] == done["_b"], "left_anti")


def download_plan(dates: DataFrame, existing_zipnames: DataFrame, base_url: str,
                  date_col: str = "date", existing_col: str = "zipname") -> DataFrame:
    """K4: distinct dates -> distinct archives not already stored (fetching is not built)."""
    plan = archive_plan(dates.select(date_col).distinct(), base_url, date_col)
    return skip_existing(plan, existing_zipnames, "zipname", existing_col)
