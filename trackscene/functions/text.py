"""String / key / name column functions.

All of them are built-in expressions (regexp, split, higher-order array
functions), so they run JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- B1
def drop_suffix(s, n: int) -> Column:
    """B1: PostgreSQL ``LEFT(s, LENGTH(s) - n)``.  A negative count in PG's
    LEFT drops that many characters from the end, so strings shorter than n
    keep ``2*len - n`` characters (never below 0)."""
    s = _c(s)
    ln = F.length(s)
    keep = F.greatest(F.lit(0), F.when(ln >= n, ln - n).otherwise(ln * 2 - n))
    return F.when(s.isNotNull(), s.substr(F.lit(1), keep))


# ---------------------------------------------------------------- B2
def product_id(c) -> Column:
    """The product a file name stands for: without a final ``.zip`` and then ``.SAFE``."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"\.zip$", ""), r"\.SAFE$", "")


def parse_bbox(text) -> dict[str, Column]:
    """B2: four doubles from the text "[minLon, minLat, maxLon, maxLat]"; a part that is
    missing or no number is NULL, and the last one needs the closing bracket."""
    t = _c(text)
    inner = F.substring_index(F.substring(t, F.instr(t, "[") + 1, F.length(t)), "]", 1)
    parts = F.when(t.contains("["), F.split(inner, ","))
    names = ("min_lon", "min_lat", "max_lon", "max_lat")
    ends = [F.size(parts) > i + 1 for i in range(3)] + [(F.size(parts) >= 4) & t.contains("]")]
    return {name: F.when(end, F.trim(F.get(parts, F.lit(i))).try_cast("double")) for i, (name, end) in enumerate(zip(names, ends))}


# ---------------------------------------------------------------- B8 / B14 / B16
def slug(c) -> Column:
    """NULL -> 'NA'; trim; whitespace runs -> '_'; drop [^A-Za-z0-9_-]; empty -> 'NA'."""
    s = _c(c).cast("string")
    t = F.regexp_replace(s, r"^\s+|\s+$", "")
    t = F.regexp_replace(t, r"\s+", "_")
    t = F.regexp_replace(t, r"[^A-Za-z0-9_\-]", "")
    return F.coalesce(F.nullif(t, F.lit("")), F.lit("NA"))


def strip_slashes(c) -> Column:
    return F.regexp_replace(_c(c), r"^/+|/+$", "")


def join_key(prefix, *parts) -> Column:
    """Prefix and parts stripped of '/' at both ends, empty parts skipped
    (tested before stripping, as the reference does), joined with '/'."""
    p = strip_slashes(F.coalesce(_c(prefix), F.lit("")))
    kept = [F.when(F.coalesce(_c(x), F.lit("")) != "", strip_slashes(_c(x))) for x in parts]
    suffix = F.concat_ws("/", *kept) if kept else F.lit("")
    return (F.when((p != "") & (suffix != ""), F.concat(p, F.lit("/"), suffix))
            .when(p != "", p).otherwise(suffix))


def patch_name(ship_type, mmsi, record_id, tci: bool = False) -> Column:
    """B16 basename: ``{slug(type)}_{slug(mmsi)}_{id}.tif`` (``_TCI.tif`` for the companion)."""
    return F.concat(slug(ship_type), F.lit("_"), slug(mmsi), F.lit("_"), _c(record_id).cast("string"),
                    F.lit("_TCI.tif" if tci else ".tif"))


def basename(c) -> Column:
    return F.element_at(F.split(_c(c), "/"), -1)


# ---------------------------------------------------------------- B9 / B10 / B11
DAILY_FROM = "2024-03-01"      # fixed value: first day of daily position archives
NO_FOLDER_FROM = "2025-01-01"  # fixed value: first day of archives without a year folder


def archive_name(d) -> Column:
    """Archive file name for a date (monthly before 2024-03-01, daily after)."""
    d = _c(d)
    return (F.when(d >= F.lit(DAILY_FROM).cast("date"),
                   F.concat(F.lit("aisdk-"), F.date_format(d, "yyyy-MM-dd"), F.lit(".zip")))
            .otherwise(F.concat(F.lit("aisdk-"), F.date_format(d, "yyyy-MM"), F.lit(".zip"))))


def archive_url(d, base) -> Column:
    """Download URL; daily archives of 2024 sit in a ``2024/`` folder,
    monthly ones in a ``YYYY/`` folder, 2025+ at the root."""
    d = _c(d)
    b = F.regexp_replace(_c(base), r"/+$", "")
    folder = (F.when(d >= F.lit(NO_FOLDER_FROM).cast("date"), F.lit(""))
              .when(d >= F.lit(DAILY_FROM).cast("date"), F.lit("2024/"))
              .otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("/"))))
    return F.concat(b, F.lit("/"), folder, archive_name(d))


_MONTHLY = r"^aisdk-(\d+)-(\d+)\.zip$"
_DAILY = r"^aisdk-(\d+)-(\d+)-(\d+)\.zip$"


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", y, m, d), "y-M-d")


def archive_date_range(key) -> dict[str, Column]:
    """``aisdk-YYYY-MM.zip`` -> [first of month, first of next month);
    ``aisdk-YYYY-MM-DD.zip`` -> [day, day+1); anything else -> NULLs."""
    base = basename(key)
    mon_start = _ymd(F.regexp_extract(base, _MONTHLY, 1), F.regexp_extract(base, _MONTHLY, 2), F.lit("1"))
    day_start = _ymd(F.regexp_extract(base, _DAILY, 1), F.regexp_extract(base, _DAILY, 2),
                     F.regexp_extract(base, _DAILY, 3))
    start = F.when(base.rlike(_MONTHLY), mon_start).when(base.rlike(_DAILY), day_start)
    end = (F.when(base.rlike(_MONTHLY), F.add_months(mon_start, 1))
           .when(base.rlike(_DAILY), F.date_add(day_start, 1)))
    return {"zip_start": start, "zip_end": end}


_MEMBER_DATE = r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9])$"


def member_date(name) -> Column:
    """Date of a daily member ``aisdk-YYYY-MM-DD.csv``; a monthly name
    (exactly two parts after the first '-') or anything unparsable -> NULL."""
    base = F.replace(basename(name), F.lit(".csv"), F.lit(""))
    parts = F.split(base, "-")
    rest = F.when(F.size(parts) > 1, F.slice(parts, 2, F.size(parts) - 1)).otherwise(F.array().cast("array<string>"))
    ds = F.array_join(rest, "-")
    parsed = F.when(ds.rlike(_MEMBER_DATE), F.try_to_date(ds, "yyyy-M-d"))
    return F.when(F.size(rest) != 2, parsed)


# ---------------------------------------------------------------- B12
_PLAUSIBLE_TYPE = r"^[A-Za-z][A-Za-z _-]*$"


def ship_type_from_key(key, prefix: str) -> Column:
    """Ship type of an object key: token before the first '_' of the
    basename when plausible, else the first plausible of the first two path
    segments after the prefix, else 'unclassified'."""
    k = _c(key)
    base = basename(k)
    first = F.substring_index(base, "_", 1)
    from_base = F.when(base.contains("_") & first.rlike(_PLAUSIBLE_TYPE), first)
    sp = prefix if prefix.endswith("/") else prefix + "/"
    tail = F.when(k.startswith(sp), k.substr(len(sp) + 1, 1 << 30)).otherwise(k)
    segs = F.slice(F.filter(F.split(tail, "/"), lambda s: s != ""), 1, 2)
    from_path = F.try_element_at(F.filter(segs, lambda s: s.rlike(_PLAUSIBLE_TYPE)), F.lit(1))
    return F.coalesce(from_base, from_path, F.lit("unclassified"))


# ---------------------------------------------------------------- B13
# fixed values: the three class taxonomies of the training scripts (class order,
# then alias groups in the order they are tested)
TAXONOMIES = {
    4: {"classes": ["CargoTanker", "Fishing", "Passenger", "Leisure"],
        "aliases": [("Leisure", ["Sailing", "Pleasure", "Leisure"]),
                    ("CargoTanker", ["Cargo", "Tanker", "CargoTanker"])]},
    5: {"classes": ["Cargo", "Tanker", "Fishing", "Passenger", "Leisure"],
        "aliases": [("Leisure", ["Sailing", "Pleasure", "Leisure"])]},
    6: {"classes": ["Cargo", "Tanker", "Fishing", "Passenger", "Sailing", "Pleasure"],
        "aliases": []},
}


def label_from_path(path, taxonomy: int | dict = 4) -> Column:
    """Class of a patch path: any path segment in an alias group wins (in
    group order), then any class name (class order), else the parent folder
    mapped through the alias groups.  '\\' counts as '/'."""
    tax = TAXONOMIES[taxonomy] if isinstance(taxonomy, int) else taxonomy
    parts = F.split(F.replace(_c(path), F.lit("\\"), F.lit("/")), "/")

    def has_any(names):
        return F.arrays_overlap(parts, F.array(*[F.lit(n) for n in names]))
    out = None
    for target, names in tax["aliases"]:
        out = (F.when(has_any(names), F.lit(target)) if out is None
               else out.when(has_any(names), F.lit(target)))
    for c in tax["classes"]:
        out = F.when(F.array_contains(parts, c), F.lit(c)) if out is None else out.when(
            F.array_contains(parts, c), F.lit(c))
    parent = F.when(F.size(parts) >= 2, F.element_at(parts, -2))
    fallback = parent
    alias_map = None
    for target, names in tax["aliases"]:
        cond = parent.isin(*names)
        alias_map = F.when(cond, F.lit(target)) if alias_map is None else alias_map.when(cond, F.lit(target))
    if alias_map is not None:
        fallback = alias_map.otherwise(parent)
    return out.otherwise(fallback)


def label_index(label, taxonomy: int | dict = 4) -> Column:
    """Index of a label in the class list; NULL for labels outside it."""
    tax = TAXONOMIES[taxonomy] if isinstance(taxonomy, int) else taxonomy
    arr = F.array(*[F.lit(c) for c in tax["classes"]])
    pos = F.array_position(arr, _c(label))
    return F.when(pos > 0, (pos - 1).cast("bigint"))


# ---------------------------------------------------------------- B17
_TCI = r"(?i)_TCI\.tiff?$"


def is_tci(key) -> Column:
    """Companion true-colour image by basename, case-insensitive."""
    return basename(key).rlike(_TCI)


def tci_base_name(key) -> Column:
    """Base name of a companion: only the exact ``_TCI.tif`` / ``_TCI.TIF``
    endings are replaced by ``.tif``; others keep their name."""
    b = basename(key)
    return (F.when(b.endswith("_TCI.tif") | b.endswith("_TCI.TIF"),
                   F.concat(b.substr(F.lit(1), F.length(b) - 8), F.lit(".tif"))).otherwise(b))
