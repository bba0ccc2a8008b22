"""Table writes, load modes, reports, inferred CSV reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """CTAS-like write; ``errorifexists`` (the default) fails when present,
    ``overwrite`` replaces (the DROP TABLE IF EXISTS case)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """A10: ``append`` adds rows (reruns duplicate, as in the reference);
    ``replace`` rewrites exactly the partitions present in ``df`` (dynamic
    partition overwrite by e.g. ``api_id``), so a rerun of one scene replaces it."""
    if mode not in ("append", "replace"):
        raise ValueError("mode must be 'append' or 'replace'")
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode == "append":
        w.mode("append").parquet(path)
        return
    w.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partition_by else "static").parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Report rows as CSV with a header (or JSON lines), written in parallel."""
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode(mode).json(path)
    else:
        raise ValueError("fmt must be csv or json")


def read_csv_inferred(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8") -> DataFrame:
    """CSV with a header and inferred column types."""
    return (spark.read.option("header", True).option("inferSchema", True).option("sep", delimiter)
            .option("encoding", encoding).csv(path))
