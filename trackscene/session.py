"""Session helpers: UTC pinning, checkpoint folder, lineage cuts.

Every operator in this package assumes the session time zone is UTC (calendar
parts of scene times are UTC days).  Nothing here creates a cluster; a caller
on a cluster passes its own session and its own ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "trackscene",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # array rows (image patches) are large: keep Arrow batches small
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Calendar semantics of the operators are UTC; pin it on the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def cap_arrow_batch(spark: SparkSession, rows: int = 256) -> None:
    """Array-heavy Python kernels (image patches of ~256 KB per row) need small
    Arrow batches; lower ``maxRecordsPerBatch`` to ``rows`` if it is larger
    (never raise it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        cur = int(spark.conf.get(key, "10000"))
    except ValueError:
        cur = 10000
    if cur <= 0 or cur > rows:
        spark.conf.set(key, str(rows))


def cap_arrow_bytes(spark: SparkSession, size: int = 1 << 20) -> None:
    """Rows cross to Python in batches of about ``size`` bytes, not of 10,000 rows whatever their length (never raised)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    m = re.fullmatch(r"(\d+)b?", spark.conf.get(key, None) or "")
    if m is None or int(m[1]) > size:
        spark.conf.set(key, str(size))


_SCRATCH_CKPT: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is given by the deployment and is read as is (it is
    a static setting, so it cannot be changed on a running session).  Only when
    it is unset on a local master (tests) a scratch folder is taken, once per
    context, and handed to ``SparkContext.setCheckpointDir``; on a cluster that
    would be each machine's own disk, so there it fails.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = id(sc._jsc)
    if key not in _SCRATCH_CKPT:
        _SCRATCH_CKPT[key] = tempfile.mkdtemp(prefix="trackscene-ckpt-")
        sc.setCheckpointDir(_SCRATCH_CKPT[key])
    return _SCRATCH_CKPT[key]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: what several plans read is made once,
    and lost executors cost a reread."""
    path = f"{checkpoint_dir(df.sparkSession)}/trackscene-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
