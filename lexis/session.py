"""Session construction and the shared scratch folder.

On a cluster the session must name a shared folder in ``spark.checkpoint.dir``;
everything the library writes (checkpoints, sink round-trips, trial tables)
goes below it.  Only a *local* session without that setting (tests, the
single-node driver) gets a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "lexis",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per context, so
    that functions of its modules can be unpickled wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_lexis_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lexis-package-")) / "lexis.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._lexis_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only for local masters."""
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexis-ckpt-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lexis/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, codec: str = "snappy"):
    """Cut lineage by writing ``df`` once as a Parquet table in the shared
    folder and reading it back (one computation, unlike an eager checkpoint of
    an uncached DataFrame, and recoverable after executor loss)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)
