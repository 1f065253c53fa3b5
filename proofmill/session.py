"""Session settings and the shared working folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on for right results or a sane physical plan.
# AQE covers skewed joins and partition counts; sizes stay the cluster's choice.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(
    cores: str = "8", shuffle_partitions: str = "8", app: str = "proofmill", settings: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
    )
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; Spark brings it to every executor.

    Workers need it for Arrow functions even where the package is only on the driver's path.
    """
    context, root = spark.sparkContext, Path(__file__).parent
    if getattr(context, "proofmill_shipped", False) or not root.is_dir():
        return
    sources = sorted(root.rglob("*.py"))
    mark = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:12]
    archive = Path(tempfile.mkdtemp(prefix="proofmill-code-")) / f"proofmill-{mark}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sources:
            out.write(p, p.relative_to(root.parent))
    context.addPyFile(str(archive))
    context.proofmill_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session, else
    the warehouse folder, which a cluster defines as shared storage as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/proofmill/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several branches need and read it back: it is worked out
    once, its lineage is cut, and losing executors costs nothing."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
