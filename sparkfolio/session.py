"""Session factory and table loader."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Tables that a data directory may hold, one parquet file or folder each.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def make_session(app: str = "sparkfolio", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join handling.

    The number of shuffle partitions is left to the cluster (AQE coalesces);
    pass ``spark.sql.shuffle.partitions`` to override it locally.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application, so that Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.writestr(str(source.relative_to(root.parent)), source.read_text(encoding="utf-8"))
    folder = Path(tempfile.mkdtemp(prefix="sparkfolio-src-"))
    (folder / "sparkfolio.zip").write_bytes(data.getvalue())
    context.addPyFile(str(folder / "sparkfolio.zip"))
    _shipped.add(context.applicationId)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
