"""Tables written once to the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from sparkfolio.session import ship_package

_own: dict[str, str] = {}
#: Whether a query's shuffle files go with its end; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset (local tests), a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _own[app] = "file://" + tempfile.mkdtemp(prefix="sparkfolio-")
    return _own[app]


_made: set[str] = set()


def _own_folder(spark: SparkSession) -> str:
    """This application's folder under the shared one; it goes when the driver exits."""
    app = spark.sparkContext.applicationId
    folder = f"{shared_dir(spark)}/sparkfolio/{app}"
    if app not in _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _made.add(app)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own under this application's folder."""
    ship_package(spark)
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths of the tables that ``materialise`` wrote, in order.
written: list[str] = []


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def drop_but_last(spark: SparkSession, since: int) -> None:
    """Delete the tables written after the first ``since``, but for the last one, which nothing else may depend on."""
    for name in written[since:-1]:
        _delete(spark, name)
    del written[since:-1]


def drop(spark: SparkSession, name: str) -> None:
    """Delete one of the ``written`` tables, which nothing reads any more."""
    _delete(spark, name)
    written.remove(name)


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and return the written table.

    Cuts lineage durably: a lost executor rereads the files instead of
    recomputing, and later plans know the table's size. What was shuffled for
    it goes when it is written, as nothing reads it again.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    written.append(path)
    return spark.read.schema(df.schema).parquet(path)
