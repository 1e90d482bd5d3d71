"""Reports written as one file, in order, by many tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.storage import materialise, new_folder


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def write_lines(lines: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write a relation of lines (place, line) to the file ``path``, by place.

    Tasks write ranges of places, sorted, to the shared folder; their files
    are then copied one behind the other, as streams, to a file beside
    ``path`` that is renamed when all is there. So ``path`` has the whole
    report or what it had before: a job that fails or breaks off leaves no
    part of it there. Null lines are empty. Without lines the file is empty.
    """
    spark = lines.sparkSession
    target, beside = _path(spark, path), _path(spark, f"{path}._{uuid.uuid4().hex}")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    fs = target.getFileSystem(conf)
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    parts = new_folder(spark, "report")
    text = lines.select("place", F.coalesce("line", F.lit("")).alias("line"))
    text.repartitionByRange("place").sortWithinPartitions("place").select("line").write.text(parts)
    folder = _path(spark, parts)
    source = folder.getFileSystem(conf)
    names = sorted(s.getPath().getName() for s in source.listStatus(folder) if s.getPath().getName().startswith("part-"))
    try:
        out = fs.create(beside)
        try:
            for name in names:
                stream = source.open(_path(spark, f"{parts}/{name}"))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
                finally:
                    stream.close()
        finally:
            out.close()
        if overwrite:
            fs.delete(target, False)
        if not fs.rename(beside, target):
            raise OSError(f"{path} can't be written")
    finally:
        fs.delete(beside, False)
        source.delete(folder, True)


def json_lines(rows: DataFrame, order: list[Column], head: dict[str, Column], field: str = "results") -> DataFrame:
    """Lines of a JSON object: the fields of ``head``, aggregates over ``rows``, then ``field`` with all rows, an object a line.

    Null fields of rows are written as null. Places are numbers of a sort by
    ``order``, given part by part, so rows needn't meet in one task. Numbered
    rows are written once: another sort may cut its parts elsewhere, and the
    last row be another.
    """
    sorted_rows = rows.orderBy(*order).select(F.monotonically_increasing_id().alias("place"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
    sorted_rows = materialise(sorted_rows, "report-rows")
    last = sorted_rows.agg(F.max("place").alias("_last"))
    body = sorted_rows.join(F.broadcast(last)).select((F.col("place") + 1).alias("place"), F.concat(F.lit("    "), "row", F.when(F.col("place") < F.col("_last"), ",").otherwise("")).alias("line"))
    fields = F.to_json(F.struct(*(c.alias(k) for k, c in head.items())), {"ignoreNullFields": "false"})
    one = rows.agg(fields.alias("head"))
    inner = F.when(F.length("head") > 2, F.concat(F.lit("  "), F.expr("substring(head, 2, length(head) - 2)"), F.lit(","))).otherwise("")
    at = lambda place, line: F.struct(F.lit(place).cast("long").alias("place"), line.alias("line"))
    start = one.select(F.explode(F.array(at(-2, F.lit("{")), at(-1, inner), at(0, F.lit(f'  "{field}": [')))).alias("x"))
    end = one.select(at((1 << 63) - 1, F.lit("  ]\n}")).alias("x"))
    return start.select("x.*").unionByName(body).unionByName(end.select("x.*"))


def read_json_lines(spark: SparkSession, path: str, head: str, row: str, field: str = "results") -> tuple[DataFrame, DataFrame]:
    """The head (one row) and the rows of a file of ``json_lines``, of schemas ``head`` and ``row``, read line by line by many tasks.

    Fails on lines that are no JSON, and unless all rows but one end in a comma.
    """
    lines = spark.read.text(path)
    strict = {"mode": "FAILFAST"}
    body = F.regexp_replace("value", ",$", "")
    tops = lines.filter(F.startswith("value", F.lit('  "')) & (F.col("value") != f'  "{field}": ['))
    told = tops.select(F.from_json(F.concat(F.lit("{"), body, F.lit("}")), head, strict).alias("x")).select("x.*")
    rows = lines.filter(F.startswith("value", F.lit("    ")))
    ends = rows.agg((F.count_if(~F.endswith("value", F.lit(","))) == F.least(F.count("*"), F.lit(1))).alias("_whole"))
    told = told.join(F.broadcast(ends)).filter(F.col("_whole") | F.raise_error(F.lit(f"{path} isn't JSON")).cast("boolean")).drop("_whole")
    return told, rows.select(F.from_json(body, row, strict).alias("x")).select("x.*")


def batch_json(results: DataFrame, timestamp: str, dry_run: bool = False) -> DataFrame:
    """Lines of a batch's JSON report: when, whether dry, counts, and the result (key, success, saved, error) of each parser."""
    return json_lines(
        results, [F.asc("key")],
        {
            "timestamp": F.lit(timestamp), "dry_run": F.lit(dry_run), "total_parsers": F.count("*"), "ok": F.count_if("success"),
            "failed": F.count_if(~F.col("success")), "exhibitions_saved": F.coalesce(F.sum("saved"), F.lit(0)),
        },
    )
