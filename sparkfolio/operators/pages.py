"""Pages of an ordered table without sorting it: a directory of sorted parts with their row counts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class PageDirectory:
    """A table stored in sorted parts, and how many rows stand before each part.

    Parts are ranges of the order, so the page at any offset lies in one part
    or a few neighbours, which alone are read; the total comes from the
    directory. With a ``group`` column (such as the source) the directory
    counts by group too, and pages of one group are found the same way. The
    directory has a row per part and group.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        about = json.loads(spark.read.text(f"{self.path}/order").first()[0])
        self.order: list[tuple[str, bool]] = [(c, down) for c, down in about["order"]]
        self.group: str | None = about["group"]
        self.schema = StructType.fromJson(about["schema"])

    @staticmethod
    def _by(order: list[tuple[str, bool]]) -> list[Column]:
        return [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in order]

    @classmethod
    def build(cls, spark: SparkSession, path: str, df: DataFrame, order: list[tuple[str, bool]], group: str | None = None, part_rows: int = 100_000) -> PageDirectory:
        """Sort ``df`` by ``order`` (columns and whether they go down; nulls last), ending in a unique one, into parts of some ``part_rows`` rows."""
        path = path.rstrip("/")
        schema = StructType([*df.schema.fields]).add("_part", "integer")
        about = json.dumps({"order": order, "group": group, "schema": schema.jsonValue()})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/order")
        by = cls._by(order)
        n = max(1, -(-df.count() // part_rows))
        parts = df.repartitionByRange(n, *by).withColumn("_part", F.spark_partition_id())
        # Sorted by part as well, which the writer would otherwise sort by again.
        parts.sortWithinPartitions("_part", *by).write.partitionBy("_part").parquet(f"{path}/rows")
        pages = cls(spark, path)
        counts = pages._rows().groupBy("_part", *([group] if group else [])).agg(F.count("*").alias("n"))
        counts.coalesce(1).write.parquet(f"{path}/directory")
        return pages

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def _counts(self, value: str | None) -> DataFrame:
        """(part, n, ahead) over all rows, or over those of a group."""
        df = self.spark.read.parquet(f"{self.path}/directory")
        if value is not None:
            if not self.group:
                raise ValueError("the directory has no groups")
            df = df.filter(F.col(self.group) == value)
        df = df.groupBy("_part").agg(F.sum("n").alias("n"))
        along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
        return df.withColumn("ahead", F.coalesce(F.sum("n").over(along), F.lit(0)))

    def total(self, value: str | None = None) -> DataFrame:
        """One row: the number of rows, of a group if one is named."""
        return self._counts(value).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))

    def parts_of(self, limit: int, offset: int, value: str | None = None) -> tuple[list[int], int]:
        """(parts that hold a page, rows of the first one to skip)."""
        touched = self._counts(value).filter((F.col("ahead") < offset + limit) & (F.col("ahead") + F.col("n") > offset) & (F.col("n") > 0))
        rows = touched.orderBy("_part").collect()  # parts that the page touches
        return [r["_part"] for r in rows], offset - rows[0]["ahead"] if rows else 0

    def page(self, limit: int, offset: int = 0, value: str | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset`` + ``limit`` of the order, of a group if one is named; none beyond the end."""
        parts, skip = self.parts_of(limit, offset, value)
        rows = self._rows().filter(F.col("_part").isin(parts))
        if value is not None:
            rows = rows.filter(F.col(self.group) == value)
        return rows.drop("_part").orderBy(*self._by(self.order)).offset(skip).limit(limit)
