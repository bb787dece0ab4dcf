"""Market rows kept by month or day: written once a revision, read by the days and codes that are asked for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.market import CALENDAR
from .package import commit, current, version

#: Days that are handed to the scan of the store at most: a century. More are met by a join that reads all days.
MOST_DAYS = 36_600
#: Codes that are handed to the reader at most; more are met by a join.
MOST_CODES = 1000


def write_revision(rows: DataFrame, path: str, dataset: str, revision: str, span: str = "month", rows_per_file: int = 4_000_000) -> int:
    """Write rows(day, code, ...) as a revision of a data set and commit it as the current one; returns the number of rows.

    A partition is a month, or a day with span `day`, for data whose days fill files. Rows are dealt out by ranges of day and code, so a day that holds most of
    them is written by many tasks and a small partition gives one file, in which days and codes stand in order and can be skipped by their bounds. Rows without a day are kept apart and lie in no window. Nothing is overwritten: of two writers
    that began from the same revision the second fails, and a revision that exists already is refused. An empty table is a revision of no rows.
    """
    spark = rows.sparkSession
    own = f"{path}/{dataset}"
    base, told = version(spark, own), Observation(f"store-{uuid.uuid4().hex}")
    root = f"{own}/revision={revision}"
    kept = rows.withColumn("day", F.col("day").cast("date")).withColumn(part := f"{span}_start", F.trunc("day", span) if span == "month" else F.col("day").cast("date"))
    kept.limit(0).write.mode("errorifexists").parquet(f"{root}/_shape")
    dealt = kept.repartitionByRange("day", "code").sortWithinPartitions(part, "day", "code")
    counted = dealt.observe(told, F.count(F.lit(1)).alias("rows"))  # behind the exchange: its sampling reads the rows before it once more
    counted.write.mode("errorifexists").partitionBy(part).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(f"{root}/rows")
    commit(spark, own, revision, base)
    return told.get["rows"]


def read_days(spark: SparkSession, path: str, dataset: str, windows: DataFrame, codes: DataFrame | None = None, most_days: int = MOST_DAYS, most_codes: int = MOST_CODES) -> DataFrame:
    """The current revision's rows whose day lies in any of windows(first_day, last_day), and whose code is in codes(code) where it is given.

    Windows become days, which are counted first; up to `most_days` go to the scan, so only partitions of those days are opened. Up to `most_codes` codes go to
    the reader, which skips row groups without them. The calendar is read whole. Windows that are reversed or have no bound hold no day; windows that
    overlap give no row twice.
    """
    root = f"{path}/{dataset}/revision={current(spark, f'{path}/{dataset}')}"
    shape = spark.read.parquet(f"{root}/_shape").schema
    part, names = shape.names[-1], shape.names[:-1]
    rows = spark.read.schema(shape).parquet(f"{root}/rows")
    if codes is not None:
        few = [r["code"] for r in codes.where("code is not null").select("code").distinct().limit(most_codes + 1).collect()]  # most_codes + 1 rows at most
        rows = rows.where(F.col("code").isin(few)) if len(few) <= most_codes else rows.join(codes.select("code"), "code", "left_semi")
    if dataset == CALENDAR:
        return rows.select(*names)
    days = windows.where("first_day <= last_day").select(F.explode(F.sequence(F.col("first_day").cast("date"), F.col("last_day").cast("date"))).alias("day")).distinct()
    days = days.withColumn(part, F.trunc("day", "month") if part == "month_start" else F.col("day"))
    few = days.limit(most_days + 1).count() <= most_days
    return rows.join(F.broadcast(days) if few else days, [part, "day"], "left_semi").select(*names)
