"""Late inputs to new revisions of the hours that they touch, batch by batch and once only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.scalar import HOUR, floor_to

#: Hours of a batch up to which they are broadcast to find their rows; beyond that the join shuffles.
MAX_BROADCAST_HOURS = 100_000
FIRST = 1


def publish_first(base: DataFrame, windows: Callable[[DataFrame], DataFrame], keys: list[str], root: str) -> None:
    """Revision 1: the windows of all rows that came in time, before any batch of late ones."""
    rows = windows(base).withColumn("rev", F.lit(FIRST))
    _commit(rows, keys, root, -1)


def _commit(rows: DataFrame, keys: list[str], root: str, batch: int) -> None:
    """Rows first, then what they are: rows without a commit are seen by nobody. A batch that is run again replaces its own."""
    rows.write.mode("overwrite").parquet(f"{root}/rows/batch={batch}")
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/rows/batch={batch}")
    commits = written.groupBy(*keys, "hour_ns", "rev").agg(F.count(F.lit(1)).alias("records"))
    commits.write.mode("overwrite").parquet(f"{root}/commits/batch={batch}")


def _read(spark: SparkSession, path: str, schema: StructType, up_to: int) -> DataFrame:
    """All batches' rows up to one; the folders of later ones, of a run that failed, do not count."""
    return spark.read.schema(StructType([*schema, StructField("batch", IntegerType())])).parquet(path).filter(F.col("batch") <= up_to)


def revising(base: DataFrame, windows: Callable[[DataFrame], DataFrame], keys: list[str], time: str, root: str, max_age_ns: int) -> Callable[[DataFrame, int], DataFrame]:
    """What a stream of late rows does with each batch (see results() and run_available()): the hours that the batch's rows fall
    into are worked out anew, from all rows that came in time and all late ones up to this batch, and become the hours' next
    revision. `windows` makes rows with the keys and hour_ns. Gives the batch's new revisions: keys, hour_ns, rev.

    Rows that come more than max_age_ns after their time go to <root>/too_late, for explicit reprocessing. Everything a batch
    writes lies under its number and depends only on batches before it, so that a batch that is run twice writes nothing new.
    Of the base table only the hours between the batch's first and last are read, and of these the ones that it touches.
    """

    def revise(batch: DataFrame, number: int) -> DataFrame:
        spark = batch.sparkSession
        late = F.col("received_at_ns") - F.col(time) > max_age_ns
        batch.write.mode("overwrite").parquet(f"{root}/incoming/batch={number}")
        incoming = _read(spark, f"{root}/incoming", batch.schema, number)
        mine = incoming.filter(F.col("batch") == number)
        mine.filter(late).drop("batch").write.mode("overwrite").parquet(f"{root}/too_late/batch={number}")
        in_hours = lambda rows: rows.withColumn("hour_ns", floor_to(time, HOUR))
        hours = in_hours(mine.filter(~late)).select(*keys, "hour_ns").distinct()
        span = hours.agg(F.min("hour_ns").alias("first"), F.max("hour_ns").alias("last"), F.count(F.lit(1)).alias("n")).first()
        first, last = (span["first"], span["last"]) if span["n"] else (0, -HOUR)
        between = F.col(time).between(first, last + HOUR - 1)
        touched = F.broadcast(hours) if span["n"] <= MAX_BROADCAST_HOURS else hours
        inputs = base.filter(between).unionByName(incoming.filter(between & ~late).select(base.columns))
        inputs = in_hours(inputs).join(touched, [*keys, "hour_ns"], "left_semi").drop("hour_ns")
        kinds = dict(hours.dtypes)
        schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "hour_ns long, rev int, records long"])
        commits = _read(spark, f"{root}/commits", spark.createDataFrame([], schema).schema, number - 1)
        before = commits.groupBy(*keys, "hour_ns").agg(F.max("rev").alias("_rev"))
        rows = windows(inputs).join(before, [*keys, "hour_ns"], "left")
        rows = rows.withColumn("rev", F.coalesce(F.col("_rev") + 1, F.lit(FIRST))).drop("_rev")
        _commit(rows, keys, root, number)
        return spark.read.parquet(f"{root}/commits/batch={number}")

    return revise


def revisions(spark: SparkSession, keys: list[str], root: str) -> DataFrame:
    """The rows of all committed revisions, with rev."""
    commits = spark.read.parquet(f"{root}/commits").select(*keys, "hour_ns", "rev", "batch")
    return spark.read.parquet(f"{root}/rows").join(commits, [*keys, "hour_ns", "rev", "batch"], "left_semi").drop("batch")
