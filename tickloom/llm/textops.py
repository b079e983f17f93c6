"""Column helpers that the text operators share. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_dir  # noqa: F401  (where operators keep tables between stages)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of bytes below 0x80 that are neither digits nor a-z part words (after lower-casing A-Z).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_of(column: Column | str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-cases A-Z and nothing else.

    Spark's lower() does just that on pure ASCII text, and much faster than translate().
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words_of(column: Column | str) -> Column:
    """Array of the lower-cased words of a whole text; empty for null or wordless texts."""
    return F.array_remove(F.split(lower_az(text_of(column)), SEPARATORS), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, id_col: str, *columns: str) -> DataFrame:
    """The columns an operator needs and nothing else, so that no other column's name can clash.

    `_row` tells apart rows that repeat an identifier.
    """
    return docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_{c}") for c in columns],
    )


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame with its lineage cut by a reliable checkpoint."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(frame.sparkSession))
    return frame.checkpoint()
