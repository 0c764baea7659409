"""Global sorts of one field, and the histogram and bucket forms of a sort.

A Spark sort is a range partitioning followed by a sort inside each range.
Equal values would share a range, so a tie-break column keeps ranges even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clean import strict_year
from .numbering import with_ref_id


def field_values(df: DataFrame, field: str, tie: str = "pos") -> DataFrame:
    """Non-empty values of a text field in lower case, with the tie-break column."""
    col = F.col(field)
    return df.filter(col.isNotNull() & (col != "")).select(F.lower(col).alias(field), F.col(tie).alias("_tie"))


def sorted_field(df: DataFrame, field: str, tie: str = "pos") -> DataFrame:
    """One text field in ascending code-point order, duplicates kept."""
    return field_values(df, field, tie).orderBy(field, "_tie").select(field)


def ranked_field(df: DataFrame, field: str, tie: str = "pos") -> DataFrame:
    """The sorted field with its 0-based place ``idx``."""
    return with_ref_id(field_values(df, field, tie), [field, "_tie"]).select("idx", field)


def years(df: DataFrame, field: str = "year", tie: str = "pos") -> DataFrame:
    """Strict years: exactly four digits once everything else is deleted."""
    return df.select(strict_year(F.col(field)).alias("year"), F.col(tie).alias("_tie")).filter("year is not null")


def ranked_years(df: DataFrame, field: str = "year", tie: str = "pos") -> DataFrame:
    return with_ref_id(years(df, field, tie), ["year", "_tie"]).select("idx", "year")


def year_histogram(df: DataFrame, field: str = "year", tie: str = "pos") -> DataFrame:
    """Counting sort: ``year, n`` in ascending order."""
    return years(df, field, tie).groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def expand_histogram(histogram: DataFrame, step: int = 1_000_000) -> DataFrame:
    """The histogram written out again as sorted values; long runs are cut into steps."""
    chunks = histogram.select("year", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(step))).alias("at"))
    spread = chunks.repartitionByRange("year", "at").sortWithinPartitions("year", "at")
    copies = F.explode(F.sequence(F.lit(1), F.least(F.lit(step), F.col("n") - F.col("at")).cast("int")))
    return spread.select("year", copies.alias("_c")).select("year")


def bucketed(values: DataFrame, column: str = "year", n: int | None = None) -> DataFrame:
    """Equal-width buckets from 0 to the maximum, the last one inclusive: ``column, bucket``.

    ``n`` defaults to the number of values. A maximum of 0 puts all in bucket 0.
    """
    x = F.col(column).cast("double")
    stats = values.agg(F.max(x).alias("_max"), F.count(x).alias("_n"))
    count = F.lit(n) if n is not None else F.col("_n")
    index = F.floor(x / (F.col("_max") / count))
    bucket = F.when(F.col("_max") == 0, 0).otherwise(F.least(index, count - 1)).cast("long")
    return values.join(F.broadcast(stats)).select(column, bucket.alias("bucket"))


def bucket_counts(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
