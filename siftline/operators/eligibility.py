"""Which rows of a company table still need work, and the counts of what became of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import values as V

INPUTS = ("siret", "company_name", "address", "postal_code", "city")


def last_useful_row(rows: DataFrame, inputs: tuple[str, ...] = INPUTS) -> DataFrame:
    """One row: the largest ``row_index`` from 2 with any input, else 1."""
    some = V.any_of(*[V.clean(F.col(c)).isNotNull() for c in inputs])
    return rows.filter((F.col("row_index") >= 2) & some).agg(F.coalesce(F.max("row_index"), F.lit(1)).cast("int").alias("last_useful_row"))


def row_range(rows: DataFrame, start_row: int = 2, max_rows: int | None = None, inputs: tuple[str, ...] = INPUTS) -> DataFrame:
    """The rows from ``start_row`` to the last useful one, at most ``max_rows`` of them (None or less than 1: all).

    Row numbers are contiguous, so the limit is a condition on them and needs neither a sort nor one partition.
    """
    kept = rows.filter(F.col("row_index") >= start_row)
    if max_rows is not None and max_rows > 0:
        kept = kept.filter(F.col("row_index") < start_row + max_rows)
    return kept.filter(F.col("row_index") <= last_useful_row(rows, inputs).scalar())


def read_status(status: Column) -> Column:
    """A known status, else null."""
    text = V.clean(status)
    return F.when(text.isin(*V.STATUSES), text)


def cells_filled(*cells: Column) -> Column:
    """Whether every cell holds something; the missing label counts."""
    filled = [V.clean(c).isNotNull() for c in cells]
    return filled[0] & filled[1] & filled[2]


def any_contact(*cells: Column) -> Column:
    """Whether a cell holds a contact; the missing label doesn't count."""
    return V.any_of(*[F.coalesce(V.clean(c), F.lit(V.MISSING)) != V.MISSING for c in cells])


def is_processable(row_siret: Column, company_name: Column) -> Column:
    return V.has_valid_siret(row_siret) & V.clean(company_name).isNotNull()


def skip(overwrite_existing: bool = False, skip_if_filled: bool = True) -> Column:
    """Whether a row is left alone: what is final stays, errors and repaired inputs are tried again."""
    if overwrite_existing or not skip_if_filled:
        return F.lit(False)
    status = read_status(F.col("status"))
    filled = cells_filled(F.col("email"), F.col("phone"), F.col("website"))
    invalid = ~is_processable(F.col("siret"), F.col("company_name"))
    return F.when(status == V.TECHNICAL_ERROR, False).when(status == V.INVALID_INPUT, invalid).when(status.isin(V.SUCCESS, V.NOT_FOUND), True).otherwise(filled)


def eligible(rows: DataFrame, overwrite_existing: bool = False, skip_if_filled: bool = True) -> DataFrame:
    return rows.filter(~skip(overwrite_existing, skip_if_filled))


def in_batches(rows: DataFrame, size: int, start_row: int = 2) -> DataFrame:
    """``batch_id``: which slice of ``size`` consecutive row numbers a row falls in."""
    if size <= 0:
        raise ValueError("a batch holds at least one row")
    return rows.withColumn("batch_id", F.floor((F.col("row_index") - F.lit(start_row)) / F.lit(size)).cast("long"))


def run_counters(rows: DataFrame, status: str = "status") -> DataFrame:
    """One row of counts by outcome; all but success are failures as well."""
    s = F.col(status)
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False))).cast("long")
    return rows.agg(
        F.count(F.lit(1)).cast("long").alias("processed_rows"), n(s == V.SUCCESS).alias("success_rows"), n(s == V.NOT_FOUND).alias("not_found_rows"),
        n(s == V.TECHNICAL_ERROR).alias("technical_error_rows"), n(s == V.INVALID_INPUT).alias("invalid_input_rows"),
        n(s.isin(V.NOT_FOUND, V.TECHNICAL_ERROR, V.INVALID_INPUT)).alias("failed_rows"),
    )
