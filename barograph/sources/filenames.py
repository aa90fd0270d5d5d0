"""File names to (year, month)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph import fixed


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def year_month_text(name: Column) -> Column:
    """The second `_`-separated part without the workbook suffix."""
    part = F.get(F.split(name, "_"), F.lit(1))
    return F.replace(part, F.lit(fixed.WORKBOOK_SUFFIX), F.lit(""))


def month_in_name(name: Column, strict: bool = False) -> tuple[Column, Column, Column]:
    """Year and month of a file name, both NULL where it has none, and what is wrong with it then.

    Four digits `YYMM` give year 2000 + YY and month MM. Month 00 is no month; months 13
    to 99 are taken as they are unless ``strict``.
    """
    text = year_month_text(name)
    last_month = 12 if strict else 99
    month = F.substring(text, 3, 2).try_cast("int")
    problem = (
        F.when(text.isNull() | (F.length(text) != 4), "no four-character month in the name")
        .when(~text.rlike("^[0-9]{4}$"), "month in the name is not a number")
        .when(~month.between(1, last_month), "no such month")
    )
    year = F.substring(text, 1, 2).try_cast("int") + fixed.CENTURY
    return F.when(problem.isNull(), year), F.when(problem.isNull(), month), problem


def file_year_month(files: DataFrame, strict: bool = False) -> DataFrame:
    """Add `year`, `month` and `name_problem` to a frame with a `file` column.

    A name that gives no month keeps NULLs and says why, so that one stray file cannot stop
    an import.
    """
    year, month, problem = month_in_name(base_name(F.col("file")), strict)
    return files.withColumn("name_problem", problem).withColumn("year", year).withColumn("month", month)
