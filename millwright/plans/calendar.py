"""Calendar dimension, bimesters and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions import clock, codes
from millwright.functions.clock import AsOf
from millwright.functions.values import label
from millwright.operators.shifts import day_spine

# Month abbreviations of the labels.
MONTH_LABEL = {
    1: "Jan", 2: "Fev", 3: "Mar", 4: "Abr", 5: "Mai", 6: "Jun",
    7: "Jul", 8: "Ago", 9: "Set", 10: "Out", 11: "Nov", 12: "Dez",
}
SPINE_START = "2020-01-01"


def bimester(date: Column) -> Column:
    """``jan-fev/2026``; NULL for a NULL date."""
    return F.concat(label(F.month(date), codes.BIMESTER), F.lit("/"), F.year(date).cast("string"))


def bimester_number(date: Column) -> Column:
    return F.floor((F.month(date) + 1) / 2).cast("int")


def calendar_spine(spark: SparkSession, as_of: AsOf, start: AsOf = SPINE_START) -> DataFrame:
    """Days from ``start`` to one year after the as-of date."""
    return day_spine(start, F.add_months(clock.day(as_of), 12), spark, "date_day")


def calendar_dimension(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return spine.select(
        d.alias("data"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.day(d).alias("dia"),
        bimester_number(d).alias("bimestre_num"),
        bimester(d).alias("bimestre"),
    )


def calendar_labels(days: DataFrame, date: str = "data") -> DataFrame:
    """Dashboard labels of each day: month/year, day/month and bimester."""
    d = F.col(date)
    month = label(F.month(d), MONTH_LABEL)
    return days.select(
        d.alias("data"),
        F.year(d).alias("ano"),
        F.lpad(F.month(d).cast("string"), 2, "0").alias("mes"),
        F.day(d).alias("dia"),
        F.concat_ws("/", month, F.year(d).cast("string")).alias("mes_ano"),
        F.concat_ws("/", F.lpad(F.day(d).cast("string"), 2, "0"), month).alias("dia_mes"),
        bimester(d).alias("bimestre"),
    )


def spanned_days(df: DataFrame, date: str, after: AsOf) -> DataFrame:
    """One row per day between the first and last date later than ``after``."""
    bounds = df.where(F.col(date) > clock.day(after)).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return bounds.where("lo IS NOT NULL").select(
        F.explode(F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"))).alias("data")
    )


def bimester_table(years: DataFrame, year: str = "ano") -> DataFrame:
    """Six bimesters per year with first and last day (the last one ends on 31 December)."""
    n = F.explode(F.sequence(F.lit(1), F.lit(6)))
    rows = years.select(F.col(year).cast("int").alias("ano"), n.alias("id_bimestre"))
    start = F.make_date("ano", F.col("id_bimestre") * 2 - 1, F.lit(1))
    return rows.select(
        "ano",
        "id_bimestre",
        F.format_string("%d_Bimestre_%d", "ano", "id_bimestre").alias("bimestre"),
        bimester(start).alias("range_bimestre"),
        start.alias("inicio_bimestre"),
        F.date_sub(F.add_months(start, 2), 1).alias("fim_bimestre"),
    )
