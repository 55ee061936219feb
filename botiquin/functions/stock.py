"""Stock, coverage and level expressions of the board."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def stock_on_hand(unexpired: Column, available: Column, actual: Column | None = None) -> Column:
    """Unexpired stock unless it is zero or unknown, then available, then actual, then 0. (FN-14)"""
    options = [F.nullif(unexpired, F.lit(0)), available]
    if actual is not None:
        options.append(actual)
    return F.coalesce(*options, F.lit(0))


def coverage_months(total: Column, dmp: Column) -> Column:
    """Months the total lasts at the monthly demand, one decimal, null without demand. (FN-16)

    On decimal input the rounding is exact, half away from zero.
    """
    return F.when(dmp > 0, F.round(F.try_divide(total, dmp), 1).cast("decimal(20,1)"))


def coverage_exact(total: Column, dmp: Column) -> Column:
    """Unrounded coverage as a double, null when demand is not positive. (FN-16b)"""
    return F.when(dmp > 0, F.try_divide(total.cast("double"), dmp.cast("double")))


def coverage_grid(stock: Column, requested: Column, dmp: Column) -> Column:
    """Coverage as the edit grid recomputes it, null when demand is zero or unknown. (FN-16c)"""
    total = (or_zero(stock) + or_zero(requested)).cast("double")
    return F.when(dmp != 0, F.try_divide(total, dmp.cast("double")))


def stock_level(stock: Column, dmp: Column, coverage: Column) -> Column:
    """Sin DMP, Sin Stock, Crítico, Atención or Óptimo from the coverage. (FN-17)"""
    return (
        F.when(or_zero(dmp) == 0, "Sin DMP")
        .when(stock == 0, "Sin Stock")
        .when(coverage < 1, "Crítico")
        .when(coverage.between(1, 3), "Atención")
        .otherwise("Óptimo")
    )


def stock_level_legacy(stock: Column, dmp: Column) -> Column:
    """The same levels from the share of one month's demand on hand. (FN-17b)"""
    return (
        F.when(or_zero(dmp) == 0, "Sin DMP")
        .when(stock == 0, "Sin Stock")
        .when(stock < dmp * F.lit("0.3").cast("decimal(2,1)"), "Crítico")
        .when(stock < dmp * F.lit("0.7").cast("decimal(2,1)"), "Atención")
        .otherwise("Óptimo")
    )


def traffic_light(c: Column, extended: bool = True) -> Column:
    """rojo, verde or amarillo from words in a status text, null for none. (FN-20)

    ``extended`` adds the words for stock levels to those for depot states.
    """
    red, green, yellow = ["Requiere", "Crítico"], ["Adecuado", "Normal"], ["Precaución", "Atención"]
    if extended:
        red, green, yellow = red + ["Sin Stock"], green + ["Óptimo"], yellow + ["Sin DMP"]
    return (
        F.when(c.rlike("|".join(red)), "rojo")
        .when(c.rlike("|".join(green)), "verde")
        .when(c.rlike("|".join(yellow)), "amarillo")
    )
