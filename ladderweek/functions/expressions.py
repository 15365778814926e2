"""Column helpers shared by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """Division as double; zero divisors give NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def not_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def is_true(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def count_where(cond: Column, strict_null: bool = False) -> Column:
    """Number of rows that meet ``cond``; with ``strict_null`` one undecided row makes the count NULL."""
    n = F.count_if(cond)
    return F.when(F.count_if(cond.isNull()) == 0, n) if strict_null else n


def calendar_week(d: Column) -> Column:
    """Seven-day blocks counted from January 1st (not ISO weeks)."""
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")


def spawn_year(species: Column, year: Column, day: Column) -> Column:
    """Steelhead seen from July on spawn in the following year; other species in the same."""
    late = (species == "Steelhead") & (day >= F.make_date(year, F.lit(7), F.lit(1)))
    return F.when(late, year + 1).otherwise(year).cast("int")


def in_chinook_season(day: Column) -> Column:
    y = F.year(day)
    return day.between(F.make_date(y, F.lit(3), F.lit(1)), F.make_date(y, F.lit(8), F.lit(17)))


def snake(name: str) -> str:
    """``ClockDate`` -> ``clock_date``, ``#SbyC`` -> ``number_sby_c``, ``LGDNumPIT`` -> ``lgd_num_pit``."""
    text = name.strip().replace("#", "number_").replace("%", "percent_")
    text = re.sub(r"[^0-9A-Za-z]+", "_", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"([a-z])([A-Z])", r"\1_\2", text)
    return re.sub(r"_+", "_", text).strip("_").lower()


def clean_names(df: DataFrame) -> DataFrame:
    """snake_case every column; repeated names get a running suffix."""
    seen: dict[str, int] = {}
    names = []
    for column in df.columns:
        base = snake(column)
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})
