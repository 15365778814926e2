"""Daily to weekly rollup, renumbering, conservation check and small frame utilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderweek.functions.expressions import is_true

KEYS = ("run_id", "week_num_org", "date")


def weekly_rollup(daily: DataFrame, open_rule: str = "any_day") -> DataFrame:
    """First date, sum of every number and any() of every flag per ``run_id, week_num_org``.

    NULLs do not count; an all-NULL week sums to 0. ``open_rule="positive"`` calls the window open in weeks with a
    positive count, whatever the daily flags say.
    """
    numbers = [f.name for f in daily.schema if isinstance(f.dataType, T.NumericType) and f.name not in KEYS]
    flags = [f.name for f in daily.schema if isinstance(f.dataType, T.BooleanType)]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers]
    anys = [is_true(F.bool_or(c)).alias(c) for c in flags]
    weekly = daily.groupBy("run_id", "week_num_org").agg(F.min("date").alias("start_date"), *sums, *anys)
    if open_rule == "positive":
        weekly = weekly.withColumn("window_open", F.col("win_cnt") > 0)
    return weekly


def renumber_weeks(weekly: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """``week_num`` counts from 1 at the first stratum with data; at most a season's strata per window."""
    first = F.min("week_num_org").over(Window.partitionBy(*keys))
    return weekly.withColumn("week_num", (F.col("week_num_org") - first + 1).cast("int"))


def number_rows(weekly: DataFrame, keys: tuple[str, ...] = ("run_id",), order: str = "start_date") -> DataFrame:
    """Position of each week within its run."""
    return weekly.withColumn("week", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def conservation(
    daily: DataFrame, weekly: DataFrame, keys: tuple[str, ...], columns: tuple[str, ...]
) -> DataFrame:
    """Daily and weekly totals of every group side by side, and whether they agree."""
    total = lambda df: df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    d, w = total(daily).alias("d"), total(weekly).alias("w")
    on = [F.col(f"d.{k}") == F.col(f"w.{k}") for k in keys]
    agree = F.lit(True)
    for c in columns:
        agree = agree & F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}"))
    return d.join(w, on, "full").select(
        *[F.coalesce(f"d.{k}", f"w.{k}").alias(k) for k in keys],
        *[F.col(f"d.{c}").alias(f"daily_{c}") for c in columns],
        *[F.col(f"w.{c}").alias(f"weekly_{c}") for c in columns],
        agree.alias("conserved"),
    )


def check_conservation(daily: DataFrame, weekly: DataFrame, keys: tuple[str, ...], columns: tuple[str, ...]) -> None:
    """Raises if any group's totals differ: a fish was lost or counted twice."""
    broken = conservation(daily, weekly, keys, columns).filter(~F.col("conserved")).limit(5).collect()
    if broken:
        raise ValueError(f"daily and weekly totals differ, for example {broken}")


class Audit:
    """Totals of days and of weeks, taken while the compile computes both: no job or scan of their own.

    Hand it to the compile, run one action on the weekly table, then ask for ``totals`` or ``check``.
    """

    def __init__(self, columns: tuple[str, ...] = ("win_cnt", "trap_fish")):
        self.columns = columns
        self.seen = {"days": Observation(), "weeks": Observation()}

    def watch(self, of: str, df: DataFrame, counted: Column | None = None) -> DataFrame:
        """``df`` itself; its totals, of the rows with ``counted``, are noted under ``of`` (days or weeks) as it runs."""
        kept = F.lit(True) if counted is None else counted
        sums = [F.sum(F.when(kept, F.col(c)).cast("double")).alias(c) for c in self.columns]
        return df.observe(self.seen[of], *sums)

    def totals(self) -> dict[str, dict[str, float]]:
        """What the last action saw; waits for one."""
        return {of: {c: seen.get[c] or 0.0 for c in self.columns} for of, seen in self.seen.items()}

    def check(self) -> None:
        """Raises if a fish was lost or counted twice between days and weeks."""
        found = self.totals()
        broken = [c for c in self.columns if abs(found["days"][c] - found["weeks"][c]) > 1e-9 * max(1.0, abs(found["days"][c]))]
        if broken:
            raise ValueError(f"daily and weekly totals differ in {broken}: {found}")


def date_range(df: DataFrame, column: str = "date", keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def fill_down_up(daily: DataFrame, column: str, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """NULLs take the last known value of the run, leading ones the first. At most a season's days per window."""
    ordered = Window.partitionBy(*keys).orderBy("date")
    before = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known = F.coalesce(
        F.last(column, ignorenulls=True).over(before), F.first(column, ignorenulls=True).over(after)
    )
    return daily.withColumn(column, known)


def crosstab_percent(df: DataFrame, row: str, column: str, values: tuple) -> DataFrame:
    """Cross-tabulation with totals on both sides, in percent of each row.

    ``values`` are the expected column values; the rows' totals come from the same rollup.
    """
    names = [str(v).lower() for v in values]
    counted = df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(n) for v, n in zip(values, names)])
    with_total = counted.rollup(row).agg(
        *[F.sum(n).alias(n) for n in names], F.grouping(row).cast("int").alias("is_total")
    )
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    percent = lambda n: F.round(100 * F.try_divide(n.cast("double"), total), 2)
    return with_total.select(
        F.when(F.col("is_total") == 1, F.lit("Total")).otherwise(F.col(row).cast("string")).alias(row),
        *[percent(F.col(n)).alias(f"{n}_pct") for n in names],
        total.alias("n"),
    )


def cube_shares(df: DataFrame, row: str, column: str) -> DataFrame:
    """Cross-tabulation with all totals: ``row, column, row_total, column_total, n, of_row, of_column, of_all``.

    Grouping marks tell a total from a group whose value is NULL. Shares are of the total of the row, of the column and of
    all. Counted before it is cubed, so the input is expanded by nothing.
    """
    counted = df.groupBy(row, column).agg(F.count("*").alias("c"))
    cubed = counted.cube(row, column).agg(
        F.sum("c").alias("n"),
        (F.grouping(row) == 1).alias("row_total"),
        (F.grouping(column) == 1).alias("column_total"),
    )
    in_row, in_column = Window.partitionBy("row_total", row), Window.partitionBy("column_total", column)
    whole = lambda total, window: F.max(F.when(F.col(total), F.col("n"))).over(window)
    both = F.max(F.when(F.col("row_total") & F.col("column_total"), F.col("n"))).over(Window.partitionBy())  # the cube's few rows
    share = lambda of: F.try_divide(F.col("n").cast("double"), of.cast("double"))
    return cubed.select(
        row, column, "row_total", "column_total", "n",
        share(whole("column_total", in_row)).alias("of_row"),
        share(whole("row_total", in_column)).alias("of_column"),
        share(both).alias("of_all"),
    )
