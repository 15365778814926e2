"""Which dams, species and seasons a job compiles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.functions import codes

RUN_SCHEMA = pa.schema(
    {
        "run_id": pa.string(),
        "dam": pa.string(),
        "species": pa.string(),
        "spawn_year": pa.int32(),
        "start_date": pa.date32(),
        "end_date": pa.date32(),
        "tag_site": pa.string(),
        "incl_jacks": pa.bool_(),
        "unclipped_only": pa.bool_(),
        "b_run": pa.bool_(),
        "strata_beg": pa.string(),
        "last_strata_min": pa.int32(),
        "trap_rate_source": pa.string(),
        "trap_rate_cv": pa.float64(),
        "trap_rate_dist": pa.string(),
    }
)


def one_year_on(start: dt.date) -> dt.date:
    """Last day of the year that begins on ``start``."""
    try:
        return start.replace(year=start.year + 1) - dt.timedelta(days=1)
    except ValueError:  # February 29th
        return dt.date(start.year + 1, 2, 27)


def _one_of(name: str, value: object, allowed: Iterable) -> None:
    if value not in tuple(allowed):
        raise ValueError(f"{name} must be one of {tuple(allowed)}, not {value!r}")


@dataclass(frozen=True)
class Run:
    """One dam, species and season."""

    dam: str
    species: str
    start_date: dt.date
    end_date: dt.date | None = None
    spawn_year: int | None = None
    incl_jacks: bool | None = None
    steelhead_type: str = "all"
    b_run: bool = False
    strata_beg: str | None = "Mon"
    last_strata_min: int = 3
    trap_rate_source: str = "pit"
    trap_rate_cv: float = 0.0
    trap_rate_dist: str = "beta"
    run_id: str | None = None

    def __post_init__(self) -> None:
        put = lambda name, value: object.__setattr__(self, name, value)
        if self.start_date is None:
            raise ValueError("start_date is required")
        if self.end_date is None:
            put("end_date", one_year_on(self.start_date))
        if self.end_date < self.start_date:
            raise ValueError("start_date comes after end_date")
        _one_of("dam", self.dam, codes.DAMS)
        _one_of("species", self.species, codes.COMPILED_SPECIES)
        _one_of("steelhead_type", self.steelhead_type, ("all", "unclipped"))
        _one_of("strata_beg", self.strata_beg, (None, *codes.WEEKDAYS))
        _one_of("trap_rate_source", self.trap_rate_source, ("pit", "reported"))
        _one_of("trap_rate_dist", self.trap_rate_dist, ("beta", "logit"))
        if self.last_strata_min < 0:
            raise ValueError("last_strata_min must not be negative")
        if self.spawn_year is None:
            put("spawn_year", self.end_date.year)
        if self.incl_jacks is None:
            put("incl_jacks", self.species in ("Chinook", "Coho"))
        if self.run_id is None:
            put("run_id", f"{self.dam}-{self.species}-{self.spawn_year}")

    @classmethod
    def usual(cls, dam: str, species: str, spawn_year: int, **options) -> Run:
        """The season customarily compiled for this species at this dam."""
        if (species, dam) not in codes.RUN_WINDOWS:
            raise ValueError(f"no customary season for {species} at {dam}; give start_date and end_date")
        first, last = codes.RUN_WINDOWS[species, dam]
        start = dt.date.fromisoformat(f"{spawn_year - (first > last)}-{first}")
        end = dt.date.fromisoformat(f"{spawn_year}-{last}")
        return cls(dam, species, start, end, spawn_year=spawn_year, **options)

    def row(self) -> tuple:
        return (
            self.run_id, self.dam, self.species, self.spawn_year, self.start_date, self.end_date,
            codes.DAM_TO_TAG_SITE.get(self.dam), self.incl_jacks,
            self.species == "Steelhead" and self.steelhead_type == "unclipped", self.b_run,
            self.strata_beg, self.last_strata_min, self.trap_rate_source, float(self.trap_rate_cv),
            self.trap_rate_dist,
        )


def _filled(df: DataFrame) -> DataFrame:
    """A configuration table with ``Run``'s field names, its defaults filled in as ``Run`` does, columns of RUN_SCHEMA."""
    def given(name: str, default) -> Column:
        default = default if isinstance(default, Column) else F.lit(default)
        return F.coalesce(F.col(name), default) if name in df.columns else default

    end = given("end_date", F.date_sub(F.add_months("start_date", 12), 1))
    year = given("spawn_year", F.year(end)).cast("int")
    weekday = F.col("strata_beg") if "strata_beg" in df.columns else F.lit("Mon")
    unclipped = (F.col("species") == "Steelhead") & (given("steelhead_type", "all") == "unclipped")
    return df.select(
        given("run_id", F.concat_ws("-", "dam", "species", year.cast("string"))).alias("run_id"), "dam", "species",
        year.alias("spawn_year"), "start_date", end.alias("end_date"),
        codes.translate(F.col("dam"), codes.DAM_TO_TAG_SITE).alias("tag_site"),
        given("incl_jacks", F.col("species").isin("Chinook", "Coho")).alias("incl_jacks"),
        unclipped.alias("unclipped_only"), given("b_run", False).alias("b_run"),
        weekday.alias("strata_beg"), given("last_strata_min", 3).cast("int").alias("last_strata_min"),
        given("trap_rate_source", "pit").alias("trap_rate_source"),
        given("trap_rate_cv", 0.0).cast("double").alias("trap_rate_cv"),
        given("trap_rate_dist", "beta").alias("trap_rate_dist"),
    )


def _valid() -> Column:
    among = lambda name, values: F.coalesce(F.col(name).isin(*values), F.lit(False))
    weekday = F.col("strata_beg").isNull() | among("strata_beg", codes.WEEKDAYS)
    lists = among("dam", codes.DAMS) & among("species", codes.COMPILED_SPECIES) & weekday
    lists = lists & among("trap_rate_source", ("pit", "reported")) & among("trap_rate_dist", ("beta", "logit"))
    return lists & F.coalesce((F.col("end_date") >= F.col("start_date")) & (F.col("last_strata_min") >= 0), F.lit(False))


class Seasons:
    """The runs of one job: a small frame, and the days it spans."""

    def __init__(self, spark: SparkSession, runs: Iterable[Run]):
        self.spark = spark
        self.runs = list(runs)
        if not self.runs:
            raise ValueError("at least one run is needed")
        if len({r.run_id for r in self.runs}) < len(self.runs):
            raise ValueError("run_id must be unique")
        columns = list(zip(*[r.row() for r in self.runs]))
        arrays = [pa.array(values, kind) for values, kind in zip(columns, RUN_SCHEMA.types)]
        # A local relation: no Python tasks, and a size the optimizer knows.
        self.frame = spark.createDataFrame(pa.Table.from_arrays(arrays, schema=RUN_SCHEMA))
        self.first_day = min(r.start_date for r in self.runs)
        self.last_day = max(r.end_date for r in self.runs)

    @classmethod
    def _of(cls, frame: DataFrame, first_day: dt.date, last_day: dt.date) -> Seasons:
        out = cls.__new__(cls)
        out.spark, out.runs, out.frame = frame.sparkSession, None, frame
        out.first_day, out.last_day = first_day, last_day
        return out

    @classmethod
    def from_frame(cls, df: DataFrame) -> Seasons:
        """Runs from a configuration table with ``Run``'s field names. They stay a table; one aggregate checks them."""
        frame = _filled(df)
        seen = frame.agg(
            F.min("start_date"), F.max("end_date"), F.count("*"), F.count_distinct("run_id"), F.count_if(~_valid())
        ).first()
        first_day, last_day, n, n_ids, bad = seen
        if not n:
            raise ValueError("at least one run is needed")
        if bad:
            raise ValueError(f"{bad} runs have values that are not allowed")
        if n_ids < n:
            raise ValueError("run_id must be unique")
        return cls._of(frame, first_day, last_day)

    def of_source(self, source: str) -> Seasons | None:
        """The runs with this source of trap rates; None if it is known that there are none."""
        if self.runs is None:
            return Seasons._of(self.frame.filter(F.col("trap_rate_source") == source), self.first_day, self.last_day)
        runs = [r for r in self.runs if r.trap_rate_source == source]
        return Seasons(self.spark, runs) if runs else None
