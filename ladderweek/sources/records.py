"""From the provider's columns to the normalised records the operators work on.

Each ``parse_*`` takes a frame with snake_case names, text or typed, and drops the footer rows the providers append.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.functions import codes
from ladderweek.functions.expressions import rename_present
from ladderweek.operators.trap import adult_cohort, clean_tag, clip_flag, wire_flag
from ladderweek.sources.files import read_each, read_text_table, trap_rate_files

# The two layouts of detection files, old name -> normalised name.
DETECTION_NAMES = {"clock_date": "date", "detection_date_time": "detection_time", "tag_id_ascent_count": "ascent_count"}
UPPER_COLUMBIA_NAMES = {
    "previous_detect_date": "previous_date",
    "diff_previous_hours": "previous_hours",
    "diff_previous_days": "previous_days",
    "ladder2": "ladder",
    "ladder9": "ladder_side",
}
# Trap record names, old -> normalised.
TRAP_NAMES = {
    "lgd_num_pit": "tag_code",
    "pit_tag": "tag_code",
    "event_date": "date",
    "species_run_rear_type": "srr",
    "lgd_mark_ad": "ad_clip",
    "lgd_sex": "sex",
    "lgdf_lmm": "length",
    "lgd_rear": "origin",
    "lgd_valid": "valid",
    "lgd_life_stage": "life_stage",
    "pt_agis_sx_cgra_obs": "sort_by_code",
    "ptagis_sxcgra_obs": "sort_by_code",
}
# Reported-rate columns by treatment. The provider's file may hold more columns in each range; pass
# the full lists where it does.
RATE_SUMS = (
    "samp_time", "n_samples", "n_sby_c", "n_close", "tot_fish_trap", "total_time", "total_time_inclusive", "all_pit",
)
RATE_MEANS = ("rate", "actual_rate_inclusive_time")
RATE_NAMES = {"number_samples": "n_samples", "number_sby_c": "n_sby_c", "number_close": "n_close"}

# Shape of a date text -> how to read it. The shape is tested first, as a parser that fails costs far
# more than a pattern that does not match.
MDY_TIMES = {
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$": "M/d/yyyy H:mm",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$": "M/d/yyyy H:mm:ss",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$": "M/d/yyyy h:mm:ss a",
}
YMD_TIMES = {
    r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d",
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}$": "yyyy-M-d H:mm",
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$": "yyyy-M-d H:mm:ss",
    r"^\d{4}-\d{2}-\d{2}T.*$": "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]",
    r"^\d{8}$": "yyyyMMdd",
}


def _type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def to_time(df: DataFrame, column: str, shapes: dict[str, str]) -> Column:
    """Timestamp of a text column, read by its shape; NULL if it has none of them. Typed columns pass."""
    text = F.col(column)
    if _type_of(df, column) != "string":
        return text.cast("timestamp")
    read = F.lit(None).cast("timestamp")
    for shape, pattern in reversed(shapes.items()):
        read = F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern))).otherwise(read)
    return read


def to_day(df: DataFrame, column: str, shapes: dict[str, str]) -> Column:
    if _type_of(df, column) == "date":
        return F.col(column)
    return to_time(df, column, shapes).cast("date")


def _cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts the columns that exist; values that do not fit become NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def parse_window_counts(raw: DataFrame) -> DataFrame:
    """``location, year, mm_dd, parameter, value`` to ``dam, year, date, species, win_cnt``."""
    rows = _cast(raw.filter(F.col("location").isNotNull()), {"year": "int", "value": "double"})
    day = F.try_to_timestamp(F.concat_ws("-", F.col("year").cast("string"), "mm_dd"), F.lit("yyyy-M-d"))
    return rows.select(
        F.col("location").alias("dam"), "year", day.cast("date").alias("date"),
        codes.translate(F.col("parameter"), codes.WINDOW_PARAMETERS, keep_unknown=True).alias("species"),
        F.col("value").alias("win_cnt"),
    )


def parse_detections(
    raw: DataFrame, dam: str | None = None, species: str | None = None, year: int | None = None
) -> DataFrame:
    """Ladder detections of both layouts to one. ``year`` is the season's last year; by default the detection's."""
    df = rename_present(raw, DETECTION_NAMES)
    if "ladder2" in df.columns or "previous_detect_date" in df.columns:
        df = rename_present(df, UPPER_COLUMBIA_NAMES)
    df = df.filter(F.col("species").isNotNull()).withColumnRenamed("species", "sp_code")
    df = df.withColumn("date", to_day(df, "date", YMD_TIMES))
    if "detection_time" in df.columns:
        df = df.withColumn("detection_time", to_time(df, "detection_time", YMD_TIMES))
    if "previous_date" in df.columns:
        df = df.withColumn("previous_date", to_day(df, "previous_date", YMD_TIMES))
    df = _cast(df, {"ascent_count": "int", "previous_hours": "double", "previous_days": "double"})
    name = F.lit(species) if species else codes.translate(F.substring("sp_code", 1, 1), codes.TAG_SPECIES)
    df = df.withColumn("species", name).withColumn("year", F.lit(year) if year else F.year("date"))
    return df.withColumn("dam", F.lit(dam)) if dam else df


def parse_observations(raw: DataFrame, dam: str | None = None) -> DataFrame:
    """Tag observations at the dam's detection site."""
    df = rename_present(raw, {"tag_id": "tag_code"}).filter(F.col("tag_file").isNotNull())
    df = df.withColumn("obs_time", to_time(df, "obs_time", YMD_TIMES))
    if "release_date" in df.columns:
        df = df.withColumn("release_date", to_day(df, "release_date", YMD_TIMES))
    df = _cast(df, {"year": "int"})
    return df.withColumn("dam", F.lit(dam)) if dam else df


def parse_reported_rates(
    raw: DataFrame,
    dam: str | None = None,
    species: str | None = None,
    sums: tuple[str, ...] = RATE_SUMS,
    means: tuple[str, ...] = RATE_MEANS,
) -> DataFrame:
    df = rename_present(raw, RATE_NAMES)
    df = df.withColumn("date", to_day(df, "date", MDY_TIMES))
    df = _cast(df, {"year": "int", "doy": "int", **dict.fromkeys((*sums, *means), "double")})
    for name, value in (("dam", dam), ("species", species)):
        df = df.withColumn(name, F.lit(value)) if value else df
    return df


def harmonise_trap(raw: DataFrame, dam: str | None = None, species_from: str = "srr") -> DataFrame:
    """Trap records of either layout under common names.

    The species comes from the first digit of the species/run/rear code, or with ``species_from="code"`` from the
    recorded species code, unless the records name it. Records without a validity column are valid; ``has_cohort`` tells
    whether the layout records life stage and diversion.
    """
    df = rename_present(raw, TRAP_NAMES)
    if "date" not in df.columns and "collection_date" in df.columns:
        df = df.withColumn("date", to_time(df, "collection_date", MDY_TIMES | YMD_TIMES).cast("date"))
    elif "date" in df.columns:
        df = df.withColumn("date", to_day(df, "date", MDY_TIMES | YMD_TIMES))
    if "tag_code" in df.columns:
        df = df.withColumn("tag_code", clean_tag(F.col("tag_code")))
    if "ad_clip" in df.columns and _type_of(df, "ad_clip") != "boolean":
        df = df.withColumn("ad_clip", clip_flag(F.col("ad_clip")))
    if "cwt" not in df.columns and "lgd_tags_all" in df.columns:
        df = df.withColumn("cwt", wire_flag(F.col("lgd_tags_all")))
    df = _cast(df, {"valid": "int", "length": "double", "lgd_species": "int"})
    if "valid" not in df.columns:
        df = df.withColumn("valid", F.lit(1))
    if "species" not in df.columns:
        by_code = codes.translate(F.col("lgd_species").cast("string"), codes.TRAP_SPECIES) if (
            species_from == "code"
        ) else codes.species_of_srr(F.col("srr"))
        df = df.withColumn("species", by_code)
    else:
        df = df.withColumn("species", F.initcap("species"))
    cohort = ("life_stage", "sort_by_code")
    df = df.withColumn("has_cohort", F.lit("life_stage" in df.columns))
    df = df.withColumns({c: F.lit(None).cast("string") for c in (*cohort, "srr") if c not in df.columns})
    return df.withColumn("dam", F.lit(dam)) if dam else df


def read_window_counts(spark: SparkSession, sources: dict[str, str]) -> tuple[DataFrame | None, DataFrame]:
    """One file or folder per dam; dams without data are reported."""
    return read_each(spark, sources, parse_window_counts)


def read_detections(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    return parse_detections(read_text_table(spark, paths), **options)


def read_observations(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    return parse_observations(read_text_table(spark, paths), **options)


def read_reported_rates(
    spark: SparkSession, folder: str, first_day: dt.date, last_day: dt.date, species: str, dam: str = "LWG"
) -> tuple[DataFrame | None, DataFrame]:
    """Reported rates of every year a season touches."""
    code = {name: digit for digit, name in codes.TAG_SPECIES.items()}
    if species not in code:
        raise ValueError(f"no reported trap rates for {species!r}")
    files = trap_rate_files(folder, range(first_day.year, last_day.year + 1), int(code[species]))
    return read_each(spark, files, lambda raw: parse_reported_rates(raw, dam=dam, species=species))


def read_trap(
    spark: SparkSession,
    paths: str | list[str],
    dam: str = "LWG",
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """Adult trap records, species by recorded code; an optional closed date range."""
    records = adult_cohort(harmonise_trap(read_text_table(spark, paths), dam=dam, species_from="code"))
    if first_day:
        records = records.filter(F.col("date") >= F.lit(first_day))
    if last_day:
        records = records.filter(F.col("date") <= F.lit(last_day))
    return records


def empty_records(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
