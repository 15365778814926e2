"""The driver's tables read as if they were the providers' files, so that every operator runs on them whole.

Nothing here is sampled: each function maps all rows of its tables.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.config import Run, Seasons
from ladderweek.operators import trap as trap_ops
from ladderweek.session import scratch_path
from ladderweek.sources import records
from ladderweek.sources.files import path_exists

DAM_OF_REGION = {"AFRICA": "LWG", "AMERICA": "PRD", "ASIA": "RIS", "EUROPE": "RRH", "MIDDLE EAST": "BON"}
PARAMETER_OF_PRIORITY = {
    "1-URGENT": "Chin",
    "2-HIGH": "JChin",
    "3-MEDIUM": "Stlhd",
    "4-NOT SPECIFIED": "WStlhd",
    "5-LOW": "Coho",
}
DIGIT_OF_TYPE = {"ECONOMY": "1", "PROMO": "1", "LARGE": "3", "SMALL": "3", "MEDIUM": "2", "STANDARD": "2"}
SRR_OF_SEGMENT = {
    "AUTOMOBILE": "11W",
    "BUILDING": "11W",
    "FURNITURE": "31W",
    "HOUSEHOLD": "31W",
    "MACHINERY": "25W",
}


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def choose(column: str, options: dict[str, str]) -> Column:
    out = None
    for key, value in options.items():
        hit = F.col(column) == key
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def dam_of(df: DataFrame, spark: SparkSession, sf_dir: str, nation_key: str) -> DataFrame:
    """The rows with their dam. Nations do not grow with the tables, so they go to the rows, never the rows to them."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", choose("r_name", DAM_OF_REGION).alias("dam")
    )
    return df.join(F.broadcast(places), F.col(nation_key) == F.col("n_nationkey"))


@lru_cache(maxsize=16)
def _years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    spans = [
        table(spark, sf_dir, name).agg(F.min(c).cast("date").alias("a"), F.max(c).cast("date").alias("b"))
        for name, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    row = spans[0].unionAll(spans[1]).agg(F.year(F.min("a")), F.year(F.max("b"))).first()
    return row[0], row[1]


@lru_cache(maxsize=64)
def seasons(spark: SparkSession, sf_dir: str) -> Seasons:
    """Every dam, species and year of the tables; the seasons of a species leave no day out."""
    first, last = _years(spark, sf_dir)
    runs = []
    for dam in DAM_OF_REGION.values():
        for y in range(first, last + 1):
            year = (dt.date(y, 1, 1), dt.date(y, 12, 31))
            runs.append(Run(dam, "Chinook", *year))
            runs.append(Run(dam, "Coho", *year, strata_beg=None, trap_rate_source="reported", trap_rate_cv=0.1))
        for y in range(first, last + 2):
            runs.append(
                Run(
                    dam, "Steelhead", dt.date(y - 1, 7, 1), dt.date(y, 6, 30), steelhead_type="unclipped",
                    b_run=True, strata_beg="Sun", trap_rate_dist="logit",
                )
            )
    return Seasons(spark, runs)


@lru_cache(maxsize=64)
def orders_at_dams(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return dam_of(orders, spark, sf_dir, "c_nationkey").withColumn("day", F.to_date("o_orderdate"))


def window_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts per dam and series; no count on the 13th of a month (window closed).

    The day is taken from what was counted, not from the key, so that whoever reads its text reads it once a day, not once an order.
    """
    fish = F.sum(F.floor(F.col("o_totalprice") / 2000)).cast("double")
    keyed = orders_at_dams(spark, sf_dir).withColumn("counted_on", F.col("day"))
    daily = keyed.groupBy("dam", "counted_on", "o_orderpriority").agg(fish.alias("fish"), F.max("day").alias("day"))
    return daily.select(
        F.col("dam").alias("location"), F.year("day").alias("year"), F.date_format("day", "M-d").alias("mm_dd"),
        choose("o_orderpriority", PARAMETER_OF_PRIORITY).alias("parameter"),
        F.when(F.dayofmonth("day") != 13, F.col("fish")).alias("value"),
    )


@lru_cache(maxsize=64)
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_window_counts(window_raw(spark, sf_dir))


def observations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = F.when(F.col("o_orderpriority") == "1-URGENT", "LGRLDR").when(
        F.col("o_orderpriority") == "2-HIGH", "PRDLD1"
    ).when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return orders_at_dams(spark, sf_dir).select(
        "dam", F.concat(F.lit("file-"), "o_orderstatus").alias("tag_file"),
        F.col("o_orderkey").cast("string").alias("tag_id"),
        choose("c_mktsegment", SRR_OF_SEGMENT).alias("sp_rrt"), site.alias("mark_site"),
        F.col("o_orderdate").alias("obs_time"), F.year("o_orderdate").alias("year"),
    )


@lru_cache(maxsize=64)
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_observations(observations_raw(spark, sf_dir))


@lru_cache(maxsize=64)
def shipments_at_dams(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    digit = choose("p_type", DIGIT_OF_TYPE).alias("digit")
    part = table(spark, sf_dir, "part").select("p_partkey", digit, "p_size")
    lines = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(part.hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
    return dam_of(lines, spark, sf_dir, "s_nationkey").withColumn("day", F.to_date("l_shipdate"))


#: What the providers' files are made of, out of a shipment.
SHIPMENT = (
    "dam", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate", "digit", "p_size",
)


@lru_cache(maxsize=64)
def _stored_at(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return {}


def stored_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipments, joined once, written to the shared folder and read back: for jobs that read them several times.

    Each file is in order of days, so a task that counts by day meets the groups of one day together.
    """
    ships, at = shipments_at_dams(spark, sf_dir).select(*SHIPMENT), _stored_at(spark, sf_dir)
    if "shipments" not in at or not path_exists(spark, at["shipments"]):
        path = scratch_path(spark, "shipments")
        ships.sortWithinPartitions("l_shipdate").write.parquet(path)
        at["shipments"] = path
    return spark.read.schema(ships.schema).parquet(at["shipments"]).withColumn("day", F.to_date("l_shipdate"))


OTHER_LAYOUT = "PRD"  # the dam whose trap records come in the second layout


def _lower_layout() -> list[Column]:
    rear = choose("l_returnflag", {"A": "W", "N": "H", "R": "U"})
    return [
        F.col("dam"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("master_id"),
        F.col("l_orderkey").cast("string").alias("lgd_num_pit"),
        F.col("l_shipdate").alias("collection_date"),
        F.when(F.col("l_quantity") != 25, F.concat("digit", F.lit("1"), rear)).alias("srr"),
        F.col("digit").cast("int").alias("lgd_species"),
        rear.alias("lgd_rear"),
        F.when(F.col("l_tax") == 0.08, "RJ").otherwise("RF").alias("lgd_life_stage"),
        F.when(F.col("l_quantity") == 50, "XX").otherwise(choose("l_linestatus", {"F": "AD", "O": "AI"}))
        .alias("lgd_mark_ad"),
        F.when(F.col("l_tax") == 0, 0).otherwise(1).alias("lgd_valid"),
        (F.col("p_size") * 20).cast("double").alias("lgdf_lmm"),
        F.when(F.col("l_discount") == 0.1, "Yes").when(F.col("l_discount") > 0, "No").alias("ptagis_sxcgra_obs"),
        F.when(F.col("l_linenumber") == 1, "Wire, left").when(F.col("l_linenumber") > 2, "none").alias("lgd_tags_all"),
    ]


def _upper_layout() -> list[Column]:
    """The second layout: other names, the species by name, and neither validity, life stage nor diversion."""
    rear = choose("l_returnflag", {"A": "W", "N": "H", "R": "U"})
    return [
        F.col("dam"),
        F.col("l_orderkey").cast("string").alias("pit_tag"),
        F.col("l_shipdate").alias("event_date"),
        choose("digit", {"1": "chinook", "2": "coho", "3": "steelhead"}).alias("species"),
        F.when(F.col("l_quantity") != 25, F.concat("digit", F.lit("1"), rear)).alias("species_run_rear_type"),
        rear.alias("origin"),
        F.when(F.col("l_quantity") == 50, "XX").otherwise(choose("l_linestatus", {"F": "AD", "O": "AI"})).alias("ad_clip"),
        (F.col("p_size") * 20).cast("double").alias("length"),
    ]


def trap_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments_at_dams(spark, sf_dir).filter(F.col("dam") != OTHER_LAYOUT).select(*_lower_layout())


def trap_raw_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipments_at_dams(spark, sf_dir).filter(F.col("dam") == OTHER_LAYOUT).select(*_upper_layout())


@lru_cache(maxsize=64)
def trap_records(spark: SparkSession, sf_dir: str, species_from: str = "srr") -> DataFrame:
    return trap_records_of(shipments_at_dams(spark, sf_dir), species_from)


def trap_records_of(shipments: DataFrame, species_from: str = "srr") -> DataFrame:
    """Records of both layouts out of one scan: read as either, a record keeps the columns of its own."""
    ships = shipments.filter(F.col("dam").isNotNull())
    upper_raw = ships.select(*_upper_layout()[1:]).columns
    raw = ships.select(*_lower_layout(), *[c.alias("upper_" + name) for name, c in zip(upper_raw, _upper_layout()[1:])])
    lower = records.harmonise_trap(raw, species_from=species_from)
    names = [c for c in lower.columns if not c.startswith("upper_")]
    kept = lower.withColumnsRenamed({c: "lower_" + c for c in names if c != "dam"})
    beside = kept.withColumnsRenamed({"upper_" + c: c for c in upper_raw})
    upper = records.harmonise_trap(beside, species_from=species_from)
    is_upper = F.col("dam") == OTHER_LAYOUT
    theirs = [c for c in upper.columns if not c.startswith("lower_")]

    def of_own(name: str) -> Column:
        given = F.col(name) if name in theirs else F.lit(None)
        if name == "dam":
            return given
        chosen = F.when(is_upper, given)
        return (chosen.otherwise(F.col("lower_" + name)) if name in names else chosen).alias(name)

    return upper.select(*[of_own(c) for c in (*names, *[c for c in theirs if c not in names])])


@lru_cache(maxsize=64)
def trap_cohort(spark: SparkSession, sf_dir: str, species_from: str = "srr") -> DataFrame:
    return trap_ops.adult_cohort(trap_records(spark, sf_dir, species_from))


def detections_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections_raw_of(shipments_at_dams(spark, sf_dir))


def detections_raw_of(shipments: DataFrame) -> DataFrame:
    return shipments.select(
        "dam", F.col("digit").alias("species"), F.col("day").alias("clock_date"),
        F.col("l_shipdate").alias("detection_date_time"),
        F.col("l_partkey").cast("string").alias("tag_id"),
        choose("l_returnflag", {"A": "W", "N": "H"}).alias("rear_type"),
        F.when(F.col("l_quantity") == 50, "X").otherwise(choose("l_linestatus", {"F": "D", "O": "N"})).alias("period"),
        F.col("l_linenumber").alias("tag_id_ascent_count"),
    )


@lru_cache(maxsize=64)
def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections_of(shipments_at_dams(spark, sf_dir))


def detections_of(shipments: DataFrame) -> DataFrame:
    return records.parse_detections(detections_raw_of(shipments))


def event_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = {"view": "Chinook", "click": "Chinook", "error": "Steelhead", "signup": "Steelhead", "purchase": "Coho"}
    return table(spark, sf_dir, "events").select(
        choose("event_type", kind).alias("species"), F.year("ts").alias("year"), F.to_date("ts").alias("date"),
        F.col("user_id").cast("string").alias("tag_id"),
        F.when(F.hour("ts").between(4, 19), "D").otherwise("N").alias("period"),
        F.when(F.col("value") < 10, "W").when(F.col("value") < 20, "H").alias("rear_type"),
        F.floor(F.col("value") / 10).cast("int").alias("ascent_count"),
    )


def rates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates_raw_of(shipments_at_dams(spark, sf_dir))


def rates_raw_of(shipments: DataFrame) -> DataFrame:
    kind = {"1": "Chinook", "2": "Coho", "3": "Steelhead"}
    return shipments.select(
        "dam", choose("digit", kind).alias("species"), F.col("day").alias("date"),
        F.year("day").alias("year"), F.dayofyear("day").alias("doy"),
        F.col("l_quantity").alias("samp_time"),
        F.col("l_linenumber").alias("number_samples"),
        (F.col("l_discount") > 0.05).cast("int").alias("number_sby_c"),
        (F.col("l_tax") > 0.05).cast("int").alias("number_close"),
        (F.col("l_linenumber") + 1).alias("tot_fish_trap"),
        F.when(F.col("l_tax") == 0, 0.0).otherwise(F.col("l_quantity")).alias("total_time"),
        (F.col("l_quantity") * 600).alias("total_time_inclusive"),
        F.col("l_linenumber").alias("all_pit"),
        F.when(F.col("l_tax") != 0.01, F.col("l_discount")).alias("rate"),
        (F.col("l_discount") + F.col("l_tax")).alias("actual_rate_inclusive_time"),
    )


@lru_cache(maxsize=64)
def reported_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reported_rates_of(shipments_at_dams(spark, sf_dir))


def reported_rates_of(shipments: DataFrame) -> DataFrame:
    return records.parse_reported_rates(rates_raw_of(shipments))


@lru_cache(maxsize=64)
def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State draws: a vector's elements are four states in each of sixteen weeks; two chains per run."""
    first, _ = _years(spark, sf_dir)
    year = F.lit(first) + F.floor(F.col("label") / 2)
    parts = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("LWG-Chinook-"), year.cast("string")).alias("run_id"), F.col("label").alias("chain"),
        F.col("vec_id").alias("iter"), F.posexplode("embedding").alias("at", "e"),
    )
    v, week = F.col("e").cast("double"), (F.floor(F.col("at") / 4) + 1).cast("string")
    named = lambda name, x: F.struct(
        F.concat(F.lit(name), F.lit("["), week, F.lit("]")).alias("param"), x.alias("value")
    )
    phi = lambda j, x: F.struct(
        F.concat(F.lit("org.phi["), week, F.lit(f", {j}]")).alias("param"), x.alias("value")
    )
    kind = F.col("at") - 4 * F.floor(F.col("at") / 4)
    rows = (
        F.when(kind == 0, F.array(named("X.log.all", 5 + 4 * v)))
        .when(kind == 1, F.array(named("day.true.logit", 8 * v)))
        .when(kind == 2, F.array(named("reasc.true.logit", 8 * v - 2)))
        .otherwise(F.array(phi(1, 8 * v), phi(2, -4 * v)))
    )
    return parts.select("run_id", "chain", "iter", F.inline(rows))
