"""One query per operator over the driver's tables, each with the DuckDB SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import landed, oracle
from ladderweek.config import Run, Seasons
from ladderweek.functions.codes import COMPILED_SPECIES, RUN_WINDOWS
from ladderweek.functions.expressions import in_chinook_season, is_true, spawn_year
from ladderweek.operators import draws as draw_ops
from ladderweek.operators import (
    expansion,
    posterior,
    rollup,
    strata,
    tags,
    trap,
    trap_rate,
    window_counts,
)
from ladderweek.plans import compile as plan
from ladderweek.plans import model_input as model
from ladderweek.plans import union
from ladderweek.session import scratch_path
from ladderweek.sources import files, records

S, D = SparkSession, str


@dataclass
class Query:
    """``fields`` names the result columns and their kind.

    i is a whole number, d a number to six places, r a rate (below 1 or so) to nine, s a value as it is. Rates are
    quotients of short decimals, so six places would often fall on a tie.
    """

    fields: str
    build: Callable[[SparkSession, str], DataFrame]
    body: str | None

    def columns(self) -> list[tuple[str, str]]:
        return [tuple(part.strip().split(" ")) for part in self.fields.split(",")]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        as_kind = {
            "i": lambda c: F.col(c).cast("bigint"),
            "d": lambda c: F.round(F.col(c).cast("double"), 6),
            "r": lambda c: F.round(F.col(c).cast("double"), 9),
            "s": F.col,
        }
        return df.select(*[as_kind[kind](name).alias(name) for name, kind in self.columns()])

    def sql(self) -> str | None:
        if self.body is None:
            return None
        as_kind = {"i": "CAST({c} AS BIGINT)", "s": "{c}"}
        as_kind |= {k: f"round(CAST({{c}} AS DOUBLE), {n})" for k, n in (("d", 6), ("r", 9))}
        listed = ", ".join(f"{as_kind[kind].format(c=name)} AS {name}" for name, kind in self.columns())
        return oracle.sql(f"SELECT {listed} FROM ({self.body})")


QUERIES: dict[str, Query] = {}


def query(fields: str, body: str | None = None):
    def keep(build):
        QUERIES[build.__name__] = Query(fields, build, body)
        return build

    return keep


def kinds(names, kind: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names)


TAGS_I = kinds(oracle.TAG_COLUMNS, "i")
TRAP_I = kinds([c for c in oracle.TRAP_COLUMNS if c != "tot_b_run_sthd"], "i")
SUMS_D, MEANS_R = kinds(oracle.SUMS, "d"), kinds(oracle.MEANS, "r")
QUANT_D = kinds(posterior.QUANTILES, "d")


# ---- strata -------------------------------------------------------------------------------------------------


@query(
    "run_id s, week_num i, start_date s, end_date s, n_days i, n_records i",
    """SELECT s.*, coalesce(n, 0) AS n_records FROM strata s LEFT JOIN
       (SELECT run_id, week_num, count(*) AS n FROM trap t JOIN cal c ON t.dam = c.dam AND t.species = c.species
        AND t.date = c.date GROUP BY ALL) USING (run_id, week_num)""",
)
def weekly_strata(spark: S, sf: D) -> DataFrame:
    seasons = landed.seasons(spark, sf)
    placed = strata.attach_strata(landed.trap_cohort(spark, sf), seasons)
    counted = placed.groupBy("run_id", "week_num").agg(F.count("*").alias("n_records"))
    return strata.strata(seasons).join(counted, ["run_id", "week_num"], "left").fillna(0, ["n_records"])


@query(
    "run_id s, week_num i, date s, n_obs i",
    """SELECT c.run_id, week_num, c.date, count(*) AS n_obs FROM obs o JOIN cal c ON o.dam = c.dam
       AND o.obs_date = c.date GROUP BY ALL""",
)
def strata_calendar(spark: S, sf: D) -> DataFrame:
    obs = landed.observations(spark, sf).withColumn("date", F.to_date("obs_time"))
    placed = strata.attach_strata(obs, landed.seasons(spark, sf), on=("dam", "date"))
    return placed.groupBy("run_id", "week_num", "date").agg(F.count("*").alias("n_obs"))


@query(
    "dam s, n_outside i",
    """SELECT dam, count(*) AS n_outside FROM obs o WHERE NOT EXISTS (SELECT 1 FROM cal c JOIN runs USING (run_id)
       WHERE c.dam = o.dam AND c.date = o.obs_date AND month(c.date) BETWEEN 3 AND 8 AND c.species = 'Chinook')
       GROUP BY dam""",
)
def records_outside_strata(spark: S, sf: D) -> DataFrame:
    every = landed.seasons(spark, sf)
    spring = [
        Run(r.dam, r.species, r.start_date.replace(month=3), r.end_date.replace(month=8))
        for r in every.runs
        if r.species == "Chinook"
    ]
    obs = landed.observations(spark, sf).withColumn("date", F.to_date("obs_time"))
    return strata.outside_strata(obs, Seasons(spark, spring), on=("dam", "date"))


@query(
    "dam s, first_date s, last_date s",
    "SELECT dam, min(date) AS first_date, max(date) AS last_date FROM trap GROUP BY dam",
)
def trap_date_range(spark: S, sf: D) -> DataFrame:
    return rollup.date_range(landed.trap_cohort(spark, sf), keys=("dam",))


# ---- window counts ------------------------------------------------------------------------------------------

SERIES = ("Chinook", "Jack_Chinook", "Coho", "Jack_Coho", "Steelhead", "Wild_Steelhead")
WIDE_SQL = "SELECT dam, year, date, " + ", ".join(
    f"CASE WHEN bool_or(species = '{s}') THEN sum(win_cnt) FILTER (species = '{s}') ELSE 0 END AS {s.lower()}"
    for s in SERIES
) + " FROM win GROUP BY dam, year, date"
WIDE_D = kinds([s.lower() for s in SERIES], "d")


@query(f"dam s, year i, date s, {WIDE_D}", WIDE_SQL)
def window_counts_pivot(spark: S, sf: D) -> DataFrame:
    return window_counts.counts_wide(landed.window_counts(spark, sf), SERIES)


@query(
    "dam s, year i, date s, species s, win_cnt d",
    f"SELECT * FROM ({WIDE_SQL}) UNPIVOT INCLUDE NULLS (win_cnt FOR species IN "
    f"({', '.join(s.lower() for s in SERIES)}))",
)
def window_counts_unpivot(spark: S, sf: D) -> DataFrame:
    return window_counts.counts_long(window_counts.counts_wide(landed.window_counts(spark, sf), SERIES))


MERGED = ("Chinook", "Coho", "Jack_Chinook", "Steelhead", "Wild_Steelhead")


@query(
    "dam s, year i, date s, " + kinds([n.lower() for n in MERGED], "d"),
    "SELECT dam, year, date, "
    + ", ".join(f"sum(CASE WHEN species = '{n}' THEN win_cnt END) AS {n.lower()}" for n in MERGED)
    + " FROM win WHERE win_cnt IS NOT NULL GROUP BY dam, year, date",
)
def window_counts_merge(spark: S, sf: D) -> DataFrame:
    counts = landed.window_counts(spark, sf)
    known = counts.filter(F.col("win_cnt").isNotNull())

    def part(names: list[str]) -> DataFrame:
        cells = [F.sum(F.when(F.col("species") == n, F.col("win_cnt"))).alias(n.lower()) for n in names]
        return known.filter(F.col("species").isin(*names)).groupBy("dam", "year", "date").agg(*cells)

    series = [["Steelhead", "Wild_Steelhead"], ["Coho"], ["Jack_Chinook", "Chinook"]]
    return window_counts.merge_wide([part(names) for names in series])


@query("run_id s, week_num i, date s, win_cnt d, window_open s", "SELECT * FROM win_daily")
def window_counts_jacks(spark: S, sf: D) -> DataFrame:
    return window_counts.window_daily(landed.window_counts(spark, sf), landed.seasons(spark, sf))


@query(
    "run_id s, n_days i, n_open i, n_open_legacy i",
    """SELECT run_id, count(*) AS n_days, count(*) FILTER (adults IS NOT NULL) AS n_open,
       count(*) FILTER (jacks OR adults IS NOT NULL) AS n_open_legacy FROM win_run GROUP BY run_id""",
)
def window_open_flag(spark: S, sf: D) -> DataFrame:
    counts, seasons = landed.window_counts(spark, sf), landed.seasons(spark, sf)
    plain = window_counts.window_daily(counts, seasons).withColumn("legacy", F.lit(False))
    legacy = window_counts.window_daily(counts, seasons, legacy_open=True).withColumn("legacy", F.lit(True))
    both = plain.unionByName(legacy)
    return both.groupBy("run_id").agg(
        F.count_if(~F.col("legacy")).alias("n_days"),
        F.count_if(F.col("window_open") & ~F.col("legacy")).alias("n_open"),
        F.count_if(F.col("window_open") & F.col("legacy")).alias("n_open_legacy"),
    )


SERIES_SQL = f"""SELECT dam, year, date, species, open AS window_open,
  CASE species WHEN 'Chinook' THEN coalesce(chinook,0) + coalesce(jack_chinook,0)
    WHEN 'Coho' THEN coalesce(coho,0) + coalesce(jack_coho,0) ELSE coalesce(wild_steelhead,0) END AS win_cnt,
  CASE WHEN species = 'Steelhead' AND month(date) >= 7 THEN year + 1 ELSE year END AS spawn_year
  FROM (SELECT *, coalesce(chinook, jack_chinook, coho, jack_coho, steelhead, wild_steelhead) IS NOT NULL AS open
        FROM ({WIDE_SQL})), (VALUES ('Chinook'), ('Coho'), ('Steelhead')) v(species)"""
IN_SEASON = "(species <> 'Chinook' OR date BETWEEN make_date(year,3,1) AND make_date(year,8,17))"


def _season_series(spark: S, sf: D) -> DataFrame:
    wide = window_counts.counts_wide(landed.window_counts(spark, sf), SERIES)
    series = window_counts.season_series(wide)
    return series.withColumn("spawn_year", spawn_year(F.col("species"), F.col("year"), F.col("date")))


@query("dam s, date s, species s, spawn_year i, win_cnt d, window_open s", SERIES_SQL)
def spawn_years(spark: S, sf: D) -> DataFrame:
    return _season_series(spark, sf)


@query(
    "dam s, date s, species s, spawn_year i, win_cnt d, window_open s",
    f"SELECT * FROM ({SERIES_SQL}) WHERE {IN_SEASON}",
)
def season_clip(spark: S, sf: D) -> DataFrame:
    clipped = (F.col("species") != "Chinook") | in_chinook_season(F.col("date"))
    return _season_series(spark, sf).filter(clipped)


# ---- tags ---------------------------------------------------------------------------------------------------


@query(
    f"species s, spawn_year i, date s, {TAGS_I}",
    f"""SELECT species, CASE WHEN species = 'Steelhead' AND month(date) >= 7 THEN year + 1 ELSE year END AS spawn_year,
        date, {oracle.TAG_SUMS} FROM evt GROUP BY ALL""",
)
def pit_daily(spark: S, sf: D) -> DataFrame:
    return tags.tag_daily(landed.event_detections(spark, sf))


@query(f"run_id s, week_num i, date s, {TAGS_I}", "SELECT * FROM tag_run")
def pit_daily_by_run(spark: S, sf: D) -> DataFrame:
    return tags.tag_daily_by_run(landed.detections(spark, sf), landed.seasons(spark, sf))


# ---- trap ---------------------------------------------------------------------------------------------------


@query(
    "dam s, species s, n i, n_tagged i, n_clip_unknown i, n_wire i, n_wire_unknown i, n_large i",
    """SELECT dam, species, count(*) AS n, count(tag_code) AS n_tagged, count(*) - count(ad_clip) AS n_clip_unknown,
       count(*) FILTER (cwt) AS n_wire, count(*) - count(cwt) AS n_wire_unknown,
       count(*) FILTER (length >= 780) AS n_large FROM trap GROUP BY dam, species""",
)
def trap_cohort(spark: S, sf: D) -> DataFrame:
    return landed.trap_cohort(spark, sf).groupBy("dam", "species").agg(
        F.count("*").alias("n"), F.count("tag_code").alias("n_tagged"),
        F.count_if(F.col("ad_clip").isNull()).alias("n_clip_unknown"), F.count_if("cwt").alias("n_wire"),
        F.count_if(F.col("cwt").isNull()).alias("n_wire_unknown"),
        F.count_if(F.col("length") >= 780).alias("n_large"),
    )


def _every_species(spark: S, sf: D, **options) -> DataFrame:
    cohort, out = landed.trap_cohort(spark, sf), None
    for name in COMPILED_SPECIES:
        part = trap.trap_daily(cohort, name, keys=("dam", "species", "date"), **options)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    f"dam s, species s, date s, {TRAP_I}",
    f"SELECT dam, species, date, {oracle.TRAP_SUMS} FROM trap GROUP BY dam, species, date",
)
def trap_daily(spark: S, sf: D) -> DataFrame:
    return _every_species(spark, sf)


UNSURE = {
    "wild_pbt": "srr LIKE '%W'",
    "hnc_pbt": "srr LIKE '%H' AND NOT ad_clip",
    "hatch_pbt": "srr LIKE '%H' AND ad_clip",
    "na_pbt": "NOT (srr LIKE '%H' OR srr LIKE '%W')",
}
STRICT_SQL = (
    "SELECT dam, species, date, trap_fish, wild_morph, hatch_morph, na_morph, n_invalid, "
    + ", ".join(f"CASE WHEN unsure_{c} = 0 THEN {c} END AS {c}" for c in UNSURE)
    + f" FROM (SELECT dam, species, date, {oracle.TRAP_SUMS}, "
    + ", ".join(f"count(*) FILTER (({cond}) IS NULL) AS unsure_{c}" for c, cond in UNSURE.items())
    + " FROM trap GROUP BY dam, species, date)"
)


@query(f"dam s, species s, date s, {TRAP_I}", STRICT_SQL)
def trap_daily_strict_null(spark: S, sf: D) -> DataFrame:
    return _every_species(spark, sf, strict_null=True)


@query(
    f"dam s, date s, {TRAP_I}, tot_b_run_sthd i",
    f"""SELECT dam, date, {oracle.TRAP_SUMS.replace("srr", "coalesce(srr,'')")},
        {oracle.B_RUN.replace("species", "code_species")} AS tot_b_run_sthd
        FROM trap_by_code WHERE code_species = 'Steelhead' AND ad_clip = false GROUP BY dam, date""",
)
def trap_daily_legacy(spark: S, sf: D) -> DataFrame:
    records_by_code = landed.trap_cohort(spark, sf, species_from="code")
    return trap.trap_daily(
        records_by_code, "Steelhead", incl_clipped=False, b_run=True, unknown_srr="no_match", keys=("dam", "date")
    )


@query(
    "dam s, date s, trap_fish i, tot_b_run_sthd i",
    f"""SELECT dam, date, count(*) AS trap_fish, {oracle.B_RUN} AS tot_b_run_sthd FROM trap
        WHERE species = 'Steelhead' GROUP BY dam, date""",
)
def b_run_daily(spark: S, sf: D) -> DataFrame:
    return trap.trap_daily(landed.trap_cohort(spark, sf), "Steelhead", b_run=True, keys=("dam", "date"))


@query(f"run_id s, week_num i, date s, {TRAP_I}, tot_b_run_sthd i", "SELECT * FROM trap_run")
def trap_daily_by_run(spark: S, sf: D) -> DataFrame:
    return trap.trap_daily_by_run(landed.trap_cohort(spark, sf), landed.seasons(spark, sf))


# ---- daily and weekly tables --------------------------------------------------------------------------------


def _daily(spark: S, sf: D, **options) -> DataFrame:
    seasons = landed.seasons(spark, sf)
    return plan.compile_daily(
        window_counts.window_daily(landed.window_counts(spark, sf), seasons),
        tags.tag_daily_by_run(landed.detections(spark, sf), seasons),
        trap.trap_daily_by_run(landed.trap_cohort(spark, sf), seasons),
        **options,
    )


DAY_FIELDS = f"run_id s, week_num_org i, date s, win_cnt d, window_open s, {TAGS_I}, {TRAP_I}, tot_b_run_sthd i"
WEEK_FIELDS = f"run_id s, week_num_org i, start_date s, win_cnt d, {TAGS_I}, {TRAP_I}, tot_b_run_sthd i, window_open s"


@query(DAY_FIELDS, "SELECT * FROM daily")
def daily_compile(spark: S, sf: D) -> DataFrame:
    return _daily(spark, sf)


@query(
    f"run_id s, week_num_org i, date s, win_cnt d, window_open s, {TAGS_I}, {TRAP_I}",
    f"""SELECT x.*, {oracle.each("f.{c}", oracle.TRAP_COLUMNS)} FROM
        (SELECT coalesce(w.run_id, t.run_id) AS run_id, coalesce(w.week_num, t.week_num) AS week_num_org,
          coalesce(w.date, t.date) AS date, win_cnt, window_open,
          {oracle.each("coalesce({c},0) AS {c}", oracle.TAG_COLUMNS)}
         FROM win_daily w FULL JOIN tag_run t ON t.run_id = w.run_id AND t.date = w.date) x
        LEFT JOIN trap_run f ON f.run_id = x.run_id AND f.date = x.date""",
)
def daily_compile_legacy(spark: S, sf: D) -> DataFrame:
    return _daily(spark, sf, keep_unmatched=True)


@query(WEEK_FIELDS, "SELECT * FROM rolled")
def weekly_rollup(spark: S, sf: D) -> DataFrame:
    return rollup.weekly_rollup(_daily(spark, sf))


@query(
    "run_id s, week_num_org i, win_cnt d, window_open s",
    "SELECT run_id, week_num_org, win_cnt, win_cnt > 0 AS window_open FROM rolled",
)
def weekly_rollup_legacy(spark: S, sf: D) -> DataFrame:
    return rollup.weekly_rollup(_daily(spark, sf), open_rule="positive")


@query(
    "species s, spawn_year i, daily_win_cnt d, weekly_win_cnt d, daily_trap_fish i, weekly_trap_fish i, conserved s",
    """SELECT species, spawn_year, sum(win_cnt) AS daily_win_cnt, sum(win_cnt) AS weekly_win_cnt,
       coalesce(sum(trap_fish),0) AS daily_trap_fish, coalesce(sum(trap_fish),0) AS weekly_trap_fish,
       true AS conserved FROM daily JOIN runs USING (run_id) GROUP BY species, spawn_year""",
)
def conservation_check(spark: S, sf: D) -> DataFrame:
    seasons, daily = landed.seasons(spark, sf), _daily(spark, sf)
    who = seasons.frame.select("run_id", "species", "spawn_year")
    weekly = plan.compile_weekly(daily, seasons)
    return rollup.conservation(daily.join(who, "run_id"), weekly, ("species", "spawn_year"), ("win_cnt", "trap_fish"))


@query(
    "daily_win_cnt d, weekly_win_cnt d, daily_trap_fish d, weekly_trap_fish d, conserved s",
    """SELECT sum(win_cnt) AS daily_win_cnt, sum(win_cnt) AS weekly_win_cnt, sum(trap_fish) AS daily_trap_fish,
       sum(trap_fish) AS weekly_trap_fish, true AS conserved FROM daily""",
)
def conservation_observed(spark: S, sf: D) -> DataFrame:
    """Totals of days and weeks noted during one run of the compile, beside those of the weeks it left."""
    audit = rollup.Audit()
    weekly = _landed_table(_compiled(spark, sf, audit=audit).weekly, "audited")
    audit.check()
    days, weeks = audit.totals()["days"], audit.totals()["weeks"]
    left = weekly.agg(F.sum("win_cnt").alias("weekly_win_cnt"), F.sum("trap_fish").alias("weekly_trap_fish"))
    same = (F.col("weekly_win_cnt") == weeks["win_cnt"]) & (F.col("weekly_trap_fish") == weeks["trap_fish"])
    told = {f"daily_{c}": F.lit(days[c]) for c in days}
    return left.select("*", *[v.alias(k) for k, v in told.items()], same.alias("conserved"))


@query(
    "run_id s, week i, week_num i, start_date s",
    """SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY start_date) AS week, week_num, start_date
       FROM weekly0""",
)
def week_positions(spark: S, sf: D) -> DataFrame:
    return rollup.number_rows(plan.compile_weekly(_daily(spark, sf), landed.seasons(spark, sf)))


@query(
    "run_id s, date s, filled d",
    """SELECT run_id, date, coalesce(
         last_value(win_cnt IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(win_cnt IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY date
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM win_daily""",
)
def fill_down_up(spark: S, sf: D) -> DataFrame:
    daily = window_counts.window_daily(landed.window_counts(spark, sf), landed.seasons(spark, sf))
    return rollup.fill_down_up(daily.withColumnRenamed("win_cnt", "filled"), "filled")


@query(
    "dam s, false_pct d, true_pct d, n i",
    """SELECT coalesce(dam, 'Total') AS dam, round(100.0 * sum(f) / (sum(f) + sum(t)), 2) AS false_pct,
         round(100.0 * sum(t) / (sum(f) + sum(t)), 2) AS true_pct, sum(f) + sum(t) AS n
       FROM (SELECT dam, count(*) FILTER (NOT in_trap) AS f, count(*) FILTER (in_trap) AS t FROM
         (SELECT o.dam, o.tag_code, bool_or(t.tag_code IS NOT NULL) AS in_trap FROM (SELECT DISTINCT dam, tag_code
           FROM obs) o LEFT JOIN (SELECT DISTINCT tag_code FROM trap) t ON t.tag_code = o.tag_code
           GROUP BY o.dam, o.tag_code) GROUP BY dam) GROUP BY ROLLUP (dam)""",
)
def trap_crosstab(spark: S, sf: D) -> DataFrame:
    seen = landed.observations(spark, sf).select("dam", "tag_code").distinct()
    caught = landed.trap_cohort(spark, sf).select("tag_code").distinct().withColumn("hit", F.lit(True))
    known = seen.join(caught, "tag_code", "left").withColumn("in_trap", is_true(F.col("hit")))
    return rollup.crosstab_percent(known, "dam", "in_trap", (False, True))


@query(
    "ladder s, in_trap s, row_total s, column_total s, n i, of_row d, of_column d, of_all d",
    """SELECT ladder, in_trap, gl = 1 AS row_total, gt = 1 AS column_total, n,
         n / max(n) FILTER (gt = 1) OVER (PARTITION BY gl, ladder)::DOUBLE AS of_row,
         n / max(n) FILTER (gl = 1) OVER (PARTITION BY gt, in_trap)::DOUBLE AS of_column,
         n / max(n) FILTER (gl = 1 AND gt = 1) OVER ()::DOUBLE AS of_all
       FROM (SELECT ladder, in_trap, grouping(ladder) AS gl, grouping(in_trap) AS gt, count(*) AS n FROM
         (SELECT d.tag_id, CASE WHEN d.tag_id::BIGINT % 7 <> 0 THEN 'ladder ' || (d.tag_id::BIGINT % 3) END AS ladder,
            t.tag_code IS NOT NULL AS in_trap FROM (SELECT DISTINCT dam, tag_id FROM det) d LEFT JOIN
            (SELECT DISTINCT dam, tag_code FROM trap) t ON t.dam = d.dam AND t.tag_code = d.tag_id)
         GROUP BY CUBE (ladder, in_trap))""",
)
def ladder_crosstab(spark: S, sf: D) -> DataFrame:
    """Ladder side by whether the tag was also in the trap; some detections know no side."""
    tag = F.col("tag_id").cast("long")
    side = F.when(tag % 7 != 0, F.concat(F.lit("ladder "), (tag % 3).cast("string")))
    seen = landed.detections(spark, sf).select("dam", "tag_id").distinct().withColumn("ladder", side)
    caught = landed.trap_cohort(spark, sf).select("dam", F.col("tag_code").alias("tag_id")).distinct().withColumn("hit", F.lit(True))
    known = seen.join(caught, ["dam", "tag_id"], "left").withColumn("in_trap", is_true(F.col("hit")))
    return rollup.cube_shares(known, "ladder", "in_trap")


# ---- trap rate ----------------------------------------------------------------------------------------------


def _obs_in(spark: S, sf: D) -> DataFrame:
    return trap_rate.observations_by_run(landed.observations(spark, sf), landed.seasons(spark, sf))


@query(
    "run_id s, tag_code s, sp_rrt s, obs_date s",
    "SELECT run_id, tag_code, sp_rrt, min(obs_date) AS obs_date FROM obs_free GROUP BY run_id, tag_code, sp_rrt",
)
def tag_first_observation(spark: S, sf: D) -> DataFrame:
    return trap_rate.first_observations(_obs_in(spark, sf))


@query(
    "dam s, mark_site s, n_kept i",
    """SELECT dam, mark_site, count(*) AS n_kept FROM obs WHERE NOT coalesce((dam = 'LWG' AND mark_site IN
       ('LGRLDR','LGR')) OR (dam = 'PRD' AND mark_site = 'PRDLD1'), false) GROUP BY dam, mark_site""",
)
def mark_site_exclusion(spark: S, sf: D) -> DataFrame:
    obs = landed.observations(spark, sf)
    kept = obs.filter(~trap_rate.marked_here(F.col("dam"), F.col("mark_site")))
    return kept.groupBy("dam", "mark_site").agg(F.count("*").alias("n_kept"))


@query(
    "run_id s, species_code s, n_obs i",
    "SELECT run_id, code AS species_code, count(*) AS n_obs FROM obs_use GROUP BY run_id, code",
)
def species_semi_join(spark: S, sf: D) -> DataFrame:
    weeks = trap_rate.trap_weeks(landed.trap_cohort(spark, sf), landed.seasons(spark, sf))
    kept = trap_rate.known_species_only(_obs_in(spark, sf), weeks)
    return kept.groupBy("run_id", "species_code").agg(F.sum("n_obs").alias("n_obs"))


RATE_D = "n_trap_tags i, n_poss_tags i, trap_rate r, trap_rate_se r, trap_rate_cv r"


@query(
    f"run_id s, week_num i, start_date s, {RATE_D}, trap_open s, few_tags s, trap_valid s",
    """SELECT t.*, start_date, n_trap_tags > 0 AS trap_open, n_poss_tags < 20 AS few_tags,
       n_poss_tags >= 20 AND n_trap_tags > 0 AS trap_valid FROM tag_rate t JOIN strata USING (run_id, week_num)""",
)
def pit_trap_rate_weekly(spark: S, sf: D) -> DataFrame:
    return trap_rate.rate_from_tags(
        landed.observations(spark, sf), landed.trap_cohort(spark, sf), landed.seasons(spark, sf)
    )


@query(f"run_id s, week_num i, {RATE_D}", "SELECT * FROM tag_rate_dup")
def pit_trap_rate_duplicates(spark: S, sf: D) -> DataFrame:
    return trap_rate.rate_from_tags(
        landed.observations(spark, sf), landed.trap_cohort(spark, sf), landed.seasons(spark, sf), dedupe=False
    )


@query(f"run_id s, week_num i, {RATE_D}", "SELECT * FROM tag_rate_old")
def legacy_trap_rate(spark: S, sf: D) -> DataFrame:
    return trap_rate.legacy_rate_from_tags(
        landed.observations(spark, sf), landed.trap_cohort(spark, sf), landed.seasons(spark, sf)
    )


@query(
    f"dam s, species s, date s, year i, doy i, {SUMS_D}, {MEANS_R}, seconds_in_day i, trap_open s, rate_calc r",
    "SELECT * FROM rep_daily2",
)
def reported_rate_daily(spark: S, sf: D) -> DataFrame:
    return _reported_days(spark, sf)


def _reported_days(spark: S, sf: D, shipments: DataFrame | None = None) -> DataFrame:
    rates = landed.reported_rates(spark, sf) if shipments is None else landed.reported_rates_of(shipments)
    return trap_rate.reported_daily(rates, records.RATE_SUMS, records.RATE_MEANS)


def _reported(spark: S, sf: D) -> DataFrame:
    return trap_rate.reported_weekly(_reported_days(spark, sf), landed.seasons(spark, sf), records.RATE_SUMS, records.RATE_MEANS)


@query(
    f"run_id s, week_num i, start_date s, {SUMS_D}, {MEANS_R}, seconds_in_week i, trap_open s, calc_rate r",
    "SELECT * FROM rep_weekly2",
)
def reported_rate_weekly(spark: S, sf: D) -> DataFrame:
    return _reported(spark, sf)


@query(
    "run_id s, week_num i, trap_open s, trap_rate r, trap_rate_se r",
    """SELECT run_id, week_num, actual_rate_inclusive_time > 0 AS trap_open, actual_rate_inclusive_time AS trap_rate,
       actual_rate_inclusive_time * cv AS trap_rate_se FROM rep_weekly2 JOIN runs USING (run_id)""",
)
def reported_rate_adopted(spark: S, sf: D) -> DataFrame:
    return trap_rate.adopt_reported_rate(_reported(spark, sf), landed.seasons(spark, sf))


@query(
    "run_id s, week_num i, trap_open s, n_poss_tags i",
    """SELECT coalesce(t.run_id, f.run_id) AS run_id, coalesce(t.week_num, f.week_num) AS week_num,
       CASE WHEN n_fish > 0 THEN true ELSE coalesce(n_trap_tags > 0, false) END AS trap_open, n_poss_tags
       FROM tag_rate t FULL JOIN fish_weeks f ON f.run_id = t.run_id AND f.week_num = t.week_num""",
)
def trap_open_override(spark: S, sf: D) -> DataFrame:
    cohort, seasons = landed.trap_cohort(spark, sf), landed.seasons(spark, sf)
    weeks = trap_rate.trap_weeks(cohort, seasons)
    rate = trap_rate.rate_from_tags(landed.observations(spark, sf), cohort, seasons, weeks=weeks)
    return trap_rate.trap_open_override(rate, weeks)


# Strata as a caller might give them: 5 to 27 days long, every 11 days, so that some overlap and some leave a gap.
SUPPLIED_SQL = """(SELECT run_id, k AS week_num, s + 11 * k AS start_date, s + (11 * k + 4 + (k * 7) % 23) AS end_date
    FROM runs, (SELECT unnest(generate_series(0, 36))::INT AS k) WHERE k % 5 <> 3)"""
GIVEN_CAL = f"""(SELECT run_id, dam, species, week_num, start_date, end_date,
    unnest(generate_series(start_date::TIMESTAMP, end_date::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date
    FROM {SUPPLIED_SQL} JOIN runs USING (run_id))"""


def _supplied(spark: S, sf: D) -> DataFrame:
    runs = landed.seasons(spark, sf).frame.select("run_id", "start_date")
    numbered = runs.select("*", F.explode(F.sequence(F.lit(0), F.lit(36))).alias("week_num")).where("week_num % 5 <> 3")
    start = F.date_add("start_date", F.col("week_num") * 11)
    return numbered.select(
        "run_id", "week_num", start.alias("start_date"), F.date_add(start, 4 + F.col("week_num") * 7 % 23).alias("end_date")
    )


@query(
    "run_id s, week_num i, date s, n_fish i, n_tagged i",
    f"""SELECT c.run_id, c.week_num, t.date, count(*) AS n_fish, count(tag_code) AS n_tagged FROM trap t
        JOIN {GIVEN_CAL} c ON t.dam = c.dam AND t.species = c.species AND t.date = c.date GROUP BY ALL""",
)
def supplied_strata_join(spark: S, sf: D) -> DataFrame:
    """Trap records per day in overlapping, uneven strata that come as a table."""
    placed = strata.attach_supplied(landed.trap_cohort(spark, sf), landed.seasons(spark, sf), _supplied(spark, sf))
    return placed.groupBy("run_id", "week_num", "date").agg(
        F.count("*").alias("n_fish"), F.count("tag_code").alias("n_tagged")
    )


@query(
    f"run_id s, week_num i, start_date s, {SUMS_D}, {MEANS_R}, seconds_in_week i, trap_open s, calc_rate r",
    f"""SELECT *, total_time_inclusive / seconds_in_week AS calc_rate FROM (SELECT c.run_id, c.week_num,
        min(r.date) AS start_date, {oracle.each("sum({c}) AS {c}", oracle.SUMS)}, {oracle.each("avg({c}) AS {c}", oracle.MEANS)},
        bool_or(trap_open) AS trap_open, any_value(end_date - c.start_date + 1) * 86400 - 1 AS seconds_in_week
        FROM rep_daily2 r JOIN {GIVEN_CAL} c ON c.dam = r.dam AND c.species = r.species AND c.date = r.date
        GROUP BY c.run_id, c.week_num)""",
)
def reported_rate_supplied(spark: S, sf: D) -> DataFrame:
    return trap_rate.reported_weekly(
        _reported_days(spark, sf), landed.seasons(spark, sf), records.RATE_SUMS, records.RATE_MEANS, supplied=_supplied(spark, sf)
    )


def _supplied_rate_sql(matched: str) -> str:
    return f"""SELECT *, CASE WHEN trap_rate <= 1 THEN sqrt(trap_rate * (1 - trap_rate) / n_poss_tags) END AS trap_rate_se,
        CASE WHEN trap_rate <= 1 THEN sqrt(trap_rate * (1 - trap_rate) / n_poss_tags) END / nullif(trap_rate, 0) AS trap_rate_cv
      FROM (SELECT *, n_trap_tags / n_poss_tags::DOUBLE AS trap_rate FROM (SELECT m.run_id, c.week_num,
        sum(in_trap::INT) AS n_trap_tags, count(DISTINCT tag_code) AS n_poss_tags FROM {matched} m
        JOIN {GIVEN_CAL} c ON c.run_id = m.run_id AND c.date = m.d GROUP BY m.run_id, c.week_num))"""


@query(f"run_id s, week_num i, {RATE_D}", _supplied_rate_sql("matched"))
def pit_trap_rate_supplied(spark: S, sf: D) -> DataFrame:
    return trap_rate.rate_from_tags(
        landed.observations(spark, sf), landed.trap_cohort(spark, sf), landed.seasons(spark, sf), supplied=_supplied(spark, sf)
    )


@query(f"run_id s, week_num i, {RATE_D}", _supplied_rate_sql("matched_old"))
def legacy_trap_rate_supplied(spark: S, sf: D) -> DataFrame:
    return trap_rate.legacy_rate_from_tags(
        landed.observations(spark, sf), landed.trap_cohort(spark, sf), landed.seasons(spark, sf), supplied=_supplied(spark, sf)
    )


# ---- weekly table with rates --------------------------------------------------------------------------------


def _compiled(spark: S, sf: D, **options) -> plan.Compiled:
    ships = landed.stored_shipments(spark, sf)
    return plan.compile_seasons(
        spark,
        landed.seasons(spark, sf),
        landed.window_counts(spark, sf),
        landed.detections_of(ships),
        landed.trap_records_of(ships),
        landed.observations(spark, sf),
        _reported_days(spark, sf, ships),
        **options,
    )


def _joined_rates(spark: S, sf: D) -> DataFrame:
    ships = landed.stored_shipments(spark, sf)
    rated = union.weekly_table(
        landed.seasons(spark, sf),
        landed.window_counts(spark, sf),
        landed.detections_of(ships),
        trap.adult_cohort(landed.trap_records_of(ships)),
        landed.observations(spark, sf),
        _reported_days(spark, sf, ships),
    )
    return expansion.expand_trap(rated)


@query(
    "run_id s, week_num i, trap_fish i, trap_open s, trap_rate r, trap_est d, trap_est_se d",
    "SELECT * FROM expanded",
)
def trap_expansion(spark: S, sf: D) -> DataFrame:
    return _joined_rates(spark, sf)


@query("run_id s, week_num i, win_cnt d, lower_trap_lim i, upper_trap_lim i", "SELECT * FROM limited")
def binomial_limits(spark: S, sf: D) -> DataFrame:
    return expansion.plausible_limits(_joined_rates(spark, sf))


@query("run_id s, week_num i, trap_open s, trap_valid s", "SELECT * FROM judged")
def trap_validity(spark: S, sf: D) -> DataFrame:
    return expansion.judge_trap(expansion.plausible_limits(_joined_rates(spark, sf)))


@query(
    "run_id s, week_num i, trap_alpha d, trap_beta d",
    """SELECT run_id, week_num,
       CASE WHEN trap_valid THEN CASE WHEN a0 < 0 THEN 0.01 ELSE a0 END ELSE 1e-12 END AS trap_alpha,
       CASE WHEN trap_valid THEN CASE WHEN a0 < 0 THEN 0.01 ELSE a0 END * (1 / nullif(trap_rate,0) - 1) ELSE 1 END
         AS trap_beta FROM (SELECT *, ((1 - trap_rate) / nullif(trap_rate_se^2, 0) - 1 / nullif(trap_rate,0))
         * trap_rate^2 AS a0 FROM judged)""",
)
def beta_prior(spark: S, sf: D) -> DataFrame:
    judged = expansion.judge_trap(expansion.plausible_limits(_joined_rates(spark, sf)))
    return expansion.beta_prior(judged)


@query(
    "run_id s, week_num i, trap_mu d, trap_sd d",
    """SELECT run_id, week_num, CASE WHEN NOT trap_valid THEN -25 WHEN trap_rate > 0 AND trap_rate < 1
         THEN ln(trap_rate / (1 - trap_rate)) END AS trap_mu,
       CASE WHEN trap_valid THEN 1.0 / nullif(n_trap_tags,0) + 1.0 / nullif(n_poss_tags - n_trap_tags, 0)
         ELSE 0 END AS trap_sd FROM judged""",
)
def logit_prior(spark: S, sf: D) -> DataFrame:
    judged = expansion.judge_trap(expansion.plausible_limits(_joined_rates(spark, sf)))
    return expansion.logit_prior(judged)


@query(
    f"""dam s, species s, spawn_year i, week_num i, {WEEK_FIELDS}, trap_open s, n_trap_tags i, n_poss_tags i,
    trap_rate r, trap_rate_se r, trap_est d, trap_est_se d, lower_trap_lim i, upper_trap_lim i, trap_valid s,
    trap_alpha d, trap_beta d, trap_mu d, trap_sd d""",
    "SELECT * FROM weekly",
)
def weekly_compile(spark: S, sf: D) -> DataFrame:
    return _compiled(spark, sf).weekly


MODEL_FIELDS = """run_id s, week_num i, ladder i, y_window d, y_trap i, wild_fish i, hnc_fish i, hatch_fish i,
    n_trap_tags i, n_poss_tags i, tot_tags i, reasc_tags i, dc_tags i, trap_fish i, wild_exist i, hnc_exist i,
    hatch_exist i, tot_ladder_weeks i"""


@query(
    MODEL_FIELDS + ", b_trap i, trap_fish_matrix s",
    "SELECT *, concat_ws(',', wild_fish, hnc_fish, hatch_fish) AS trap_fish_matrix FROM mi",
)
def model_input(spark: S, sf: D) -> DataFrame:
    rows = model.model_input(_compiled(spark, sf).weekly, b_run=True)
    return rows.withColumn("trap_fish_matrix", F.array_join(F.transform("trap_fish_matrix", lambda x: x.cast("string")), ","))


@query(
    "run_id s, week_num i, wild_fish i, hnc_fish i, hatch_fish i, tot_tags i, reasc_tags i, dc_tags i",
    """SELECT run_id, week_num, wild_morph AS wild_fish, 0 AS hnc_fish, hatch_morph AS hatch_fish,
       tot_tags_w AS tot_tags, CASE WHEN trap_open THEN least(reascent_tags_w, tot_tags_w) END AS reasc_tags,
       CASE WHEN trap_open THEN least(day_tags_w, tot_tags_w) END AS dc_tags FROM mi""",
)
def model_input_wild(spark: S, sf: D) -> DataFrame:
    return model.model_input(_compiled(spark, sf).weekly, origins_by="Morph", wild_tags=True)


@query(
    "run_id s, week_num i, y_window d, y_window_log d",
    "SELECT run_id, week_num, y_window, CASE WHEN y_window > 0 THEN ln(y_window) END AS y_window_log FROM mi",
)
def log_window(spark: S, sf: D) -> DataFrame:
    return model.log_window(model.model_input(_compiled(spark, sf).weekly))


@query(
    "run_id s, wild_exist i, hnc_exist i, hatch_exist i",
    """SELECT run_id, (sum(wild_pbt) > 0)::INT AS wild_exist, (sum(hnc_pbt) > 0)::INT AS hnc_exist,
       (sum(hatch_pbt) > 0)::INT AS hatch_exist FROM weekly0 GROUP BY run_id""",
)
def origin_exists(spark: S, sf: D) -> DataFrame:
    return model.origin_exists(plan.compile_weekly(_daily(spark, sf), landed.seasons(spark, sf)))


# ---- draws --------------------------------------------------------------------------------------------------


@query(
    "run_id s, chain i, iter i, param s, strata_num i, tot_abund d",
    """SELECT run_id, chain, dense_rank() OVER (PARTITION BY run_id, chain ORDER BY iter) AS iter,
       split_part(param, '[', 1) AS param, regexp_extract(param, '[0-9]+')::INT AS strata_num, value AS tot_abund
       FROM draws WHERE lower(param) LIKE '%log.all%' OR lower(param) LIKE '%org%'""",
)
def draws_long(spark: S, sf: D) -> DataFrame:
    return draw_ops.extract_draws(landed.draws(spark, sf), ["x.LOG.all", "org"])


STATE_WEEKS = [
    pattern.format(week)
    for week in range(1, 17)
    for pattern in ("X.log.all[{}]", "day.true.logit[{}]", "reasc.true.logit[{}]", "org.phi[{}, 1]", "org.phi[{}, 2]")
]


@query("run_id s, chain i, iter i, param s, value d", "SELECT * FROM draws")
def draws_unpivot(spark: S, sf: D) -> DataFrame:
    cells = [F.max(F.when(F.col("param") == n, F.col("value"))).alias(n) for n in STATE_WEEKS]
    return draw_ops.draws_long(landed.draws(spark, sf).groupBy(*draw_ops.DRAW_KEYS).agg(*cells))


@query(
    "run_id s, chain i, iter i, week_num i, x_log_all d, day_true_logit d, reasc_true_logit d, "
    "org_phi_wild d, org_phi_hnc d",
    "SELECT * FROM state",
)
def draw_states(spark: S, sf: D) -> DataFrame:
    return draw_ops.states_from_draws(landed.draws(spark, sf))


@query("param s", "SELECT DISTINCT split_part(param, '[', 1) AS param FROM draws WHERE param NOT LIKE 'day%'")
def present_parameters(spark: S, sf: D) -> DataFrame:
    asked = ["X.log.all", "reasc.true.logit", "org.phi", "r", "k", "win.sigma"]
    return draw_ops.present_parameters(landed.draws(spark, sf), asked)


def _weekly(spark: S, sf: D) -> DataFrame:
    return _compiled(spark, sf).weekly


def _landed_table(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, as draws of a model and the weeks it was fitted to would be."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _landed_weekly(spark: S, sf: D) -> DataFrame:
    return _landed_table(_weekly(spark, sf), "weekly")


def _passage(spark: S, sf: D, weekly: DataFrame | None = None) -> DataFrame:
    observed = model.model_input(weekly if weekly is not None else _weekly(spark, sf))
    flags = observed.select("run_id", "week_num", "ladder", "wild_exist", "hnc_exist", "hatch_exist")
    states = draw_ops.states_from_draws(landed.draws(spark, sf)).join(flags, ["run_id", "week_num"], "left")
    known = states.fillna(1, ["ladder", "wild_exist", "hnc_exist", "hatch_exist"])
    return draw_ops.passage_draws(known)


PASSAGE = [c for c in draw_ops.WEEKLY_PARAMETERS.values() if c.startswith("x_")]


@query(
    f"run_id s, chain i, iter i, week_num i, {kinds(PASSAGE, 'd')}, prop_wild d, prop_hnc d, prop_hatch d, "
    "day_true d, reasc_true d",
    "SELECT * FROM pass",
)
def draw_algebra(spark: S, sf: D) -> DataFrame:
    return _passage(spark, sf)


@query(
    f"run_id s, chain i, iter i, {kinds(draw_ops.SEASON_TOTALS, 'd')}, x_tot_new_hatch_all d, prop_tagged d",
    "SELECT * FROM totals",
)
def season_totals(spark: S, sf: D) -> DataFrame:
    weekly = _landed_weekly(spark, sf)
    return _totals(weekly, _passage(spark, sf, weekly))


def _totals(weekly: DataFrame, passage: DataFrame) -> DataFrame:
    return draw_ops.season_totals(passage, weekly.groupBy("run_id").agg(F.sum("wild_pbt").alias("wild_fish")))


def _summary(spark: S, sf: D, weekly: DataFrame | None = None, wanted: Column | None = None) -> DataFrame:
    """Summary of every monitored quantity and season total, or of the ``wanted`` ones, from landed draws."""
    weekly = weekly if weekly is not None else _landed_weekly(spark, sf)
    passage = _landed_table(_passage(spark, sf, weekly), "passage")
    draws = draw_ops.passage_long(passage).unionByName(draw_ops.totals_long(_totals(weekly, passage)))
    return posterior.posterior_summary(draws if wanted is None else draws.filter(wanted))


def _of_summary(spark: S, sf: D, report: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """A report of the summary beside the weeks."""
    weekly = _landed_weekly(spark, sf)
    return report(_summary(spark, sf, weekly), weekly)


@query(
    f"run_id s, param s, name s, week_num i, idx2 i, mean d, sd d, naive_se d, n_draws i, {QUANT_D}",
    "SELECT * FROM summ",
)
def posterior_summary(spark: S, sf: D) -> DataFrame:
    return _summary(spark, sf)


@query(
    "run_id s, chain i, iter i, week_num i, origin_num i, origin s, value d",
    """SELECT run_id, chain, iter, week_num, 1 AS origin_num, 'NOR' AS origin, prop_wild AS value FROM pass
       UNION ALL SELECT run_id, chain, iter, week_num, 2, 'HNC', prop_hnc FROM pass
       UNION ALL SELECT run_id, chain, iter, week_num, 3, 'HOR', prop_hatch FROM pass""",
)
def origin_proportions(spark: S, sf: D) -> DataFrame:
    return draw_ops.origin_proportions(draw_ops.passage_long(_passage(spark, sf), ["X.all", "org.prop"]))


@query(
    "run_id s, model_week i, start_date s, strata i, estimate d, se d, collapse s",
    """SELECT m.run_id, m.week_num AS model_week, w.start_date, (dayofyear(w.start_date) - 1) // 7 + 1 AS strata,
       round_even(mean, 0) AS estimate, sd AS se, NULL::VARCHAR AS collapse FROM summ m LEFT JOIN weekly w
       ON w.run_id = m.run_id AND w.week_num = m.week_num WHERE name = 'X.new.tot'""",
)
def strata_export(spark: S, sf: D) -> DataFrame:
    return _of_summary(spark, sf, posterior.strata_export)


@query(
    f"run_id s, week_num i, start_date s, {QUANT_D}, win_cnt d, win_cnt_adj d, trap_est d, trap_est_valid d, "
    "trap_valid s",
    f"""SELECT m.run_id, m.week_num, w.start_date, {", ".join(posterior.QUANTILES)}, win_cnt,
       win_cnt / nullif(day_tags / nullif(tot_tags, 0)::DOUBLE, 0) AS win_cnt_adj, trap_est,
       CASE WHEN trap_valid THEN trap_est END AS trap_est_valid, trap_valid FROM summ m LEFT JOIN weekly w
       ON w.run_id = m.run_id AND w.week_num = m.week_num WHERE name = 'X.all'""",
)
def timeseries_frame(spark: S, sf: D) -> DataFrame:
    return _of_summary(spark, sf, posterior.timeseries_frame)


@query(
    f"run_id s, rate s, week_num i, start_date s, {QUANT_D}, tot_tags i, observed d",
    f"""SELECT m.run_id, replace(name, '.true', '') AS rate, m.week_num, w.start_date,
       {", ".join(posterior.QUANTILES)}, tot_tags, CASE WHEN name = 'day.true' THEN day_tags ELSE reascent_tags END
       / nullif(tot_tags, 0)::DOUBLE AS observed FROM summ m LEFT JOIN weekly w
       ON w.run_id = m.run_id AND w.week_num = m.week_num WHERE name IN ('day.true', 'reasc.true')""",
)
def rate_frame(spark: S, sf: D) -> DataFrame:
    return _of_summary(spark, sf, posterior.rate_frame)


def _pivot_sql(cell: str) -> str:
    cells = ", ".join(f"max(CASE WHEN name = '{n}' THEN {cell} END) AS {c}" for n, c in posterior.REPORT_LABELS.items())
    return f"""SELECT t.run_id, t.week, win_cnt, {", ".join(posterior.REPORT_LABELS.values())} FROM
      (SELECT run_id, week_num AS week, {cells} FROM summ WHERE name IN ({", ".join(f"'{n}'" for n in
      posterior.REPORT_LABELS)}) GROUP BY run_id, week_num) t LEFT JOIN weekly w ON w.run_id = t.run_id
      AND w.week_num = t.week"""


LABELS = list(posterior.REPORT_LABELS.values())


@query(f"run_id s, week i, win_cnt d, {kinds(LABELS, 'd')}", _pivot_sql("round_even(mean, 0)"))
def weekly_points(spark: S, sf: D) -> DataFrame:
    return _of_summary(spark, sf, posterior.weekly_points)


CELL = r"""format('{:,}', round_even(mean, 0)::BIGINT) || ' (' ||
    regexp_replace(format('{:,.1f}', round_even(sd, 1)::DOUBLE), '\.0$', '') || ')'"""


@query(f"run_id s, week i, win_cnt d, {kinds(LABELS, 's')}", _pivot_sql(CELL))
def weekly_report(spark: S, sf: D) -> DataFrame:
    return _of_summary(spark, sf, posterior.weekly_report)


@query("run_id s, param s, mean d, sd d", "SELECT run_id, param, mean, sd FROM summ WHERE param LIKE 'X.tot%' OR param = 'prop.tagged'")
def season_report(spark: S, sf: D) -> DataFrame:
    return posterior.season_report(_summary(spark, sf, wanted=posterior.of_season(F.col("param"))))


# ---- readers and sink ---------------------------------------------------------------------------------------


def _land(df: DataFrame, name: str, *by: str) -> str:
    """Landed text files in the shared folder, a folder per value of ``by``."""
    path = scratch_path(df.sparkSession, f"landed-{name}")
    df.write.option("header", True).partitionBy(*by).csv(path)
    return path


@query("dam s, year i, date s, species s, win_cnt d", "SELECT * FROM win")
def window_scan(spark: S, sf: D) -> DataFrame:
    raw = landed.window_raw(spark, sf).withColumn("site", F.col("location"))
    path = _land(raw, "window", "site")
    rows, _ = records.read_window_counts(spark, {dam: f"{path}/site={dam}" for dam in (*landed.DAM_OF_REGION.values(), "ZOS")})
    return rows


@query(
    "dam s, species s, year i, date s, tag_id s, rear_type s, period s, ascent_count i",
    "SELECT * FROM det",
)
def pit_scan(spark: S, sf: D) -> DataFrame:
    return records.read_detections(spark, _land(landed.detections_raw(spark, sf), "detections"))


@query(
    "dam s, tag_code s, sp_rrt s, mark_site s, obs_time s",
    "SELECT dam, tag_code, sp_rrt, mark_site, obs_time FROM obs",
)
def obs_scan(spark: S, sf: D) -> DataFrame:
    raw = landed.observations_raw(spark, sf)
    text = raw.withColumn("obs_time", F.date_format("obs_time", "yyyy-MM-dd HH:mm:ss"))
    return records.read_observations(spark, _land(text, "observations"))


@query(
    "date s, tag_code s, species s, srr s, origin s, ad_clip s, valid i, length d, cwt s",
    "SELECT *  REPLACE (code_species AS species) FROM trap_by_code",
)
def trap_scan(spark: S, sf: D) -> DataFrame:
    raw, upper = landed.trap_raw(spark, sf), landed.trap_raw_upper(spark, sf)
    text = raw.withColumn("collection_date", F.date_format("collection_date", "M/d/yyyy H:mm:ss")).drop("dam")
    other = upper.withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd HH:mm:ss")).drop("dam")
    read = records.read_trap(spark, _land(text, "trap"))
    return read.unionByName(records.read_trap(spark, _land(other, "trap"), dam="PRD"), allowMissingColumns=True)


@query(f"dam s, species s, date s, year i, doy i, {SUMS_D}, {MEANS_R}", "SELECT * FROM rep")
def trap_rate_scan(spark: S, sf: D) -> DataFrame:
    text = landed.rates_raw(spark, sf).withColumn("date", F.date_format("date", "M/d/yyyy"))
    return records.parse_reported_rates(records.read_text_table(spark, _land(text, "rates")))


WEEK_COUNTS = kinds([c for c in oracle.COUNTS if c != "win_cnt"], "i")


@query(
    f"run_id s, week_num i, week_num_org i, start_date s, win_cnt d, {WEEK_COUNTS}, window_open s, dam s, species s, "
    "spawn_year i, trap_rate_dist s",
    "SELECT *, dist AS trap_rate_dist FROM weekly0",
)
def csv_sink(spark: S, sf: D) -> DataFrame:
    weekly = plan.compile_weekly(_daily(spark, sf), landed.seasons(spark, sf)).orderBy("run_id", "week_num")
    return spark.read.option("header", True).schema(weekly.schema).csv(_land(weekly, "weekly"))


@query(
    "run_id s, week_num i, start_date s, position i",
    "SELECT run_id, week_num, start_date, row_number() OVER (ORDER BY start_date, run_id) AS position FROM weekly0",
)
def ordered_sink(spark: S, sf: D) -> DataFrame:
    """Weeks of all runs written in one order over several files, with the position each has there."""
    weekly = plan.compile_weekly(_daily(spark, sf), landed.seasons(spark, sf)).select("run_id", "week_num", "start_date")
    path = scratch_path(spark, "ordered")
    files.write_ordered(weekly, path, ["start_date", "run_id"], 7)
    return files.read_ordered(spark, path)


REPORT_SQL = """WITH given AS (SELECT 'at-' || dam AS source, dam = 'RRH' AND day(date) = 7 AS bad FROM win
      UNION ALL SELECT 'broken', true FROM win WHERE dam = 'LWG')
    SELECT e.source, CASE WHEN count(g.source) = 0 THEN 'missing' WHEN bool_and(bad) THEN 'broken'
        WHEN bool_or(bad) THEN 'partly' ELSE 'read' END AS status, count(*) FILTER (NOT bad) AS rows_read,
      count(*) FILTER (bad) AS rows_rejected
    FROM (SELECT 'at-' || dam AS source FROM dams UNION ALL VALUES ('broken'), ('at-ZOS')) e
    LEFT JOIN given g ON g.source = e.source GROUP BY e.source"""


@query("source s, status s, rows_read i, rows_rejected i", f"SELECT * FROM ({REPORT_SQL})")
def source_report(spark: S, sf: D) -> DataFrame:
    """What one scan of all landed window files tells of every expected source: one is missing, one is broken."""
    raw = landed.window_raw(spark, sf)
    day = F.split("mm_dd", "-")[1].cast("int")
    unread = (F.col("location") == "RRH") & (day == 7)
    value = F.when(unread, F.lit("closed")).otherwise(F.col("value").cast("string"))
    good = raw.withColumn("site", F.concat(F.lit("at-"), "location")).withColumn("value", value)
    broken = raw.where("location = 'LWG'").withColumn("site", F.lit("broken")).withColumn("value", F.lit("no number"))
    path = _land(good.unionByName(broken), "reported", "site")
    scanned = files.scan_folder(spark, path, "location string, year int, mm_dd string, parameter string, value double")
    expected = [("at-" + dam,) for dam in (*landed.DAM_OF_REGION.values(), "ZOS")] + [("broken",)]
    site = F.regexp_extract("file", "/site=([^/]+)/", 1)
    return files.source_report(scanned, site, spark.createDataFrame(expected, "source string"))


@query(f"dam s, species s, date s, year i, doy i, {SUMS_D}, {MEANS_R}", "SELECT * FROM rep")
def reported_rate_files(spark: S, sf: D) -> DataFrame:
    """A file per year and species; years without one are left out."""
    text = landed.rates_raw(spark, sf).withColumn("of", F.concat_ws("-", "year", "species"))
    folder = _land(text.withColumn("date", F.date_format("date", "M/d/yyyy")), "rates", "of")
    seasons = landed.seasons(spark, sf)
    years = range(seasons.first_day.year - 1, seasons.last_day.year + 1)
    wanted = {f"{y}-{name}": f"{folder}/of={y}-{name}" for y in years for name in COMPILED_SPECIES}
    rows, _ = files.read_each(spark, wanted, records.parse_reported_rates)
    return rows


@query(
    "dam s, species s, year i, date s, tag_id s, rear_type s, period s, ascent_count i, previous_date s, previous_days d, ladder s",
    """SELECT det.*, date - ascent_count AS previous_date, ascent_count / 2.0 AS previous_days,
       'ladder ' || (tag_id::BIGINT % 3) AS ladder FROM det""",
)
def pit_scan_upper(spark: S, sf: D) -> DataFrame:
    """Detections in the upper-river layout, with the provider's own headers."""
    raw = landed.detections_raw(spark, sf)
    count, tag = F.col("tag_id_ascent_count"), F.col("tag_id").cast("long")
    text = raw.select(
        F.col("dam"), F.col("species").alias("Species"), F.col("clock_date").alias("Clock Date"),
        F.date_format("detection_date_time", "yyyy-MM-dd HH:mm:ss").alias("Detection Date Time"),
        F.col("tag_id").alias("Tag ID"), F.col("rear_type").alias("Rear Type"), F.col("period").alias("Period"),
        count.alias("TagID Ascent Count"), F.date_sub("clock_date", count).alias("Previous Detect Date"),
        (count / 2).alias("Diff Previous Days"), F.concat(F.lit("ladder "), (tag % 3).cast("string")).alias("Ladder2"),
    )
    return records.read_detections(spark, _land(text, "upper"))


@query("run_id s, window_days i, tot_tags i, trap_fish i", """SELECT run_id, count(*) AS window_days, 0 AS tot_tags,
    0 AS trap_fish FROM win_daily GROUP BY run_id""")
def compile_without_sources(spark: S, sf: D) -> DataFrame:
    """Window counts alone: no detections, trap records or observations."""
    done = plan.compile_seasons(spark, landed.seasons(spark, sf), landed.window_counts(spark, sf))
    days = done.daily.groupBy("run_id").agg(F.count("*").alias("window_days"))
    weeks = done.weekly.groupBy("run_id").agg(F.sum("tot_tags").alias("tot_tags"), F.sum("trap_fish").alias("trap_fish"))
    return days.join(weeks, "run_id")


@query(
    "run_id s, first_day s, last_day s, win_cnt d",
    """SELECT u.dam || '-' || sp || '-' || y AS run_id, a AS first_day, b AS last_day, sum(win_cnt) AS win_cnt FROM
       (SELECT y, d.dam, d.sp, make_date(y - (d.fm > d.lm)::INT, d.fm, d.fd) AS a, make_date(y, d.lm, d.ld) AS b FROM
         (SELECT unnest(generate_series(y0 + 1, y1)) AS y FROM yr), (VALUES ('LWG','Steelhead',7,1,6,30),
          ('PRD','Steelhead',6,1,5,31), ('LWG','Chinook',3,1,8,17), ('PRD','Chinook',3,1,6,15)) d(dam, sp, fm, fd, lm, ld)) u
       JOIN win w ON w.dam = u.dam AND w.date BETWEEN a AND b AND w.species = u.sp GROUP BY ALL""",
)
def customary_seasons(spark: S, sf: D) -> DataFrame:
    """Window counts of the customary season of every species and dam that has one."""
    every = landed.seasons(spark, sf)
    first, last = landed._years(spark, sf)
    runs = [
        Run.usual(dam, species, year, incl_jacks=False)
        for species, dam in RUN_WINDOWS
        for year in range(first + 1, last + 1)
        if dam in {r.dam for r in every.runs}
    ]
    seasons = Seasons(spark, runs)
    daily = window_counts.window_daily(landed.window_counts(spark, sf), seasons)
    total = daily.groupBy("run_id").agg(F.sum("win_cnt").alias("win_cnt"))
    days = seasons.frame.select("run_id", F.col("start_date").alias("first_day"), F.col("end_date").alias("last_day"))
    return days.join(total, "run_id")
