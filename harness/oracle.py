"""The same stand-ins and rules in DuckDB SQL, written apart from the Spark code, to compare against."""

from __future__ import annotations

RUNS = """
yr AS (SELECT min(y) AS y0, max(y) AS y1 FROM (
  SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(l_shipdate) FROM lineitem)),
dams AS (SELECT * FROM (VALUES ('AFRICA','LWG'),('AMERICA','PRD'),('ASIA','RIS'),('EUROPE','RRH'),
  ('MIDDLE EAST','BON')) t(r_name, dam)),
ys AS (SELECT unnest(generate_series(y0, y1 + 1)) AS y, y1 FROM yr),
runs AS (
  SELECT dam || '-Chinook-' || y AS run_id, dam, 'Chinook' AS species, y AS spawn_year,
    make_date(y,1,1) AS s, make_date(y,12,31) AS e, true AS jacks, false AS unclipped, false AS b_run, 1 AS dow,
    'pit' AS source, 0.0::DOUBLE AS cv, 'beta' AS dist
  FROM ys, dams WHERE y <= y1
  UNION ALL
  SELECT dam || '-Coho-' || y, dam, 'Coho', y, make_date(y,1,1), make_date(y,12,31), true, false, false,
    dayofweek(make_date(y,1,1)), 'reported', 0.1::DOUBLE, 'beta' FROM ys, dams WHERE y <= y1
  UNION ALL
  SELECT dam || '-Steelhead-' || y, dam, 'Steelhead', y, make_date(y-1,7,1), make_date(y,6,30), false, true, true,
    0, 'pit', 0.0::DOUBLE, 'logit' FROM ys, dams),
days AS (SELECT run_id, s, e, dow, unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date
  FROM runs),
starts AS (SELECT run_id, s, e, date AS st FROM days WHERE date = s OR (dayofweek(date) = dow AND date < e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY st) AS k,
    count(*) OVER (PARTITION BY run_id) AS n FROM starts),
notail AS (SELECT * FROM ranked WHERE NOT (n > 1 AND k = n AND e - st + 1 <= 3)),
led AS (SELECT *, count(*) OVER (PARTITION BY run_id) AS m,
    lag(st) OVER (PARTITION BY run_id ORDER BY st) AS prev FROM notail),
nohead AS (SELECT * FROM led WHERE NOT (m > 1 AND k = 2 AND st - prev <= 3)),
strata AS (SELECT run_id, row_number() OVER w AS week_num, st AS start_date,
    coalesce(lead(st) OVER w - 1, e) AS end_date,
    coalesce(lead(st) OVER w - 1, e) - st + 1 AS n_days
  FROM nohead WINDOW w AS (PARTITION BY run_id ORDER BY st)),
cal AS (SELECT d.run_id, r.dam, r.species, d.date, x.week_num, r.jacks, r.unclipped, r.b_run
  FROM days d JOIN runs r USING (run_id) JOIN strata x ON x.run_id = d.run_id
   AND d.date BETWEEN x.start_date AND x.end_date)
"""

RECORDS = """
place AS (SELECT n_nationkey, dam FROM nation JOIN region ON n_regionkey = r_regionkey JOIN dams USING (r_name)),
oat AS (SELECT o.*, c_mktsegment, dam, o_orderdate::DATE AS day FROM orders o JOIN customer ON o_custkey = c_custkey
  JOIN place ON c_nationkey = n_nationkey),
win AS (SELECT dam, year(day) AS year, day AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Chinook' WHEN '2-HIGH' THEN 'Jack_Chinook' WHEN '3-MEDIUM'
     THEN 'Steelhead' WHEN '4-NOT SPECIFIED' THEN 'Wild_Steelhead' WHEN '5-LOW' THEN 'Coho' END AS species,
    CASE WHEN day(day) <> 13 THEN sum(floor(o_totalprice / 2000)) END AS win_cnt
  FROM oat GROUP BY dam, day, o_orderpriority),
obs AS (SELECT dam, o_orderkey::VARCHAR AS tag_code,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN '11W'
         WHEN c_mktsegment IN ('FURNITURE','HOUSEHOLD') THEN '31W' WHEN c_mktsegment = 'MACHINERY' THEN '25W' END
      AS sp_rrt,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'LGRLDR' WHEN '2-HIGH' THEN 'PRDLD1' WHEN '5-LOW' THEN NULL
      ELSE o_orderpriority END AS mark_site, o_orderdate AS obs_time, day AS obs_date FROM oat),
ship AS (SELECT l.*, p_size, dam, l_shipdate::DATE AS day,
    CASE WHEN p_type IN ('ECONOMY','PROMO') THEN '1' WHEN p_type IN ('LARGE','SMALL') THEN '3'
         WHEN p_type IN ('MEDIUM','STANDARD') THEN '2' END AS digit,
    CASE l_returnflag WHEN 'A' THEN 'W' WHEN 'N' THEN 'H' WHEN 'R' THEN 'U' END AS rear
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN place ON s_nationkey = n_nationkey),
trap0 AS (SELECT dam, day AS date, l_orderkey, l_linenumber,
    CASE WHEN length(l_orderkey::VARCHAR) >= 3 THEN l_orderkey::VARCHAR END AS tag_code,
    CASE WHEN l_quantity <> 25 THEN digit || '1' || rear END AS srr,
    CASE digit WHEN '1' THEN 'Chinook' WHEN '2' THEN 'Coho' WHEN '3' THEN 'Steelhead' END AS code_species,
    rear AS origin, CASE WHEN l_tax = 0.08 AND dam <> 'PRD' THEN 'RJ' ELSE 'RF' END AS life_stage,
    CASE WHEN l_quantity = 50 THEN NULL WHEN l_linestatus = 'F' THEN true WHEN l_linestatus = 'O' THEN false END
      AS ad_clip,
    CASE WHEN l_tax = 0 AND dam <> 'PRD' THEN 0 ELSE 1 END AS valid, p_size * 20 AS length,
    CASE WHEN dam = 'PRD' THEN NULL WHEN l_discount = 0.1 THEN 'Yes' WHEN l_discount > 0 THEN 'No' END AS sort_by_code,
    CASE WHEN dam = 'PRD' THEN NULL WHEN l_linenumber = 1 THEN true WHEN l_linenumber > 2 THEN false END AS cwt FROM ship),
trap_all AS (SELECT *, CASE CASE WHEN dam = 'PRD' THEN CASE code_species WHEN 'Chinook' THEN '1' WHEN 'Coho' THEN '2' ELSE '3' END ELSE left(srr,1) END WHEN '1' THEN 'Chinook' WHEN '2' THEN 'Coho' WHEN '3' THEN 'Steelhead' END
    AS species FROM trap0),
trap AS (SELECT * FROM trap_all WHERE species IS NOT NULL AND life_stage = 'RF'
    AND coalesce(sort_by_code,'No') <> 'Yes'),
trap_by_code AS (SELECT * FROM trap_all WHERE life_stage = 'RF' AND coalesce(sort_by_code,'No') <> 'Yes'),
det AS (SELECT dam, CASE digit WHEN '1' THEN 'Chinook' WHEN '2' THEN 'Coho' WHEN '3' THEN 'Steelhead' END AS species,
    year(day) AS year, day AS date, l_partkey::VARCHAR AS tag_id, nullif(rear,'U') AS rear_type,
    CASE WHEN l_quantity = 50 THEN 'X' WHEN l_linestatus = 'F' THEN 'D' WHEN l_linestatus = 'O' THEN 'N' END AS period,
    l_linenumber AS ascent_count FROM ship),
evt AS (SELECT CASE WHEN event_type IN ('view','click') THEN 'Chinook' WHEN event_type IN ('error','signup')
      THEN 'Steelhead' WHEN event_type = 'purchase' THEN 'Coho' END AS species, year(ts) AS year, ts::DATE AS date,
    user_id::VARCHAR AS tag_id, CASE WHEN hour(ts) BETWEEN 4 AND 19 THEN 'D' ELSE 'N' END AS period,
    CASE WHEN value < 10 THEN 'W' WHEN value < 20 THEN 'H' END AS rear_type,
    floor(value / 10)::INT AS ascent_count FROM events),
rep AS (SELECT dam, CASE digit WHEN '1' THEN 'Chinook' WHEN '2' THEN 'Coho' WHEN '3' THEN 'Steelhead' END AS species,
    day AS date, year(day) AS year, dayofyear(day) AS doy, l_quantity AS samp_time,
    l_linenumber::DOUBLE AS n_samples, (l_discount > 0.05)::INT::DOUBLE AS n_sby_c,
    (l_tax > 0.05)::INT::DOUBLE AS n_close, (l_linenumber + 1)::DOUBLE AS tot_fish_trap,
    CASE WHEN l_tax = 0 THEN 0.0 ELSE l_quantity END::DOUBLE AS total_time, l_quantity * 600 AS total_time_inclusive,
    l_linenumber::DOUBLE AS all_pit, CASE WHEN l_tax <> 0.01 THEN l_discount END AS rate,
    l_discount + l_tax AS actual_rate_inclusive_time FROM ship)
"""

TAG_SUMS = """
  count(DISTINCT tag_id) AS tot_tags,
  count(DISTINCT CASE WHEN period = 'D' THEN tag_id END) AS day_tags,
  count(DISTINCT CASE WHEN ascent_count > 1 THEN tag_id END) AS reascent_tags,
  count(DISTINCT CASE WHEN rear_type = 'W' THEN tag_id END) AS tot_tags_w,
  count(DISTINCT CASE WHEN period = 'D' AND rear_type = 'W' THEN tag_id END) AS day_tags_w,
  count(DISTINCT CASE WHEN ascent_count > 1 AND rear_type = 'W' THEN tag_id END) AS reascent_tags_w,
  count(DISTINCT CASE WHEN rear_type = 'H' THEN tag_id END) AS tot_tags_h,
  count(DISTINCT CASE WHEN period = 'D' AND rear_type = 'H' THEN tag_id END) AS day_tags_h,
  count(DISTINCT CASE WHEN ascent_count > 1 AND rear_type = 'H' THEN tag_id END) AS reascent_tags_h
"""

TRAP_SUMS = """
  count(*) AS trap_fish,
  count(*) FILTER (origin = 'W') AS wild_morph, count(*) FILTER (origin = 'H') AS hatch_morph,
  count(*) FILTER (origin IN ('U','NI')) AS na_morph,
  count(*) FILTER (srr LIKE '%W') AS wild_pbt, count(*) FILTER (srr LIKE '%H' AND NOT ad_clip) AS hnc_pbt,
  count(*) FILTER (srr LIKE '%H' AND ad_clip) AS hatch_pbt,
  count(*) FILTER (srr NOT LIKE '%W' AND srr NOT LIKE '%H') AS na_pbt,
  count(*) FILTER (valid <> 1) AS n_invalid
"""

B_RUN = "count(*) FILTER (species = 'Steelhead' AND length >= 780 AND srr LIKE '%W')"

TAG_COLUMNS = (
    "tot_tags day_tags reascent_tags tot_tags_w day_tags_w reascent_tags_w tot_tags_h day_tags_h reascent_tags_h"
).split()
TRAP_COLUMNS = (
    "trap_fish wild_morph hatch_morph na_morph wild_pbt hnc_pbt hatch_pbt na_pbt n_invalid tot_b_run_sthd"
).split()
COUNTS = ["win_cnt", *TAG_COLUMNS, *TRAP_COLUMNS]


def each(template: str, names: list[str]) -> str:
    return ", ".join(template.format(c=name) for name in names)


DAILY = f"""
win_run AS (
  SELECT c.run_id, c.week_num, c.date, bool_or(c.jacks) AS jacks,
    sum(w.win_cnt) FILTER (w.species NOT LIKE 'Jack%') AS adults, sum(w.win_cnt) FILTER (w.species LIKE 'Jack%') AS jk
  FROM cal c JOIN win w ON w.dam = c.dam AND w.date = c.date AND
    (w.species = CASE WHEN c.unclipped THEN 'Wild_Steelhead' ELSE c.species END
     OR (c.jacks AND w.species = 'Jack_' || c.species))
  GROUP BY c.run_id, c.week_num, c.date),
win_daily AS (SELECT run_id, week_num, date,
    CASE WHEN jacks THEN coalesce(adults,0) + coalesce(jk,0) ELSE adults END AS win_cnt,
    adults IS NOT NULL AS window_open FROM win_run),
tag_run AS (SELECT run_id, week_num, date, {TAG_SUMS} FROM (
    SELECT c.run_id, c.week_num, c.date, tag_id, rear_type, ascent_count,
      CASE WHEN c.dam IN ('PRD','RIS','RRH') THEN 'D' ELSE period END AS period
    FROM det d JOIN cal c ON d.dam = c.dam AND d.species = c.species AND d.date = c.date)
  GROUP BY run_id, week_num, date),
trap_run AS (SELECT run_id, week_num, date, {TRAP_SUMS},
    CASE WHEN bool_or(b_run) THEN {B_RUN.replace("species", "t_species")} END AS tot_b_run_sthd
  FROM (SELECT c.run_id, c.week_num, c.b_run, t.*, t.species AS t_species FROM trap t
    JOIN cal c ON t.dam = c.dam AND t.species = c.species AND t.date = c.date
    WHERE NOT c.unclipped OR t.ad_clip = false)
  GROUP BY run_id, week_num, date),
daily AS (SELECT w.run_id, w.week_num AS week_num_org, w.date, w.win_cnt, w.window_open,
    {each("t.{c}", TAG_COLUMNS)}, {each("f.{c}", TRAP_COLUMNS)}
  FROM win_daily w LEFT JOIN tag_run t ON t.run_id = w.run_id AND t.date = w.date
  LEFT JOIN trap_run f ON f.run_id = w.run_id AND f.date = w.date),
rolled AS (SELECT run_id, week_num_org, min(date) AS start_date, {each("coalesce(sum({c}),0) AS {c}", COUNTS)},
    bool_or(window_open) AS window_open FROM daily GROUP BY run_id, week_num_org),
weekly0 AS (SELECT rolled.*, week_num_org - min(week_num_org) OVER (PARTITION BY run_id) + 1 AS week_num, dist,
    dam, species, spawn_year FROM rolled JOIN runs USING (run_id))
"""

RATES = """
trap_in AS (SELECT c.run_id, c.week_num, t.date, t.tag_code, t.srr FROM trap t
  JOIN cal c ON t.dam = c.dam AND t.date = c.date),
obs_any AS (SELECT c.run_id, o.*, regexp_extract(sp_rrt, '[0-9]+') AS code, c.dam AS run_dam, c.species AS run_species,
    (left(sp_rrt,1) IN ('2','3') OR (left(sp_rrt,1) = '1' AND month(obs_time) <= 8)) AS in_season
  FROM obs o JOIN cal c ON o.dam = c.dam AND o.obs_date = c.date),
obs_season AS (SELECT * FROM obs_any WHERE CASE WHEN run_dam = 'PRD' THEN left(sp_rrt,1) =
    CASE run_species WHEN 'Chinook' THEN '1' WHEN 'Coho' THEN '2' ELSE '3' END ELSE in_season END),
obs_old AS (SELECT * FROM obs_any WHERE in_season),
obs_free AS (SELECT * FROM obs_season o
  WHERE NOT coalesce(run_dam = 'LWG' AND mark_site IN ('LGRLDR','LGR'), false)
    AND NOT coalesce(run_dam = 'PRD' AND mark_site = 'PRDLD1', false)),
obs_use AS (SELECT * FROM obs_free o WHERE run_dam = 'PRD' OR EXISTS (SELECT 1 FROM trap_in t WHERE t.run_id = o.run_id
   AND regexp_extract(t.srr, '[0-9]+') = o.code)),
first_obs AS (SELECT run_id, tag_code, sp_rrt, min(obs_date) AS obs_date FROM obs_use GROUP BY ALL),
trap_first AS (SELECT run_id, tag_code, min(date) AS trap_date FROM trap_in WHERE tag_code IS NOT NULL GROUP BY ALL),
matched AS (SELECT o.run_id, o.tag_code, t.trap_date IS NOT NULL AS in_trap, coalesce(t.trap_date, o.obs_date) AS d
  FROM first_obs o LEFT JOIN trap_first t ON t.run_id = o.run_id AND t.tag_code = o.tag_code),
matched_dup AS (SELECT o.run_id, o.tag_code, t.date IS NOT NULL AS in_trap, coalesce(t.date, o.obs_date) AS d
  FROM first_obs o LEFT JOIN trap_in t ON t.run_id = o.run_id AND t.tag_code = o.tag_code),
own AS (SELECT DISTINCT run_id, tag_code FROM obs_old WHERE mark_site IN ('LGRLDR','LGR')),
matched_old AS (SELECT o.run_id, o.tag_code, t.date IS NOT NULL AS in_trap, coalesce(t.date, o.obs_date) AS d
  FROM obs_old o LEFT JOIN trap_in t ON t.run_id = o.run_id AND t.tag_code = o.tag_code
  WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.run_id = o.run_id AND own.tag_code = o.tag_code))
"""


def rate_cte(name: str, source: str) -> str:
    return f"""
{name}_n AS (SELECT m.run_id, c.week_num, sum(in_trap::INT) AS n_trap_tags, count(DISTINCT tag_code) AS n_poss_tags
  FROM {source} m JOIN cal c ON c.run_id = m.run_id AND c.date = m.d GROUP BY m.run_id, c.week_num),
{name} AS (SELECT *, CASE WHEN trap_rate <= 1 THEN sqrt(trap_rate * (1 - trap_rate) / n_poss_tags) END AS trap_rate_se,
    CASE WHEN trap_rate <= 1 THEN sqrt(trap_rate * (1 - trap_rate) / n_poss_tags) END / nullif(trap_rate,0)
      AS trap_rate_cv
  FROM (SELECT *, n_trap_tags / n_poss_tags::DOUBLE AS trap_rate FROM {name}_n))
"""


SUMS = "samp_time n_samples n_sby_c n_close tot_fish_trap total_time total_time_inclusive all_pit".split()
MEANS = "rate actual_rate_inclusive_time".split()

REPORTED = f"""
rep_daily AS (SELECT dam, species, date, year, doy, {each("sum({c}) AS {c}", SUMS)},
    {each("sum({c} * w) / nullif(sum(CASE WHEN {c} IS NOT NULL THEN w END), 0) AS {c}", MEANS)}
  FROM (SELECT *, total_time AS w FROM rep) GROUP BY dam, species, date, year, doy),
rep_daily2 AS (SELECT *, 172800 AS seconds_in_day, total_time > 0 AS trap_open,
    total_time_inclusive / 172800 AS rate_calc FROM rep_daily),
rep_weekly AS (SELECT c.run_id, c.week_num, min(r.date) AS start_date, {each("sum({c}) AS {c}", SUMS)},
    {each("avg({c}) AS {c}", MEANS)}, bool_or(trap_open) AS trap_open
  FROM rep_daily2 r JOIN cal c ON c.dam = r.dam AND c.species = r.species AND c.date = r.date
  GROUP BY c.run_id, c.week_num),
rep_weekly2 AS (SELECT r.*, n_days * 86400 - 1 AS seconds_in_week,
    total_time_inclusive / (n_days * 86400 - 1) AS calc_rate FROM rep_weekly r JOIN strata USING (run_id, week_num))
"""

FULL = """
rates AS (
  SELECT t.run_id, t.week_num, n_trap_tags > 0 AS trap_open, n_trap_tags, n_poss_tags, trap_rate, trap_rate_se
  FROM tag_rate t JOIN runs USING (run_id) WHERE source = 'pit'
  UNION ALL
  SELECT w.run_id, w.week_num, actual_rate_inclusive_time > 0, NULL, NULL, actual_rate_inclusive_time,
    actual_rate_inclusive_time * cv FROM rep_weekly2 w JOIN runs USING (run_id) WHERE source = 'reported'),
fish_weeks AS (SELECT run_id, week_num, count(*) AS n_fish FROM trap_in GROUP BY ALL),
rates_open AS (SELECT coalesce(r.run_id, f.run_id) AS run_id, coalesce(r.week_num, f.week_num) AS week_num,
    CASE WHEN n_fish > 0 THEN true ELSE coalesce(trap_open, false) END AS trap_open,
    n_trap_tags, n_poss_tags, trap_rate, trap_rate_se
  FROM rates r FULL JOIN fish_weeks f ON r.run_id = f.run_id AND r.week_num = f.week_num),
expanded AS (SELECT w.*, coalesce(r.trap_open, false) AS trap_open, n_trap_tags, n_poss_tags, trap_rate, trap_rate_se,
    CASE WHEN r.trap_open THEN trap_fish / nullif(trap_rate, 0) END AS trap_est,
    sqrt(trap_rate_se^2 * (trap_fish / nullif(trap_rate^2, 0))^2) AS trap_est_se,
    greatest(0, trap_rate - 1.959963984540054::DOUBLE * trap_rate_se) + 0 * trap_rate_se AS p_lo,
    least(1, trap_rate + 1.959963984540054::DOUBLE * trap_rate_se) + 0 * trap_rate_se AS p_hi
  FROM weekly0 w LEFT JOIN rates_open r ON r.run_id = w.run_id AND r.week_num = w.week_num_org),
lim_in AS (SELECT run_id, week_num_org, 'lo' AS side, win_cnt AS n, p_lo AS p, 0.025 AS q FROM expanded
  UNION ALL SELECT run_id, week_num_org, 'hi', win_cnt, p_hi, 0.975 FROM expanded),
lim_k AS (SELECT *, unnest(generate_series(0, n::BIGINT)) AS k FROM lim_in WHERE p > 0 AND p < 1 AND n > 0),
lim_cdf AS (SELECT *, sum(exp(lgamma(n+1) - lgamma(k+1) - lgamma(n-k+1) + k*ln(p) + (n-k)*ln(1-p)))
    OVER (PARTITION BY run_id, week_num_org, side ORDER BY k) AS cdf FROM lim_k),
lim AS (SELECT run_id, week_num_org, side, min(k) AS k FROM lim_cdf WHERE cdf >= q GROUP BY ALL
  UNION ALL SELECT run_id, week_num_org, side, CASE WHEN n = 0 OR p = 0 THEN 0 ELSE n END::BIGINT FROM lim_in
    WHERE n >= 0 AND (n = 0 OR p = 0 OR p = 1) AND p IS NOT NULL),
limited AS (SELECT x.*, a.k AS lower_trap_lim, b.k AS upper_trap_lim FROM expanded x
  LEFT JOIN lim a ON a.run_id = x.run_id AND a.week_num_org = x.week_num_org AND a.side = 'lo'
  LEFT JOIN lim b ON b.run_id = x.run_id AND b.week_num_org = x.week_num_org AND b.side = 'hi'),
judged AS (SELECT *, coalesce(trap_open AND NOT coalesce(trap_rate < 0.01, false)
      AND NOT (trap_fish = 0 AND win_cnt > 0) AND lower_trap_lim <= trap_fish AND upper_trap_lim >= trap_fish, false)
      AS trap_valid FROM limited),
weekly AS (SELECT *,
    CASE WHEN dist = 'beta' THEN CASE WHEN trap_open AND trap_valid THEN
      CASE WHEN a0 < 0 THEN 0.01 ELSE a0 END ELSE 1e-12 END END AS trap_alpha,
    CASE WHEN dist = 'beta' THEN CASE WHEN trap_open AND trap_valid THEN
      CASE WHEN a0 < 0 THEN 0.01 ELSE a0 END * (1 / nullif(trap_rate,0) - 1) ELSE 1 END END AS trap_beta,
    CASE WHEN dist = 'logit' THEN CASE WHEN trap_open AND trap_valid THEN
      CASE WHEN trap_rate > 0 AND trap_rate < 1 THEN ln(trap_rate / (1 - trap_rate)) END ELSE -25 END END AS trap_mu,
    CASE WHEN dist = 'logit' THEN CASE WHEN trap_open AND trap_valid THEN
      1.0 / nullif(n_trap_tags,0) + 1.0 / nullif(n_poss_tags - n_trap_tags, 0) ELSE 0 END END AS trap_sd
  FROM (SELECT *, ((1 - trap_rate) / nullif(trap_rate_se^2, 0) - 1 / nullif(trap_rate,0)) * trap_rate^2 AS a0
    FROM judged)),
mi AS (SELECT run_id, week_num, (window_open OR trap_open)::INT AS ladder,
    CASE WHEN window_open THEN greatest(win_cnt, 0) END AS y_window,
    CASE WHEN trap_open AND trap_valid THEN trap_fish END AS y_trap,
    wild_pbt AS wild_fish, hnc_pbt AS hnc_fish, hatch_pbt AS hatch_fish,
    CASE WHEN trap_open AND trap_valid AND n_poss_tags IS NOT NULL THEN n_trap_tags END AS n_trap_tags,
    coalesce(n_poss_tags, 0) AS n_poss_tags, tot_tags,
    CASE WHEN window_open OR trap_open THEN least(reascent_tags, tot_tags) END AS reasc_tags,
    CASE WHEN window_open OR trap_open THEN least(day_tags, tot_tags) END AS dc_tags,
    wild_pbt + hnc_pbt + hatch_pbt AS trap_fish,
    (sum(wild_pbt) OVER r > 0)::INT AS wild_exist, (sum(hnc_pbt) OVER r > 0)::INT AS hnc_exist,
    (sum(hatch_pbt) OVER r > 0)::INT AS hatch_exist, count(*) OVER r AS tot_ladder_weeks,
    tot_b_run_sthd AS b_trap, reascent_tags_w, day_tags_w, tot_tags_w, trap_open, wild_morph, hatch_morph
  FROM weekly WINDOW r AS (PARTITION BY run_id))
"""

DRAWS = """
vec AS (SELECT 'LWG-Chinook-' || (y0 + label // 2) AS run_id, label AS chain, vec_id AS iter,
    unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS j FROM embeddings, yr),
draws AS (
  SELECT run_id, chain, iter, CASE j % 4 WHEN 0 THEN 'X.log.all' WHEN 1 THEN 'day.true.logit'
      WHEN 2 THEN 'reasc.true.logit' END || '[' || (j // 4 + 1) || ']' AS param,
    CASE j % 4 WHEN 0 THEN 5 + 4 * v WHEN 1 THEN 8 * v WHEN 2 THEN 8 * v - 2 END AS value
  FROM vec WHERE j % 4 < 3
  UNION ALL SELECT run_id, chain, iter, 'org.phi[' || (j // 4 + 1) || ', 1]', 8 * v FROM vec WHERE j % 4 = 3
  UNION ALL SELECT run_id, chain, iter, 'org.phi[' || (j // 4 + 1) || ', 2]', -4 * v FROM vec WHERE j % 4 = 3),
state AS (SELECT run_id, chain, iter, j // 4 + 1 AS week_num,
    max(CASE WHEN j % 4 = 0 THEN 5 + 4 * v END) AS x_log_all,
    max(CASE WHEN j % 4 = 1 THEN 8 * v END) AS day_true_logit,
    max(CASE WHEN j % 4 = 2 THEN 8 * v - 2 END) AS reasc_true_logit,
    max(CASE WHEN j % 4 = 3 THEN 8 * v END) AS org_phi_wild,
    max(CASE WHEN j % 4 = 3 THEN -4 * v END) AS org_phi_hnc
  FROM vec GROUP BY ALL),
known AS (SELECT s.*, coalesce(m.ladder, 1) AS ladder, coalesce(m.wild_exist, 1) AS wild_exist,
    coalesce(m.hnc_exist, 1) AS hnc_exist, coalesce(m.hatch_exist, 1) AS hatch_exist
  FROM state s LEFT JOIN mi m ON m.run_id = s.run_id AND m.week_num = s.week_num),
p0 AS (SELECT *, ladder / (1 + exp(-day_true_logit)) AS day_true, ladder / (1 + exp(-reasc_true_logit)) AS reasc_true,
    exp(org_phi_wild) * wild_exist AS ew, exp(org_phi_hnc) * hnc_exist AS en, hatch_exist AS eh,
    round(exp(x_log_all) * ladder) AS x_all FROM known),
p1 AS (SELECT *, coalesce(ew / nullif(ew + en + eh, 0), 0) AS prop_wild,
    coalesce(en / nullif(ew + en + eh, 0), 0) AS prop_hnc, coalesce(eh / nullif(ew + en + eh, 0), 0) AS prop_hatch,
    round(x_all * day_true) AS x_day, round(x_all * reasc_true) AS x_reasc,
    round(x_all * (1 - reasc_true)) AS x_new_tot FROM p0),
p2 AS (SELECT *, x_all - x_day AS x_night, round(x_all * prop_wild) AS x_all_wild,
    round(x_all * prop_hnc) AS x_all_hnc, round(x_all * prop_hatch) AS x_all_hatch,
    round(x_new_tot * prop_wild) AS x_new_wild, round(x_new_tot * prop_hnc) AS x_new_hnc,
    round(x_new_tot * prop_hatch) AS x_new_hatch FROM p1),
pass AS (SELECT *, x_all_wild - x_new_wild AS x_reasc_wild, x_new_wild * (1 - day_true) AS x_night_wild FROM p2),
totals AS (SELECT t.*, wild_fish / nullif(x_tot_new_wild, 0) AS prop_tagged FROM (SELECT run_id, chain, iter,
    sum(x_all) AS x_tot_all, sum(x_day) AS x_tot_day, sum(x_night) AS x_tot_night, sum(x_reasc) AS x_tot_reasc,
    sum(x_all_wild) AS x_tot_all_wild, sum(x_all_hatch) AS x_tot_all_hatch, sum(x_all_hnc) AS x_tot_all_hnc,
    sum(x_new_tot) AS x_tot_new_all, sum(x_new_wild) AS x_tot_new_wild, sum(x_new_hatch) AS x_tot_new_hatch,
    sum(x_new_hnc) AS x_tot_new_hnc, sum(x_night_wild) AS x_tot_night_wild, sum(x_reasc_wild) AS x_tot_reasc_wild,
    sum(x_new_hatch) + sum(x_new_hnc) AS x_tot_new_hatch_all FROM pass GROUP BY ALL) t LEFT JOIN
    (SELECT run_id, sum(wild_fish) AS wild_fish FROM mi GROUP BY run_id) USING (run_id)),
pdraws AS (
  SELECT run_id, chain, iter, replace(replace(name, 'x_', 'X.'), '_', '.') || '[' || week_num || ']' AS param, value
  FROM (SELECT run_id, chain, iter, week_num, x_all, x_day, x_night, x_reasc, x_all_wild, x_all_hnc, x_all_hatch,
      x_new_tot, x_new_wild, x_new_hnc, x_new_hatch, x_reasc_wild, x_night_wild, day_true, reasc_true FROM pass)
    UNPIVOT INCLUDE NULLS (value FOR name IN (x_all, x_day, x_night, x_reasc, x_all_wild, x_all_hnc, x_all_hatch,
      x_new_tot, x_new_wild, x_new_hnc, x_new_hatch, x_reasc_wild, x_night_wild, day_true, reasc_true))
  UNION ALL SELECT run_id, chain, iter, 'org.prop[' || week_num || ', 1]', prop_wild FROM pass
  UNION ALL SELECT run_id, chain, iter, 'org.prop[' || week_num || ', 2]', prop_hnc FROM pass
  UNION ALL SELECT run_id, chain, iter, 'org.prop[' || week_num || ', 3]', prop_hatch FROM pass
  UNION ALL SELECT run_id, chain, iter, CASE WHEN name = 'prop_tagged' THEN 'prop.tagged'
      ELSE replace(replace(name, 'x_', 'X.'), '_', '.') END, value
  FROM totals UNPIVOT INCLUDE NULLS (value FOR name IN (x_tot_all, x_tot_day, x_tot_night, x_tot_reasc,
      x_tot_all_wild, x_tot_all_hatch, x_tot_all_hnc, x_tot_new_all, x_tot_new_wild, x_tot_new_hatch, x_tot_new_hnc,
      x_tot_night_wild, x_tot_reasc_wild, x_tot_new_hatch_all, prop_tagged))),
summ AS (SELECT run_id, param, split_part(param, '[', 1) AS name,
    nullif(regexp_extract(param, '[0-9]+'), '')::INT AS week_num,
    nullif(regexp_extract(param, ', ([0-9]+)', 1), '')::INT AS idx2, avg(value) AS mean, stddev_samp(value) AS sd,
    stddev_samp(value) / sqrt(count(value)) AS naive_se, count(value) AS n_draws,
    quantile_cont(value, 0.025) AS q2_5, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
    quantile_cont(value, 0.75) AS q75, quantile_cont(value, 0.975) AS q97_5
  FROM pdraws GROUP BY run_id, param)
"""

WITH = "WITH " + ",".join(
    part.strip()
    for part in (
        RUNS, RECORDS, DAILY, RATES, rate_cte("tag_rate", "matched"), rate_cte("tag_rate_dup", "matched_dup"),
        rate_cte("tag_rate_old", "matched_old"), REPORTED, FULL, DRAWS,
    )
)


def sql(body: str) -> str:
    return f"{WITH}\n{body}"
