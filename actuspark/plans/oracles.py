"""The queries' results in SQL."""

from __future__ import annotations

from . import transcripts
from .adapters import CLOSES

_LINES = """
o AS (
  SELECT o_orderkey, o_custkey, r_name AS enty, CASE WHEN starts_with(o_orderpriority, '1-') THEN 'MA DSNP' ELSE 'MA' END AS plan_type,
    CASE WHEN c_nationkey % 2 = 0 THEN 'OHC' ELSE 'OC' END AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS omon
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
c AS (
  SELECT enty, plan_type, segment, l_linestatus AS hce, CAST(date_trunc('month', l_shipdate) AS DATE) AS mon, l_linenumber AS line,
    CASE WHEN p_type = 'PROMO' THEN 'RX' WHEN l_returnflag = 'A' THEN 'IP' WHEN l_returnflag = 'N' THEN 'OP' ELSE 'PH' END AS maj,
    CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS paid, CAST(l_quantity AS DECIMAL(18,4)) AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN o ON l_orderkey = o_orderkey)"""

_DENSE = (
    _LINES
    + """,
mm AS (
  SELECT MARKET, IS_DUAL, SEGMENT, DATE_REPORT_MONTH, CAST(sum(n) AS BIGINT) AS MM FROM (
    SELECT enty AS MARKET, CASE WHEN plan_type = 'MA DSNP' THEN 1 ELSE 0 END AS IS_DUAL, segment AS SEGMENT, omon AS DATE_REPORT_MONTH, count(DISTINCT o_custkey) AS n
    FROM o GROUP BY ALL) GROUP BY ALL),
cl AS (
  SELECT enty AS MARKET, CASE WHEN plan_type = 'MA DSNP' THEN 1 ELSE 0 END AS IS_DUAL, segment AS SEGMENT,
    CASE maj WHEN 'IP' THEN 'INPATIENT' WHEN 'PH' THEN 'PHYSICIAN' WHEN 'RX' THEN 'PHARMACY' ELSE maj END AS SERVICE_CATEGORY,
    hce AS HCC, mon AS DATE_REPORT_MONTH, sum(paid) AS PD, sum(units) AS UTIL FROM c GROUP BY ALL),
dense AS (
  SELECT s.*, DATE_REPORT_MONTH, MM, coalesce(PD, 0) AS PD, coalesce(UTIL, 0) AS UTIL,
    CAST(coalesce(PD, 0) AS DOUBLE) / MM AS PMPM, CAST(coalesce(UTIL, 0) AS DOUBLE) * 12000 / MM AS UTIL_K
  FROM (SELECT DISTINCT MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC FROM cl) s
  JOIN mm USING (MARKET, IS_DUAL, SEGMENT) LEFT JOIN cl USING (MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC, DATE_REPORT_MONTH)
  WHERE DATE_REPORT_MONTH BETWEEN (SELECT min(DATE_REPORT_MONTH) FROM cl) AND (SELECT max(DATE_REPORT_MONTH) FROM cl))"""
)

_CLOSES = (
    _LINES
    + f""",
k(close) AS (VALUES {", ".join(f"(DATE '{x}')" for x in CLOSES)}),
paid AS (
  SELECT close, last_day(mon) AS incurred, CASE WHEN enty IN ('AFRICA', 'AMERICA') THEN 'HMO' ELSE 'PPO' END AS plan_type,
    CASE WHEN maj = 'IP' THEN 'IP' ELSE 'Non-IP' END AS claim_type, sum(paid) AS paid
  FROM c, k WHERE last_day(CAST(mon + to_months(CAST(line AS INTEGER)) AS DATE)) <= close AND last_day(mon) >= DATE '1999-01-31' GROUP BY ALL),
mem AS (
  SELECT close, incurred, plan_type, member_months FROM (
    SELECT last_day(omon) AS incurred, CASE WHEN enty IN ('AFRICA', 'AMERICA') THEN 'HMO' ELSE 'PPO' END AS plan_type, count(DISTINCT o_custkey) AS member_months
    FROM o GROUP BY ALL), k WHERE incurred <= close AND incurred >= DATE '1999-01-31'),
lagged AS (SELECT *, (year(close) - year(incurred)) * 12 + month(close) - month(incurred) AS lag FROM paid),
seq AS (SELECT *, lag(paid) OVER w AS before, lag("lag") OVER w AS from_lag FROM lagged WINDOW w AS (PARTITION BY incurred, plan_type, claim_type ORDER BY close)),
links AS (SELECT plan_type, claim_type, from_lag, CAST(sum(before) AS DOUBLE) AS paid_before, CAST(sum(paid) AS DOUBLE) AS paid_after FROM seq WHERE "lag" = from_lag + 1 GROUP BY ALL),
ladder AS (
  SELECT *, round(product(link) OVER (PARTITION BY plan_type, claim_type ORDER BY from_lag DESC ROWS UNBOUNDED PRECEDING), 4) AS to_ultimate
  FROM (SELECT *, round(paid_after / nullif(paid_before, 0), 6) AS link FROM links)),
cf AS (
  SELECT s.plan_type, s.claim_type, g AS clag, round(coalesce(1 / to_ultimate, 1.0), 6) AS factor
  FROM (SELECT DISTINCT plan_type, claim_type FROM ladder) s CROSS JOIN range(0, 24) t(g)
  LEFT JOIN ladder l ON l.plan_type = s.plan_type AND l.claim_type = s.claim_type AND l.from_lag = g),
done AS (
  SELECT incurred, p.plan_type, p.claim_type, CAST(least(p."lag", 23) AS INTEGER) AS lag, CAST(paid AS DOUBLE) AS paid, factor, round(CAST(paid AS DOUBLE) / factor, 2) AS ultimate, factor IS NULL AS factor_missing
  FROM lagged p LEFT JOIN cf ON p.plan_type = cf.plan_type AND p.claim_type = cf.claim_type AND least(p."lag", 23) = cf.clag WHERE close = DATE '{CLOSES[-1]}'),
seg AS (SELECT close, incurred, plan_type || ' / ' || claim_type AS segment, "lag", CAST(paid AS DOUBLE) AS paid FROM lagged WHERE "lag" >= 2),
segc AS (
  SELECT *, round(paid - b, 4) AS change, round((paid - b) / nullif(b, 0), 6) AS change_pct, min("lag") OVER (PARTITION BY incurred, segment) AS first_report_lag
  FROM (SELECT *, lag(paid) OVER (PARTITION BY incurred, segment ORDER BY close) AS b FROM seg))"""
)

_WCD = """
f AS (
  SELECT CAST(l_shipdate AS DATE) AS d, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS paid FROM lineitem
  WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND l_extendedprice >= 0 GROUP BY 1),
s AS (SELECT dayofweek(d) + 1 AS day_of_week, count(*) AS day_count, CAST(sum(paid) AS DOUBLE) / count(*) AS mu, stddev_samp(CAST(paid AS DOUBLE)) AS sd FROM f GROUP BY 1),
rel AS (
  SELECT CAST(day_of_week AS INTEGER) AS day_of_week, (['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday'])[day_of_week] AS dow_name, day_count,
    round(mu, 2) AS avg_daily_paid, round(sd, 2) AS std_daily_paid, round(mu / (SELECT avg(mu) FROM s), 6) AS relativity FROM s)"""

_REBILLS = """
x AS (
  SELECT DISTINCT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS INTEGER)) AS claim,
    l_orderkey AS ref, o_custkey AS member, l_suppkey % 10 AS provider, CAST(l_shipdate AS DATE) AS day, o_orderstatus AS lob, CAST(l_extendedprice AS DECIMAL(18,4)) AS paid, l_returnflag AS flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
d AS (SELECT * FROM x WHERE flag = 'R'), r AS (SELECT * FROM x WHERE flag = 'N'),
t3 AS (SELECT r.claim rc, d.claim dc, date_diff('day', d.day, r.day) g, count(*) OVER (PARTITION BY r.claim) n FROM r JOIN d ON r.member = d.member AND r.provider = d.provider AND r.day BETWEEN d.day - 3 AND d.day + 3),
every AS (
  SELECT r.claim rc, d.claim dc, 1 tier, date_diff('day', d.day, r.day) g FROM r JOIN d ON r.ref = d.ref AND r.provider = d.provider
  UNION ALL SELECT rc, dc, 2, g FROM t3 WHERE g = 0 UNION ALL SELECT rc, dc, 3, g FROM t3 WHERE n = 1
  UNION ALL SELECT r.claim, d.claim, 4, date_diff('day', d.day, r.day) FROM r JOIN d ON r.member = d.member AND r.provider = d.provider AND r.day BETWEEN d.day AND d.day + 365),
linked AS (SELECT rc AS r_claim, dc AS d_claim, tier, CAST(g AS INTEGER) AS days FROM (SELECT *, row_number() OVER (PARTITION BY rc ORDER BY tier, abs(g), dc) k FROM every) WHERE k = 1),
off AS (SELECT d_claim, sum(r.paid) AS o FROM linked JOIN r ON r_claim = r.claim WHERE tier <= 3 GROUP BY 1),
agg AS (
  SELECT coalesce(lob, 'all') AS line_of_business, count(*) AS n_denials, count(d_claim) AS n_matched, sum(paid) g, sum(coalesce(o, 0)) o, sum(CASE WHEN d_claim IS NOT NULL THEN paid END) gm
  FROM d LEFT JOIN off ON d.claim = d_claim GROUP BY ROLLUP (lob)),
nsaf AS (
  SELECT line_of_business, n_denials, n_matched, CAST(g AS DOUBLE) AS gross, CAST(o AS DOUBLE) AS "offset", round(CAST(o AS DOUBLE) / CAST(g AS DOUBLE), 6) AS offset_ratio,
    round(CAST(o AS DOUBLE) / CAST(gm AS DOUBLE), 6) AS matched_ratio, round(1 - CAST(o AS DOUBLE) / CAST(g AS DOUBLE), 6) AS net_factor FROM agg)"""

_FACTORS = (
    _DENSE
    + """,
bm AS (SELECT MARKET, SERVICE_CATEGORY, DATE_REPORT_MONTH AS m, sum(PD) AS PD, sum(MM) AS MM FROM dense GROUP BY ALL),
yr AS (SELECT MARKET, SERVICE_CATEGORY, year(m) AS y, CAST(sum(PD) AS DOUBLE) / sum(MM) AS rate FROM bm GROUP BY ALL HAVING count(DISTINCT m) = 12),
fac AS (SELECT bm.MARKET, bm.SERVICE_CATEGORY, y, month(m) AS month, round_even(CAST(PD AS DOUBLE) / MM / nullif(rate, 0), 4) AS factor FROM bm JOIN yr ON bm.MARKET = yr.MARKET AND bm.SERVICE_CATEGORY = yr.SERVICE_CATEGORY AND year(m) = y)"""
)

_FACTORS_M = (
    _DENSE
    + """,
bm AS (SELECT MARKET, DATE_REPORT_MONTH AS m, sum(PD) AS PD, sum(MM) AS MM FROM dense GROUP BY ALL),
yr AS (SELECT MARKET, year(m) AS y, CAST(sum(PD) AS DOUBLE) / sum(MM) AS rate FROM bm GROUP BY ALL HAVING count(DISTINCT m) = 12),
fac AS (SELECT bm.MARKET, y, month(m) AS month, round_even(CAST(PD AS DOUBLE) / MM / nullif(rate, 0), 4) AS factor FROM bm JOIN yr ON bm.MARKET = yr.MARKET AND year(m) = y)"""
)

_W12 = "(PARTITION BY MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC ORDER BY DATE_REPORT_MONTH ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"
_W = "(PARTITION BY MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC ORDER BY DATE_REPORT_MONTH)"
_KEYS = "MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC, DATE_REPORT_MONTH"

_EVENTS = "e AS (SELECT CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER) AS week, CAST(user_id % 2 AS INTEGER) AS lab_type, CAST(user_id % 10 AS INTEGER) AS region, CAST(length(event_type) AS INTEGER) AS virus FROM events)"

ORACLE_SQL: dict[str, str] = {
    "l08_wcd_relativities": f"WITH {_WCD} SELECT * FROM rel",
    "l08_wcd_monthly": f"""WITH {_WCD}, days AS (SELECT strftime(d, '%Y-%m') AS year_month, dayofweek(d) + 1 AS day_of_week FROM (SELECT unnest(generate_series(DATE '2001-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS d))
SELECT year_month, count(*) AS total_days, round(CAST(sum(CAST(relativity AS DECIMAL(18,6))) AS DOUBLE) / count(*), 6) AS wcd_index,
  {", ".join(f"count(*) FILTER (day_of_week = {k}) AS n_{d}" for k, d in enumerate(("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"), 1))}
FROM days JOIN rel USING (day_of_week) GROUP BY 1""",
    "l01_coverage": f"""WITH {_LINES}, raw AS (SELECT enty AS ENTY, maj AS MAJ_SRV_CAT, strftime(mon, '%Y%m') AS ym FROM c
  UNION ALL SELECT DISTINCT enty, 'MBR', strftime(omon, '%Y%m') || plan_type || segment FROM o)
SELECT (SELECT max(mon) FROM c) AS VAL_DATE, ENTY, MAJ_SRV_CAT, min(ym[1:6]) AS first_month, max(ym[1:6]) AS last_month, count(DISTINCT ym[1:6]) AS n_months, count(*) AS n_rows FROM raw GROUP BY ENTY, MAJ_SRV_CAT""",
    "l02_completed_combined": f"""WITH {_DENSE} SELECT {_KEYS}, MM, CAST(PD AS DOUBLE) AS PD, CAST(UTIL AS DOUBLE) AS UTIL, round(UTIL_K, 6) AS UTIL_K, round(PMPM, 6) AS PMPM,
  year(DATE_REPORT_MONTH) || 'Q' || quarter(DATE_REPORT_MONTH) AS DATE_REPORT_QTR FROM dense""",
    "l03_control_totals": f"""WITH {_DENSE}, t AS (SELECT
  (SELECT sum(PD) FROM cl) ps, (SELECT sum(UTIL) FROM cl) us, (SELECT coalesce(sum(PD), 0) FROM cl ANTI JOIN mm USING (MARKET, IS_DUAL, SEGMENT, DATE_REPORT_MONTH)) po,
  (SELECT coalesce(sum(UTIL), 0) FROM cl ANTI JOIN mm USING (MARKET, IS_DUAL, SEGMENT, DATE_REPORT_MONTH)) uo, (SELECT sum(PD) FROM dense) pd, (SELECT sum(UTIL) FROM dense) ud,
  (SELECT sum(MM) FROM mm SEMI JOIN dense USING (MARKET, IS_DUAL, SEGMENT) WHERE DATE_REPORT_MONTH BETWEEN (SELECT min(DATE_REPORT_MONTH) FROM cl) AND (SELECT max(DATE_REPORT_MONTH) FROM cl)) ms, (SELECT sum(MM) FROM (SELECT DISTINCT MARKET, IS_DUAL, SEGMENT, DATE_REPORT_MONTH, MM FROM dense)) md),
r AS (SELECT unnest([{{'metric': 'paid', 'expected': CAST(ps - po AS DOUBLE), 'actual': CAST(pd AS DOUBLE)}}, {{'metric': 'units', 'expected': CAST(us - uo AS DOUBLE), 'actual': CAST(ud AS DOUBLE)}},
  {{'metric': 'paid with orphans', 'expected': CAST(ps AS DOUBLE), 'actual': CAST(pd AS DOUBLE)}}, {{'metric': 'member months', 'expected': CAST(ms AS DOUBLE), 'actual': CAST(md AS DOUBLE)}}]) x FROM t)
SELECT x.metric, x.expected, x.actual, x.metric = 'member months' AS hard, round(x.actual - x.expected, 4) AS diff, round((x.actual - x.expected) / nullif(x.expected, 0), 6) AS pct FROM r""",
    "l06_final_output": f"""WITH {_DENSE}, n AS (SELECT {_KEYS}, lag(PMPM, 12) OVER {_W} AS p FROM dense), old AS (SELECT * FROM dense WHERE DATE_REPORT_MONTH < DATE '2001-04-01'),
last AS (SELECT MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC, arg_max(MM, DATE_REPORT_MONTH) AS lm FROM old GROUP BY ALL)
SELECT {_KEYS}, round(p, 6) AS PREDICTED_PMPM, coalesce(MM, lm) AS MM, CAST(PD AS DOUBLE) AS PD, CAST(UTIL AS DOUBLE) AS UTIL, round(PMPM, 6) AS ACTUAL_PMPM, MM IS NULL AS CARRIED,
  round(CAST(PD AS DOUBLE) / nullif(CAST(UTIL AS DOUBLE), 0), 6) AS UNIT_COST, round(p - PMPM, 6) AS "ERROR"
FROM n LEFT JOIN old USING ({_KEYS}) LEFT JOIN last USING (MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC) WHERE p IS NOT NULL AND DATE_REPORT_MONTH >= DATE '2001-01-01'""",
    "l07_seasonality": f"""WITH {_FACTORS}, av AS (SELECT MARKET, SERVICE_CATEGORY, month, CAST(round(CAST(CAST(sum(CAST(factor AS DECIMAL(18,4))) AS DOUBLE) / count(factor) AS DECIMAL(18,8)), 4) AS DOUBLE) AS f FROM fac GROUP BY ALL)
SELECT k.MARKET, k.SERVICE_CATEGORY, CAST(g AS INTEGER) AS month, least(greatest(coalesce(f, 1.0), 0.5), 2.0) AS factor, monthname(make_date(2000, CAST(g AS BIGINT), 1)) AS month_name
FROM (SELECT DISTINCT MARKET, SERVICE_CATEGORY FROM bm) k CROSS JOIN range(1, 13) t(g) LEFT JOIN av ON k.MARKET = av.MARKET AND k.SERVICE_CATEGORY = av.SERVICE_CATEGORY AND month = g""",
    "l09_complete_claims": f"WITH {_CLOSES} SELECT * FROM done",
    "l10_pmpm_dashboard": f"""WITH {_CLOSES}, u AS (SELECT incurred, sum(CAST(ultimate AS DECIMAL(18,4))) AS ult FROM done GROUP BY 1),
m AS (SELECT incurred, CAST(sum(member_months) AS BIGINT) AS member_months FROM mem WHERE close = DATE '{CLOSES[-1]}' GROUP BY 1),
p AS (SELECT incurred, quarter(incurred) AS quarter, member_months, round(CAST(ult AS DOUBLE) / member_months, 4) AS pmpm FROM u JOIN m USING (incurred) WHERE incurred <= last_day(CAST(DATE '{CLOSES[-1]}' - INTERVAL 2 MONTH AS DATE)))
SELECT incurred, CAST(quarter AS INTEGER) AS quarter, member_months, pmpm, round(pmpm - lag(pmpm) OVER (ORDER BY incurred), 4) AS month_change, round(pmpm / lag(pmpm, 12) OVER (ORDER BY incurred) - 1, 6) AS year_trend,
  round(CAST(sum(CAST(pmpm AS DECIMAL(18,4))) OVER (PARTITION BY year(incurred)) AS DOUBLE) / count(*) OVER (PARTITION BY year(incurred)), 4) AS year_average FROM p""",
    "l11_restatement_grid": f"""WITH {_CLOSES}, a AS (SELECT close, incurred, sum(paid) AS paid FROM paid GROUP BY ALL), b AS (SELECT close, incurred, CAST(sum(member_months) AS BIGINT) AS member_months FROM mem GROUP BY ALL),
g AS (SELECT *, (year(close) - year(incurred)) * 12 + month(close) - month(incurred) AS lag, round(CAST(paid AS DOUBLE) / member_months, 4) AS pmpm FROM a JOIN b USING (close, incurred)),
h AS (SELECT *, lag(pmpm) OVER (PARTITION BY incurred ORDER BY close) AS was FROM g WHERE "lag" >= 2)
SELECT close, incurred, CAST(paid AS DOUBLE) AS paid, member_months, CAST("lag" AS INTEGER) AS lag, pmpm, round(pmpm - was, 4) AS change, round((pmpm - was) / nullif(was, 0), 6) AS change_pct,
  CAST(min("lag") OVER (PARTITION BY incurred) AS INTEGER) AS first_report_lag, coalesce(abs(round((pmpm - was) / nullif(was, 0), 6)) > 0.05, false) AS flagged FROM h""",
    "l11_restatement_by_segment": f'WITH {_CLOSES} SELECT close, incurred, segment, CAST("lag" AS INTEGER) AS lag, paid, change, change_pct, CAST(first_report_lag AS INTEGER) AS first_report_lag, coalesce(abs(change_pct) > 0.05, false) AS flagged FROM segc',
    "l12_top_movers": f"WITH {_CLOSES} SELECT close, CAST(rank AS INTEGER) AS rank, incurred, segment, change, change_pct FROM (SELECT *, row_number() OVER (PARTITION BY close ORDER BY abs(change_pct) DESC, incurred, segment) AS rank FROM segc WHERE change_pct IS NOT NULL) WHERE rank <= 5",
    "l12_segment_change": f"WITH {_CLOSES} SELECT close, segment, count(*) AS n_months, round(CAST(sum(CAST(change AS DECIMAL(18,4))) AS DOUBLE), 2) AS change FROM segc WHERE change IS NOT NULL GROUP BY ALL",
    "l13_chain_ladder": f"WITH {_CLOSES} SELECT plan_type, claim_type, CAST(from_lag AS INTEGER) AS from_lag, paid_before, paid_after, link, to_ultimate FROM ladder",
    "f18_year_month_cube": f"WITH {_CLOSES} SELECT CAST(year(incurred) AS INTEGER) AS year, CAST(month(incurred) AS INTEGER) AS month, CAST(sum(paid) AS DOUBLE) AS paid FROM paid WHERE close = DATE '{CLOSES[-1]}' GROUP BY CUBE (year(incurred), month(incurred))",
    "e21_link_rebills": f"WITH {_REBILLS} SELECT * FROM linked",
    "l14_nsaf": f"WITH {_REBILLS} SELECT * FROM nsaf",
    "l15_nsaf_bridge": f"""WITH {_REBILLS} SELECT line_of_business, 1 AS line_no, 'gross' AS line, round(gross, 2) AS amount FROM nsaf
UNION ALL SELECT line_of_business, 2, 'offset', round(-"offset", 2) FROM nsaf UNION ALL SELECT line_of_business, 3, 'net', round(gross - "offset", 2) FROM nsaf""",
    "l16_actual_vs_expected": f"""WITH {_DENSE}, old AS (SELECT month(DATE_REPORT_MONTH) AS m, MARKET, SERVICE_CATEGORY, sum(PD) AS p FROM dense WHERE year(DATE_REPORT_MONTH) = 1999 GROUP BY ALL),
ex AS (SELECT m, MARKET, SERVICE_CATEGORY, CAST(round(CAST(sum(p) OVER (PARTITION BY m) AS DOUBLE) * 1.05 * (CAST(p AS DOUBLE) / CAST(sum(p) OVER (PARTITION BY m) AS DOUBLE)), 4) AS DECIMAL(18,4)) AS e FROM old),
ac AS (SELECT month(DATE_REPORT_MONTH) AS m, MARKET, SERVICE_CATEGORY, sum(PD) AS a, sum(MM) AS mm FROM dense WHERE year(DATE_REPORT_MONTH) = 2000 GROUP BY ALL),
r AS (SELECT MARKET, SERVICE_CATEGORY, coalesce(sum(a), 0) AS a, coalesce(sum(e), 0) AS e, sum(mm) AS mm FROM ac FULL JOIN ex USING (m, MARKET, SERVICE_CATEGORY) GROUP BY ROLLUP (MARKET, SERVICE_CATEGORY))
SELECT coalesce(MARKET, 'all') AS MARKET, coalesce(SERVICE_CATEGORY, 'all') AS SERVICE_CATEGORY, round(CAST(a AS DOUBLE), 2) AS actual, round(CAST(e AS DOUBLE), 2) AS expected, round(CAST(a - e AS DOUBLE), 2) AS variance,
  round(CAST(a AS DOUBLE) / nullif(CAST(e AS DOUBLE), 0), 6) AS ae_ratio, round(CAST(a - e AS DOUBLE) / nullif(mm, 0), 4) AS variance_per_member FROM r""",
    "l17_ma_bid": """WITH c AS (SELECT s_suppkey AS county, abs(CAST(s_acctbal AS DECIMAL(12,2))) * CAST(0.1 AS DECIMAL(2,1)) + 500 AS cost FROM supplier),
p AS (SELECT county, round(cost, 2) AS base, 2.5 + county % 6 * 0.5 AS stars, round(cost * CAST(CASE county % 5 WHEN 0 THEN 0.8 WHEN 1 THEN 0.9 WHEN 2 THEN 1.0 WHEN 3 THEN 1.1 ELSE 1.2 END AS DECIMAL(2,1)), 2) AS bid,
  CAST(CASE county % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 1.0 WHEN 2 THEN 1.1 ELSE 1.2 END AS DECIMAL(2,1)) AS risk FROM c),
q AS (SELECT *, CAST(ntile(4) OVER (ORDER BY base, county) AS INTEGER) AS quartile FROM p),
b AS (SELECT *, round(base * CAST(CASE quartile WHEN 1 THEN 1.150 WHEN 2 THEN 1.075 WHEN 3 THEN 1.000 ELSE 0.950 END AS DECIMAL(4,3)) * CAST(CASE WHEN stars >= 4 THEN 1.05 ELSE 1.00 END AS DECIMAL(3,2)), 4) AS benchmark FROM q),
s AS (SELECT *, CASE WHEN benchmark > bid THEN benchmark - bid ELSE 0 END AS sv FROM b),
t AS (SELECT *, round(sv * CAST(CASE WHEN stars >= 4.5 THEN 0.70 WHEN stars >= 3.5 THEN 0.65 ELSE 0.50 END AS DECIMAL(3,2)), 4) AS rb FROM s)
SELECT county, quartile, CAST(round(benchmark, 2) AS DOUBLE) AS benchmark, CAST(round(sv, 2) AS DOUBLE) AS savings, CAST(round(rb, 2) AS DOUBLE) AS rebate, CAST(round((bid + rb) * risk, 2) AS DOUBLE) AS payment FROM t""",
    "l18_surveillance_regions": f"WITH {_EVENTS} SELECT week, lab_type, 1 AS region_type, region, CAST(count(*) AS DOUBLE) AS m2, CAST(NULL AS DOUBLE) AS m3 FROM e GROUP BY week, lab_type, region",
    "l18_surveillance_viruses": f"WITH {_EVENTS} SELECT week, lab_type, 1 AS region_type, region, virus, CAST(NULL AS INTEGER) AS cumulative, 0 AS week3, CAST(count(*) AS INTEGER) AS n FROM e GROUP BY week, lab_type, region, virus",
    "l20_source_advanced": f"""WITH {_LINES}, m AS (SELECT max(mon) AS new_max FROM c),
s(stored, k) AS (VALUES ('older', -1), ('equal', 0), ('newer', 1), ('none', NULL)), t AS (SELECT stored, new_max, CAST(new_max + to_months(CAST(k AS INTEGER)) AS DATE) AS stored_max FROM m, s)
SELECT *, coalesce(new_max > stored_max, new_max IS NOT NULL) AS advanced FROM t""",
    "l21_reconcile": f"""WITH {_DENSE}, a AS (SELECT DATE_REPORT_MONTH AS m, CAST(sum(PD) AS DOUBLE) AS a FROM cl GROUP BY 1), b AS (SELECT DATE_REPORT_MONTH AS m, CAST(sum(PD) AS DOUBLE) AS b FROM dense GROUP BY 1)
SELECT count(a) AS n, round(avg(abs((a - b) / nullif(a, 0))), 6) AS mean_abs_pct FROM a JOIN b USING (m)""",
    "n11_density": f"""WITH {_DENSE}, s AS (SELECT MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC, count(*) AS months, count(*) FILTER (PD = 0) AS zeros FROM dense GROUP BY ALL)
SELECT SEGMENT, SERVICE_CATEGORY, count(*) AS n_splits, CAST(sum(months) AS BIGINT) AS months, CAST(sum(zeros) AS BIGINT) AS zeros, round(min(CAST(zeros AS DOUBLE) / months), 6) AS least, round(max(CAST(zeros AS DOUBLE) / months), 6) AS most FROM s GROUP BY ALL""",
    "j09_gaps": f"""WITH {_DENSE} SELECT MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC, min(DATE_REPORT_MONTH) AS first_month, max(DATE_REPORT_MONTH) AS last_month, count(DISTINCT DATE_REPORT_MONTH) AS n_months,
  date_diff('month', min(DATE_REPORT_MONTH), max(DATE_REPORT_MONTH)) + 1 - count(DISTINCT DATE_REPORT_MONTH) AS n_gaps FROM dense GROUP BY ALL""",
    "e18_nearest_date": """WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS s FROM orders)
SELECT o_orderkey, near_key, near_day FROM (SELECT l.o_orderkey, r.o_orderkey AS near_key, r.day AS near_day, row_number() OVER (PARTITION BY l.o_orderkey ORDER BY abs(date_diff('day', l.day, r.day)), r.day, r.o_orderkey) AS k
  FROM o l JOIN o r ON l.o_custkey = r.o_custkey AND abs(date_diff('day', l.day, r.day)) <= 3 WHERE l.s = 'F' AND r.s = 'O') WHERE k = 1""",
    "e19_title_pairs": r"""WITH t AS (SELECT DISTINCT starts_with(url, 'https://') AS secure, trim(regexp_replace(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), '[^a-z0-9]+', ' ', 'g')) AS t FROM pages WHERE starts_with(url, 'http://') OR starts_with(url, 'https://')),
w AS (SELECT secure, t, list_distinct(string_split(t, ' ')) AS w FROM t WHERE t <> '')
SELECT a.t AS l_title, b.t AS r_title FROM w a JOIN w b ON 200 * len(list_intersect(a.w, b.w)) >= 50 * (len(a.w) + len(b.w)) WHERE NOT a.secure AND b.secure""",
    "m05_keywords": """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM documents),
f AS (SELECT doc_id, word, count(*) AS n FROM w WHERE word NOT IN ('that', 'with', 'from', 'this', 'were', 'have', 'they', 'their', 'dass', 'nicht', 'eine', 'pour', 'avec', 'dans', 'para', 'como') GROUP BY ALL)
SELECT doc_id, word, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rank FROM f) WHERE rank <= 5""",
    "k08_friedman": f"""WITH {_FACTORS_M}, r AS (SELECT *, rank() OVER (PARTITION BY MARKET, y ORDER BY factor) + (count(*) OVER (PARTITION BY MARKET, y, factor) - 1) / 2.0::DOUBLE AS r,
  count(*) OVER (PARTITION BY MARKET, y, factor) AS t, count(*) OVER (PARTITION BY MARKET, y) AS k FROM fac WHERE factor IS NOT NULL),
a AS (SELECT MARKET, sum(t * t - 1) AS ties, count(DISTINCT y) AS n, max(k) AS k FROM r GROUP BY 1), b AS (SELECT MARKET, sum(s * s) AS ss FROM (SELECT MARKET, month, sum(r) AS s FROM r GROUP BY ALL) GROUP BY 1)
SELECT MARKET, n, k, round(CAST((12 * ss / (n * k * (k + 1)) - 3 * n * (k + 1)) / nullif(1 - CAST(ties AS DOUBLE) / (n * (k * k * k - k)), 0) AS DOUBLE), 4) AS statistic,
  round(greatest(0, 1 - list_sum(list_transform(range(0, 401), lambda j: exp(((k - 1) / 2.0::DOUBLE + j) * ln(x / 2) - x / 2 - lgamma((k - 1) / 2.0::DOUBLE + j + 1))))), 6) AS p_value
FROM (SELECT *, CAST((12 * ss / (n * k * (k + 1)) - 3 * n * (k + 1)) / nullif(1 - CAST(ties AS DOUBLE) / (n * (k * k * k - k)), 0) AS DOUBLE) AS x FROM a JOIN b USING (MARKET)) WHERE k >= 3 AND n >= 2""",
    "m01_page_text": r"""WITH a AS (SELECT page_id, regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(t, '</?(p|div|br|li|h[1-6]|tr|article|section)[^>]*>', chr(10), 'gi'), '<[^>]+>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS t FROM b),
d AS (SELECT page_id, trim(regexp_replace(t, '[ \t\r\n]+', ' ', 'g'), ' ') AS t FROM c)
SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, CAST(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS INTEGER) AS n_words, substr(t, 1, 80) AS head, t AS text FROM d""",
    "m01_article_text": r"""WITH p AS (SELECT page_id, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') AS head, coalesce(nullif(regexp_extract(html, '<article[^>]*>(.*?)</article>', 1, 'is'), ''), html) AS body FROM pages),
t AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(head,
    '<script.*?</script>|<style.*?</style>', ' ', 'gis'), '<br\s*/?>|</(p|div|li|h[1-6]|section|article)>', chr(10), 'gi'), '<[^>]+>', ' ', 'g'), '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'), '&amp;?', '&', 'g'),
    '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]{2,}', ' ', 'g'), ' ' || chr(9) || chr(10) || chr(13)) || chr(10) || chr(10) || trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(body,
    '<script.*?</script>|<style.*?</style>', ' ', 'gis'), '<br\s*/?>|</(p|div|li|h[1-6]|section|article)>', chr(10), 'gi'), '<[^>]+>', ' ', 'g'), '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'), '&amp;?', '&', 'g'),
    '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]{2,}', ' ', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM p),
w AS (SELECT *, len(string_split(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')), ' ')) AS n FROM t)
SELECT page_id, text, CAST(n AS BIGINT) AS n_words, n >= 200 AS whole FROM w""",
    "m12_mentions": """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS alias FROM documents),
al(name, alias) AS (VALUES ('english', 'the'), ('english', 'and'), ('german', 'der'), ('german', 'und'), ('french', 'les'), ('spanish', 'los')),
d AS (SELECT doc_id, name, count(*) AS n, 'dictionary' AS kind, 0 AS k FROM w JOIN al USING (alias) GROUP BY doc_id, name),
p AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z]{3,5}')) AS name, 'ticker' AS kind, 1 AS k FROM documents
  UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+ [A-Z][a-z]+')), 'phrase', 2 FROM documents),
e AS (SELECT * FROM d UNION ALL SELECT doc_id, name, count(*) AS n, kind, k FROM p WHERE kind <> 'ticker' OR name <> 'THE' GROUP BY doc_id, name, kind, k HAVING count(*) >= 2),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(name) ORDER BY k, n DESC, name) AS r FROM e) WHERE r = 1)
SELECT doc_id, name, n, kind, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, name) AS rank FROM m) WHERE rank <= 10""",
}

_SPLIT = "MARKET, IS_DUAL, SEGMENT, SERVICE_CATEGORY, HCC"

ORACLE_SQL |= {
    "c22_train_start": f"""WITH {_DENSE}, s AS (SELECT {_SPLIT}, CAST(min(DATE_REPORT_MONTH) + INTERVAL 12 MONTH AS DATE) AS TRAIN_START FROM dense GROUP BY ALL)
SELECT *, CAST(greatest(date_diff('month', TRAIN_START, DATE '2000-12-01') + 1, 0) AS INTEGER) AS n_train_months FROM s""",
    "c24_projection_flags": f"""WITH {_DENSE}
SELECT {_SPLIT}, DATE_REPORT_MONTH, SEGMENT || CASE WHEN IS_DUAL = 1 THEN '_DUAL' ELSE '_NON_DUAL' END AS POPULATION, DATE_REPORT_MONTH >= DATE '2001-01-01' AS IS_PROJECTION,
  CASE WHEN DATE_REPORT_MONTH >= DATE '2001-01-01' THEN CAST(date_diff('month', DATE '2001-01-01', DATE_REPORT_MONTH) + 1 AS INTEGER) END AS HORIZON_MONTH,
  DATE '2000-12-31' AS VAL_DATE, DATE '2000-12-01' AS TRAIN_END, DATE '2001-01-01' AS PROJECTION_START, DATE '2002-09-01' AS PROJECTION_END FROM dense""",
    "d09_usable_splits": f"""WITH {_DENSE}, n AS (SELECT {_SPLIT}, row_number() OVER (PARTITION BY {_SPLIT} ORDER BY DATE_REPORT_MONTH) AS p FROM dense)
SELECT {_SPLIT}, count(*) AS n_rows, count(*) FILTER (WHERE p > 3) AS n_with_features, count(*) FILTER (WHERE p > 3) >= 12 AS usable FROM n GROUP BY ALL""",
    "d13_flat_series": f"""SELECT MARKET, SERVICE_CATEGORY, bool_and(factor = 1) AS flat FROM ({ORACLE_SQL["l07_seasonality"]}) GROUP BY ALL""",
    "e07_pair_metrics": f"""WITH {_DENSE}
SELECT MARKET, DATE_REPORT_MONTH, round(CAST(sum(PD) AS DOUBLE) / CAST(sum(MM) AS DOUBLE), 6) AS PMPM_rate, round(CAST(sum(UTIL) AS DOUBLE) * 12000 / CAST(sum(MM) AS DOUBLE), 6) AS UTIL_rate FROM dense GROUP BY ALL""",
    "f07_weighted_mean": f"""WITH {_DENSE}
SELECT MARKET, SERVICE_CATEGORY, round(CAST(sum(PD) AS DOUBLE) / CAST(sum(MM) AS DOUBLE), 6) AS pmpm, median(CAST(PD AS DOUBLE)) AS median_paid FROM dense GROUP BY ALL""",
    "j04_year_month_pivot": f"""WITH {_CLOSES}
SELECT year(incurred) AS year, {", ".join(f'CAST(coalesce(sum(paid) FILTER (WHERE month(incurred) = {m}), 0) AS DOUBLE) AS "{m}"' for m in range(1, 13))} FROM paid WHERE close = DATE '{CLOSES[-1]}' GROUP BY 1""",
    "k12_backtest": f"""WITH {_DENSE}, g(o) AS (VALUES (DATE '2000-03-01'), (DATE '2000-06-01'), (DATE '2000-09-01')),
r AS (SELECT {_SPLIT}, o, round(CAST(sum(PD) AS DOUBLE) / CAST(sum(MM) AS DOUBLE), 4) AS p FROM dense, g WHERE DATE_REPORT_MONTH > o - INTERVAL 12 MONTH AND DATE_REPORT_MONTH <= o GROUP BY ALL),
h AS (SELECT *, unnest(range(1, 7)) AS k FROM r),
e AS (SELECT k, p - PMPM AS e FROM h JOIN dense d USING ({_SPLIT}) WHERE d.DATE_REPORT_MONTH = CAST(o + to_months(CAST(k AS INTEGER)) AS DATE))
SELECT CAST(k AS INTEGER) AS HORIZON, count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(e), 4) AS bias, round(quantile_cont(-e, 0.1), 4) AS low, round(quantile_cont(-e, 0.9), 4) AS high FROM e GROUP BY 1""",
    "k01_first_level": f"""WITH {_DENSE}, s AS (
  SELECT SEGMENT || CASE WHEN IS_DUAL = 1 THEN '_DUAL' ELSE '_NON_DUAL' END AS POPULATION, CASE WHEN abs(PMPM) < 1e-9 THEN 0.0 ELSE PMPM END AS y, CAST(MM AS DOUBLE) AS mm,
    lag(CASE WHEN abs(PMPM) < 1e-9 THEN 0.0 ELSE PMPM END, 1) OVER {_W} AS l1, lag(CASE WHEN abs(PMPM) < 1e-9 THEN 0.0 ELSE PMPM END, 12) OVER {_W} AS l12 FROM dense),
f AS (SELECT POPULATION, greatest(y, 0) AS y, unnest([{{'feature': 'target_lag1', 'v': l1}}, {{'feature': 'target_lag12', 'v': l12}}, {{'feature': 'MM', 'v': mm}}], recursive := true) FROM s WHERE l12 IS NOT NULL),
e AS (SELECT POPULATION, feature, min(v) AS lo, max(v) AS hi, ln(avg(y)) AS score FROM f GROUP BY ALL),
b AS (SELECT POPULATION, feature, CASE WHEN v IS NULL THEN 0 ELSE 1 + len(list_filter(range(1, 8), lambda k: lo + (hi - lo) * k / 8 < v)) END AS bin,
  exp(0.5 * score) - y * exp(-0.5 * score) AS g, 0.5 * exp(0.5 * score) + 0.5 * y * exp(-0.5 * score) AS h FROM f JOIN e USING (POPULATION, feature))
SELECT POPULATION, feature, CAST(bin AS INTEGER) AS bin, round(sum(g), 2) AS g, round(sum(h), 2) AS h, count(*) AS n FROM b GROUP BY ALL""",
}

_AS_OF = "DATE '2000-06-30'"
_TRIANGLE = (
    _REBILLS
    + f""",
more AS (
  SELECT DISTINCT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS INTEGER)) AS claim, l_returnflag AS flag,
    CAST(CAST(l_shipdate AS DATE) + to_months(l_linenumber) AS DATE) AS paid_day, CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS DATE) + 90 END AS reversed_day, l_partkey % 2 = 0 AS recouped FROM lineitem),
dd AS (SELECT d.*, reversed_day, recouped, CAST(date_trunc('month', day) AS DATE) AS cohort FROM d JOIN more m ON d.claim = m.claim AND m.flag = 'R' WHERE day <= {_AS_OF}),
rr AS (SELECT r.*, paid_day FROM r JOIN more m ON r.claim = m.claim AND m.flag = 'N' WHERE paid_day <= {_AS_OF}),
pay AS (SELECT dd.cohort, dd.claim, tier, rr.paid AS amount, paid_day, reversed_day, dd.recouped FROM linked JOIN rr ON r_claim = rr.claim JOIN dd ON d_claim = dd.claim),
entries AS (
  SELECT cohort, least(greatest(date_diff('month', cohort, paid_day), 0), 18) AS age, amount FROM pay WHERE tier <= 3
  UNION ALL SELECT cohort, least(greatest(date_diff('month', cohort, greatest(reversed_day, paid_day)), 0), 18), -amount FROM pay WHERE tier <= 3 AND reversed_day <= {_AS_OF} AND recouped),
sums AS (SELECT cohort, age, sum(amount) AS amount FROM entries GROUP BY ALL),
grid AS (SELECT cohort, gross, unnest(range(0, least(18, date_diff('month', cohort, {_AS_OF})) + 1)) AS age FROM (SELECT cohort, sum(paid) AS gross FROM dd GROUP BY 1)),
tri AS (SELECT cohort, age, gross, sum(coalesce(amount, 0)) OVER (PARTITION BY cohort ORDER BY age) AS o FROM grid LEFT JOIN sums USING (cohort, age)),
dev AS (
  SELECT age, link, round(product(link) OVER (ORDER BY age DESC ROWS UNBOUNDED PRECEDING), 6) AS to_ultimate
  FROM (SELECT a.age, round(coalesce(CAST(sum(b.o) AS DOUBLE) / nullif(CAST(sum(a.o) AS DOUBLE), 0), 1.0), 6) AS link FROM tri a JOIN tri b ON a.cohort = b.cohort AND b.age = a.age + 1 GROUP BY a.age)),
coh AS (
  SELECT t.cohort, t.age, CAST(gross AS DOUBLE) AS gross, round(CAST(o AS DOUBLE) / CAST(gross AS DOUBLE), 6) AS observed, round(CAST(o AS DOUBLE) / CAST(gross AS DOUBLE) * coalesce(to_ultimate, 1.0), 6) AS ultimate, to_ultimate IS NULL AS final
  FROM tri t JOIN (SELECT cohort, max(age) AS age FROM tri GROUP BY 1) m ON t.cohort = m.cohort AND t.age = m.age LEFT JOIN dev ON t.age = dev.age)"""
)

ORACLE_SQL |= {
    "l14_development": f"WITH {_TRIANGLE} SELECT CAST(age AS INTEGER) AS age, link, to_ultimate FROM dev",
    "l14_cohorts": f"WITH {_TRIANGLE} SELECT cohort, CAST(age AS INTEGER) AS age, gross, observed, ultimate, round(1 - ultimate, 6) AS nsaf, final FROM coh",
    "l14_nsaf_classes": f"""WITH {_TRIANGLE},
own AS (SELECT d_claim, sum(rr.paid) FILTER (tier <= 3) AS linked, count(*) FILTER (tier = 4) AS in_review FROM linked JOIN rr ON r_claim = rr.claim GROUP BY 1),
k AS (SELECT dd.*, linked, coalesce(reversed_day <= {_AS_OF}, false) AS gone, CASE WHEN coalesce(reversed_day <= {_AS_OF}, false) THEN 'D' WHEN linked IS NOT NULL THEN 'matched' WHEN in_review > 0 THEN 'C' WHEN day + 365 > {_AS_OF} THEN 'A' ELSE 'B' END AS c FROM dd LEFT JOIN own ON dd.claim = d_claim),
g AS (SELECT lob, c, cohort, count(*) AS n, sum(CASE WHEN gone THEN 0 ELSE paid END) AS gross, sum(CASE WHEN gone AND recouped THEN 0 ELSE coalesce(linked, 0) END) AS own FROM k GROUP BY ALL),
s AS (SELECT lob, c, sum(n) AS n, sum(g.gross) AS gross, sum(own) AS own, sum(CAST(round(CAST(g.gross AS DOUBLE) * greatest(ultimate, 0), 4) AS DECIMAL(18,4))) AS developed FROM g LEFT JOIN coh USING (cohort) GROUP BY ALL),
mr AS (SELECT lob, CAST(own AS DOUBLE) / CAST(gross AS DOUBLE) AS r FROM s WHERE c = 'matched'),
t AS (SELECT s.*, r, CASE c WHEN 'C' THEN CAST(round(CAST(gross AS DOUBLE) * coalesce(r, 0), 4) AS DECIMAL(18,4)) WHEN 'A' THEN developed ELSE own END AS applied FROM s LEFT JOIN mr USING (lob))
SELECT lob AS line_of_business, c AS "class", CAST(n AS BIGINT) AS n_claims, CAST(gross AS DOUBLE) AS gross, round(CAST(applied AS DOUBLE), 2) AS "offset",
  CASE c WHEN 'matched' THEN 'linked payments' WHEN 'A' THEN 'developed' WHEN 'B' THEN 'none' WHEN 'C' THEN 'matched ratio' ELSE 'reversed' END AS basis, round(r, 6) AS matched_ratio,
  round(CAST(sum(applied) OVER (PARTITION BY lob) AS DOUBLE) / CAST(sum(gross) OVER (PARTITION BY lob) AS DOUBLE), 6) AS offset_ratio,
  round(1 - CAST(sum(applied) OVER (PARTITION BY lob) AS DOUBLE) / CAST(sum(gross) OVER (PARTITION BY lob) AS DOUBLE), 6) AS net_factor FROM t""",
}

_listed = lambda words: ", ".join(f"'{w}'" for w in words)
_CLEAN = r"trim(regexp_replace(coalesce(text, ''), '[ \t\r\n]+', ' ', 'g'), ' ')"
_SENTENCES = rf"""clean AS (SELECT doc_id, {_CLEAN} AS t FROM documents),
sents AS (
  SELECT doc_id, CAST(p - 1 AS INTEGER) AS pos, parts[p] AS sentence FROM (
    SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS p FROM (
      SELECT doc_id, string_split(regexp_replace(regexp_replace(t, '{transcripts.STAMP}', '. \1', 'g'), '([.!?]) ([A-Z0-9"''(\[])', '\1' || chr(10) || '\2', 'g'), chr(10)) AS parts FROM clean))
  WHERE len(string_split(parts[p], ' ')) >= 7)"""
_SHORT = lambda c, n: f"CASE WHEN length({c}) <= {n} THEN {c} ELSE regexp_extract(substr({c}, 1, {n - 2}), '(?s)^(.*) ', 1) || '...' END"


def _hits(units: str, keys: str, text: str) -> str:
    """SQL of all mentions in the relation ``units``: aliases by lists of pieces, none that another match contains; tickers; capitalised phrases."""
    low = f"regexp_extract_all(lower({text}), '{transcripts.PIECE}')"
    # Letters beyond ASCII are letters at a word's edge, which the other engine's pattern knows only of ASCII ones.
    text = rf"regexp_replace({text}, '[^\x00-\x7F\p{{P}}\p{{S}}\p{{Z}}\p{{C}}\p{{M}}]', '_', 'g')"
    return rf"""(
  WITH pc AS (SELECT {keys}, {low} AS p FROM {units}),
  st AS (SELECT {keys}, unnest(list_transform(list_filter(range(1, len(p) + 1), lambda i: regexp_matches(p[i], '^{transcripts.WORD}')), lambda i: {{'i': i, 'w': p[i], 'tail': p[i:i + 8]}}), recursive := true) FROM pc),
  al AS (SELECT phrase, min(name) AS name, any_value(len(regexp_extract_all(phrase, '{transcripts.WORD}'))) AS n, any_value(regexp_extract(phrase, '{transcripts.WORD}')) AS w FROM (SELECT name, lower(unnest(aliases)) AS phrase FROM named) GROUP BY phrase),
  ph AS (SELECT {keys}, i, 2 * n - 1 AS span, name FROM st JOIN al USING (w) WHERE array_to_string(tail[1:2 * n - 1], '') = phrase),
  tk AS (SELECT {keys}, x AS ticker, pl FROM (SELECT {keys}, unnest(l) AS x, unnest(range(len(l))) AS pl FROM (SELECT {keys}, regexp_extract_all({text}, '{transcripts.TICKER_TOKEN}') AS l FROM {units})) WHERE regexp_matches(x, '^[A-Z]{{2,5}}(\.[A-Z])?$')),
  cp AS (SELECT {keys}, regexp_replace(x, '^[ .,:;!?()\[\]]+|[ .,:;!?()\[\]]+$', '', 'g') AS name, pl FROM (SELECT {keys}, unnest(l) AS x, unnest(range(len(l))) AS pl FROM (SELECT {keys}, regexp_extract_all({text}, '{transcripts.CAPITALISED}') AS l FROM {units})))
  SELECT {keys}, 0 AS kind, i AS pl, name, ticker FROM ph JOIN named USING (name)
    WHERE NOT EXISTS (SELECT 1 FROM ph o WHERE {" AND ".join(f"o.{k} = ph.{k}" for k in keys.split(", "))} AND o.i <= ph.i AND o.i + o.span >= ph.i + ph.span AND o.span > ph.span)
  UNION ALL SELECT {keys}, 0, pl, name, ticker FROM tk JOIN named USING (ticker)
  UNION ALL SELECT {keys}, 1, pl, ticker, ticker FROM tk WHERE ticker NOT IN (SELECT ticker FROM named WHERE ticker IS NOT NULL) AND ticker NOT IN ({_listed(transcripts.STOP_TICKERS)})
  UNION ALL SELECT {keys}, 2, pl, name, NULL FROM cp WHERE length(name) >= 4 AND name <> upper(name) AND (len(string_split(name, ' ')) >= 2 OR string_split(name, ' ')[-1] IN ({_listed(transcripts.COMPANY_SUFFIXES)}))
    AND lower(string_split(name, ' ')[1]) NOT IN ({_listed(transcripts.NO_FIRST_WORDS)}) AND lower(name) <> 'all in')"""


#: The dictionary of ``queries.NAMED``.
_NAMED = """named(name, ticker, aliases) AS (VALUES ('Apache Foundation', NULL, ['Apache License', 'Apache License, Version 2.0', 'apache']), ('Free Software', 'GNU', ['GNU General Public License', 'General Public License', 'GPL']),
  ('Institute', 'MIT', ['MIT License']), ('Commons', 'CC', ['Creative Commons', 'CC BY-NC']))"""

ORACLE_SQL |= {
    "l19_transcript_report": rf"""WITH {_SENTENCES},
w AS (SELECT doc_id, unnest(l) AS word, unnest(range(len(l))) AS pl FROM (SELECT doc_id, regexp_extract_all(lower(t), '{transcripts.WORD}') AS l FROM clean)),
f AS (SELECT doc_id, word, count(*) AS n, min(pl) AS pl FROM w WHERE regexp_matches(word, '^[a-z]{{4,}}$') AND word NOT IN ({_listed(transcripts.STOPWORDS)}) GROUP BY ALL),
top AS (SELECT doc_id, word, least(n, 7) AS points FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, pl) AS k FROM f) WHERE k <= 30),
held AS (SELECT s.doc_id, s.pos, sum(points) AS points FROM sents s JOIN top ON s.doc_id = top.doc_id AND contains(lower(sentence), word) GROUP BY ALL),
g AS (SELECT s.*, round((coalesce(points, 0) + 5 * len(list_intersect(list_distinct(regexp_extract_all(lower(sentence), '{transcripts.WORD}')), [{_listed(transcripts.SIGNAL_WORDS)}]))
  + CASE WHEN regexp_matches(sentence, '{transcripts.TICKER_LIKE}') THEN 4 ELSE 0 END) / greatest(1.0::DOUBLE, length(sentence) / 180.0::DOUBLE), 6) AS score FROM sents s LEFT JOIN held USING (doc_id, pos)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos DESC) AS rank, least(6, greatest(3, round_even(count(*) OVER (PARTITION BY doc_id) / 35.0::DOUBLE, 0))) AS k FROM g),
z AS (SELECT *, regexp_replace(sentence, '(?i)^(Speaker [0-9]+)[: \-]+', '') AS s FROM r WHERE rank <= k)
SELECT doc_id, pos, CAST(rank AS INTEGER) AS rank, score, {_SHORT("s", 280)} AS sentence FROM z""",
    "l19_mentions": rf"""WITH {_NAMED}, {_SENTENCES},
c AS (SELECT doc_id, kind, lower(name) AS low, count(*) AS n, max_by(name, pl) AS name, max(ticker) AS ticker FROM {_hits("clean", "doc_id", "t")} GROUP BY ALL HAVING kind < 2 OR count(*) >= 2),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, low ORDER BY kind) AS f FROM c) WHERE f = 1),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, low) AS rank FROM b) WHERE rank <= 25),
h AS (SELECT DISTINCT doc_id, pos, kind, lower(name) AS low FROM {_hits("sents", "doc_id, pos", "sentence")}),
x AS (SELECT doc_id, kind, low, list({_SHORT("sentence", 220)} ORDER BY pos) AS s FROM h JOIN sents USING (doc_id, pos) GROUP BY ALL)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, name, ticker, n, CASE WHEN kind = 0 THEN 'high' WHEN kind = 1 AND n > 1 THEN 'medium' ELSE 'low' END AS confidence,
  ['known aliases', 'ticker pattern', 'capitalized phrase heuristic'][kind + 1] AS source, s[1] AS context_1, s[2] AS context_2 FROM t LEFT JOIN x USING (doc_id, kind, low)""",
}

ORACLE_SQL |= {
    "l10_pmpm_averages": f"""WITH p AS ({ORACLE_SQL["l10_pmpm_dashboard"]}), e AS (SELECT month(last_day(CAST(DATE '{CLOSES[-1]}' - INTERVAL 2 MONTH AS DATE))) AS m),
x AS (SELECT year(incurred) AS year, 'Q' || quarter AS period, pmpm FROM p, e WHERE month(incurred) <= m UNION ALL SELECT year(incurred), 'YTD', pmpm FROM p, e WHERE month(incurred) <= m UNION ALL SELECT year(incurred), 'FY', pmpm FROM p)
SELECT CAST(year AS INTEGER) AS year, period, count(*) AS n_months, round(CAST(sum(CAST(pmpm AS DECIMAL(18,4))) AS DOUBLE) / count(*), 4) AS average FROM x GROUP BY year, period HAVING period <> 'FY' OR count(*) = 12""",
    "l12_verdicts": f"""WITH g AS ({ORACLE_SQL["l12_segment_change"]}), d AS (SELECT close, string_split(segment, ' / ') AS s, CAST(change AS DECIMAL(18,4)) AS c FROM g),
v AS (
  SELECT close, 'claim_type' AS dimension, 'IP' AS "first", 'Non-IP' AS "second", sum(c) FILTER (s[2] = 'IP') AS a, sum(c) FILTER (s[2] = 'Non-IP') AS b FROM d GROUP BY close
  UNION ALL SELECT close, 'plan_type', 'HMO', 'PPO', sum(c) FILTER (s[1] = 'HMO'), sum(c) FILTER (s[1] = 'PPO') FROM d GROUP BY close)
SELECT close, dimension, "first", "second", round(CAST(coalesce(a, 0) AS DOUBLE), 2) AS first_change, round(CAST(coalesce(b, 0) AS DOUBLE), 2) AS second_change, CASE WHEN abs(coalesce(a, 0)) > abs(coalesce(b, 0)) THEN "first" ELSE "second" END AS bigger FROM v""",
    "l17_mlr": f"""WITH q AS ({ORACLE_SQL["l17_ma_bid"]}), s AS (
  SELECT s_suppkey AS county, CAST(CASE s_suppkey % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 1.0 WHEN 2 THEN 1.1 ELSE 1.2 END AS DECIMAL(2,1)) AS risk,
    round((abs(CAST(s_acctbal AS DECIMAL(12,2))) * CAST(0.1 AS DECIMAL(2,1)) + 500) * CAST(CASE s_suppkey % 5 WHEN 0 THEN 0.8 WHEN 1 THEN 0.9 WHEN 2 THEN 1.0 WHEN 3 THEN 1.1 ELSE 1.2 END AS DECIMAL(2,1)), 2) AS bid FROM supplier),
m AS (SELECT county, round(CAST(bid * risk AS DOUBLE) * 6 / 7, 4) AS medical, payment FROM q JOIN s USING (county))
SELECT *, round(medical / payment, 6) AS mlr, round(medical / payment, 6) >= 0.85 AS meets_floor FROM m""",
}

_settled = lambda x: f"CAST(round(CAST({x} AS DECIMAL(28,10)), 6) AS DOUBLE)"

_SIGNALS = f"""WITH {_DENSE}, b AS (SELECT {_KEYS}, CASE WHEN abs(PMPM) < 1e-9 THEN 0.0 ELSE PMPM END AS target FROM dense),
s AS (SELECT *, avg(target) OVER (PARTITION BY MARKET, SERVICE_CATEGORY, DATE_REPORT_MONTH) AS section, CAST(row_number() OVER {_W} AS INTEGER) AS position FROM b),
sig AS (SELECT {_KEYS}, {_settled('target')} AS target, position, {", ".join(f"{_settled(f'lag(target, {n}) OVER {_W}')} AS target_lag{n}" for n in (1, 2, 3, 12))},
  {_settled(f'CASE WHEN count(target) OVER {_W12} >= 3 THEN avg(target) OVER {_W12} END')} AS mean_12, round(CASE WHEN count(target) OVER {_W12} >= 3 THEN var_samp(target) OVER {_W12} END, 2) AS var_12,
  CASE WHEN count(target) OVER {_W12} >= 3 THEN CAST(sum(CASE WHEN abs(target) < 1e-9 THEN 1 ELSE 0 END) OVER {_W12} AS BIGINT) END AS zeros_12,
  {_settled(f'CASE WHEN count(target) OVER {_W12} >= 3 THEN regr_slope(target, position) OVER {_W12} END')} AS slope_12, {_settled(f'CASE WHEN count(section) OVER {_W12} >= 3 THEN avg(section) OVER {_W12} END')} AS encoding_12 FROM s)"""

ORACLE_SQL["l04_signals"] = f"{_SIGNALS} SELECT * FROM sig"
ORACLE_SQL["l04_enriched"] = f"""{_SIGNALS},
days AS (SELECT CAST(d AS DATE) AS d, CAST(date_trunc('month', d) AS DATE) AS DATE_REPORT_MONTH FROM (SELECT unnest(generate_series((SELECT min(DATE_REPORT_MONTH) FROM dense), last_day((SELECT max(DATE_REPORT_MONTH) FROM dense)), INTERVAL 1 DAY)) AS d)),
cal AS (SELECT DATE_REPORT_MONTH, CAST(month(DATE_REPORT_MONTH) AS INTEGER) AS MONTH_NBR, CAST(date_diff('month', (SELECT min(DATE_REPORT_MONTH) FROM dense), DATE_REPORT_MONTH) AS INTEGER) AS LINEAR_MONTH, count(*) FILTER (isodow(d) <= 5) AS WORKDAY FROM days GROUP BY 1),
mem AS (SELECT DISTINCT enty AS MARKET, segment AS SEGMENT, omon AS DATE_REPORT_MONTH, o_custkey AS k FROM o),
pop AS (SELECT MARKET, SEGMENT, DATE_REPORT_MONTH, {", ".join(f"round(CAST(count(*) FILTER (k % 3 = {n}) AS DOUBLE) / count(*), 6) AS {a}_SHARE" for n, a in enumerate(("PEDIATRIC", "ADULT", "SENIOR")))},
  round(CAST(count(*) FILTER (k % 2 = 1) AS DOUBLE) / count(*), 6) AS FEMALE_SHARE, round(CAST(sum(8 + k % 5) AS DOUBLE) / count(*), 6) AS PROSP_RISK FROM mem GROUP BY ALL),
fac AS ({ORACLE_SQL["l07_seasonality"]})
SELECT sig.*, MONTH_NBR, LINEAR_MONTH, WORKDAY, PEDIATRIC_SHARE, ADULT_SHARE, SENIOR_SHARE, FEMALE_SHARE, PROSP_RISK, coalesce(factor, 1.0) AS SEASONAL_FACTOR
FROM sig LEFT JOIN cal USING (DATE_REPORT_MONTH) LEFT JOIN pop USING (MARKET, SEGMENT, DATE_REPORT_MONTH) LEFT JOIN fac ON sig.MARKET = fac.MARKET AND sig.SERVICE_CATEGORY = fac.SERVICE_CATEGORY AND MONTH_NBR = fac.month"""

ORACLE_SQL["k10_cluster_factors"] = f"""WITH {_FACTORS}, av AS (SELECT MARKET, SERVICE_CATEGORY, month, CAST(round(CAST(CAST(sum(CAST(factor AS DECIMAL(18,4))) AS DOUBLE) / count(factor) AS DECIMAL(18,8)), 4) AS DOUBLE) AS f FROM fac GROUP BY ALL),
g AS (SELECT MARKET, SERVICE_CATEGORY, m AS month, coalesce(f, 1.0) AS f FROM (SELECT DISTINCT MARKET, SERVICE_CATEGORY FROM av) CROSS JOIN range(1, 13) t(m) LEFT JOIN av USING (MARKET, SERVICE_CATEGORY) WHERE av.month = m OR av.month IS NULL),
fl AS (SELECT MARKET, SERVICE_CATEGORY, bool_and(f = 1) AS flat FROM g GROUP BY ALL),
md AS (SELECT SERVICE_CATEGORY, month, median(f) AS med FROM g JOIN fl USING (MARKET, SERVICE_CATEGORY) WHERE NOT flat GROUP BY ALL)
SELECT MARKET, SERVICE_CATEGORY, CAST(month AS INTEGER) AS month, least(greatest(CASE WHEN flat THEN 1.0 ELSE coalesce(med, 1.0) END, 0.5), 2.0) AS factor FROM g JOIN fl USING (MARKET, SERVICE_CATEGORY) LEFT JOIN md USING (SERVICE_CATEGORY, month)"""

ORACLE_SQL["l18_labelled"] = f"""WITH {_EVENTS}
SELECT week, CASE lab_type WHEN 0 THEN 'Clinical Labs' WHEN 1 THEN 'Public Health Labs' END AS lab, coalesce(r_name, CAST(region AS VARCHAR)) AS place, count(*) AS n, count(DISTINCT virus) AS n_viruses
FROM e LEFT JOIN region ON region = r_regionkey GROUP BY ALL"""
