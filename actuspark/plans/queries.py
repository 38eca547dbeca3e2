"""Registered queries of the health-cost plans, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..functions.derive import MONEY, approx_median, rate_per_k, ratio, weighted_mean
from ..operators import checks, frames, titles
from ..sources.readers import read_table
from . import adapters, calendar_index, claims, enrichment, forecast, planning, projection, scenarios, seasonality, surveillance, text, transcripts

#: Words of the corpora that carry no topic (fixed values).
STOP = ["that", "with", "from", "this", "were", "have", "they", "their", "dass", "nicht", "eine", "pour", "avec", "dans", "para", "como"]
CLOSE = adapters.CLOSES[-1]


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """The stored claims of each split and month, so that the lines are joined once."""
    return forecast.stored(spark, "facts", _sources(d), lambda: forecast.claims(adapters.raw_fact(spark, d), adapters.UNITS), "SERVICE_CATEGORY")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    """The stored monthly table, built from the source when it is first asked for."""
    return forecast.latest_slice(forecast.stored(spark, "monthly", _sources(d), lambda: forecast.stamped_monthly(_facts(spark, d), forecast.exposure(adapters.raw_fact(spark, d)))))


def _sources(d: str) -> list[str]:
    return [f"{d}/{t}.parquet" for t in adapters.SOURCES]


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    """The stored forecast of 21 months from three months before the end of the table on."""

    def build() -> DataFrame:
        dense = _dense(spark, d)
        edge = str(dense.agg(F.add_months(F.max(forecast.MONTH), -3)).first()[0])
        return projection.train_and_project(dense, edge).withColumn("VAL_DATE", F.lit(edge).cast("date"))

    return forecast.latest_slice(forecast.stored(spark, "predictions", _sources(d), build))


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Decimals as doubles, doubles rounded."""
    return df.select(*[F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.round(c, places).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


def l01_coverage(spark, d):
    return forecast.coverage(forecast.extract_snapshot(adapters.raw_fact(spark, d)))


def l02_completed_combined(spark, d):
    """The monthly table as it is built; the queries after it read the stored one."""
    return _rounded(forecast.completed(_facts(spark, d), forecast.exposure(adapters.raw_fact(spark, d))).select(*forecast.SPLIT, forecast.MONTH, "MM", "PD", "UTIL", "UTIL_K", "PMPM", "DATE_REPORT_QTR"))


def l03_control_totals(spark, d):
    raw = adapters.raw_fact(spark, d)
    return forecast.control_totals(raw, _dense(spark, d), adapters.UNITS)


def _settled(rows: DataFrame) -> DataFrame:
    """The signals to six places by way of ten, where two orders of a sum meet again, so that halves are exact decimals; variances, which doubles hold to fewer places, to two."""
    exact = ("target", "target_lag1", "target_lag2", "target_lag3", "target_lag12", "mean_12", "slope_12", "encoding_12")
    return rows.withColumns({c: F.round(F.col(c).cast("decimal(28,10)"), 6).cast("double") for c in exact} | {"var_12": F.round("var_12", 2)})


def l04_signals(spark, d):
    return _settled(forecast.signals(_dense(spark, d)))


def l04_enriched(spark, d):
    """The signals with calendar, population, risk and seasonal factor."""
    dense = _dense(spark, d)
    return _rounded(_settled(enrichment.enrich_signals(forecast.signals(dense), dense, adapters.member_months(spark, d), l07_seasonality(spark, d))))


def l05_train_and_project(spark, d):
    """Boosted trees of each metric and population: 21 months ahead of each series, with the attribution of each feature in units."""
    return _rounded(_predictions(spark, d))


def l06_fitted_output(spark, d):
    """The final output of the fitted forecasts: both metrics of a series and month side by side, actuals where there are any, the last exposure carried on."""
    made = _predictions(spark, d).select(*forecast.SPLIT, forecast.MONTH, F.col("METRIC").alias("metric"), F.col("PREDICTED").alias("rate"))
    both = scenarios.pair_metrics(made, [*forecast.SPLIT, forecast.MONTH], "metric", "rate", projection.METRICS)
    out = forecast.final_output(both.withColumnRenamed("PMPM_rate", "PREDICTED_PMPM"), _dense(spark, d))
    return _rounded(out.join(both.select(*forecast.SPLIT, forecast.MONTH, F.col("UTIL_K_rate").alias("PREDICTED_UTIL_K")), [*forecast.SPLIT, forecast.MONTH]))


def k01_first_level(spark, d):
    """Gradient and hessian sums by bin of the first level of each population's first tree."""
    return _rounded(projection.first_level(_dense(spark, d), "PMPM"), 2)


def k12_fitted_backtest(spark, d):
    """Error and residual percentiles by method and horizon of models fitted at each of three origins."""
    scored = projection.backtest(_dense(spark, d), ["2000-03-01", "2000-06-01", "2000-09-01"], 6)
    keys = ["METHOD", "HORIZON"]
    error = forecast.holdout_metrics(scored, keys, "PREDICTED", "ACTUAL")
    return _rounded(error.join(forecast.intervals(scored, keys, "PREDICTED", "ACTUAL").drop("n"), keys), 4)


def l06_final_output(spark, d):
    """The last six months against a forecast that repeats the month a year before."""
    dense = _dense(spark, d)
    w = W.series(forecast.SPLIT, forecast.MONTH)
    naive = dense.withColumn("PREDICTED_PMPM", F.lag("PMPM", 12).over(w)).where("PREDICTED_PMPM is not null and DATE_REPORT_MONTH >= date'2001-01-01'")
    return _rounded(forecast.final_output(naive, dense.where("DATE_REPORT_MONTH < date'2001-04-01'")))


def l07_seasonality(spark, d):
    keys = ["MARKET", "SERVICE_CATEGORY"]
    by_month = _dense(spark, d).groupBy(*keys, forecast.MONTH).agg(F.sum("PD").alias("PD"), F.sum("MM").alias("MM"))
    return seasonality.scaffold(by_month, seasonality.average_years(seasonality.norm_factors(by_month, keys, forecast.MONTH, "PD", "MM"), keys), keys)


def l07_clustered_shapes(spark, d):
    keys = ["MARKET", "SERVICE_CATEGORY"]
    by_month = _dense(spark, d).groupBy(*keys, forecast.MONTH).agg(F.sum("PD").alias("PD"), F.sum("MM").alias("MM"))
    vectors = seasonality.month_vectors(seasonality.average_years(seasonality.norm_factors(by_month, keys, forecast.MONTH, "PD", "MM"), keys), keys)
    return seasonality.repair_small(seasonality.cluster_shapes(vectors, 4), keys, 2).select(*keys, "cluster")


def _shapes(spark, d, keys):
    by_month = _dense(spark, d).groupBy(*keys, forecast.MONTH).agg(F.sum("PD").alias("PD"), F.sum("MM").alias("MM"))
    return seasonality.month_vectors(seasonality.average_years(seasonality.norm_factors(by_month, keys, forecast.MONTH, "PD", "MM"), keys), keys)


def k10_cluster_factors(spark, d):
    """Factors of given clusters (one for each service category): medians by cluster and month."""
    keys = ["MARKET", "SERVICE_CATEGORY"]
    shapes = _shapes(spark, d, keys)
    return seasonality.cluster_factors(shapes, shapes.select(*keys, F.col("SERVICE_CATEGORY").alias("cluster")), keys)


def k07_sweep(spark, d):
    """Inertia and Euclidean silhouette of the shapes by market, category and segment for two to five clusters."""
    found = seasonality.sweep_k(_shapes(spark, d, ["MARKET", "SERVICE_CATEGORY", "SEGMENT"]), [2, 3, 4, 5])
    return _rounded(spark.createDataFrame(found, "k int, inertia double, silhouette double"))


def k08_friedman(spark, d):
    keys = ["MARKET"]
    by_month = _dense(spark, d).groupBy(*keys, forecast.MONTH).agg(F.sum("PD").alias("PD"), F.sum("MM").alias("MM"))
    return seasonality.friedman(seasonality.norm_factors(by_month, keys, forecast.MONTH, "PD", "MM"), "MARKET", "year", "month", "factor")


def _relativities(spark, d):
    fact = calendar_index.valid_amounts(read_table(spark, d, "lineitem"), "l_shipdate", "l_extendedprice", "1996-01-01", "2000-12-31")
    return calendar_index.relativities(fact)


def l08_wcd_relativities(spark, d):
    return _relativities(spark, d)


def l08_wcd_monthly(spark, d):
    return calendar_index.monthly(_relativities(spark, d), "2001-01-01", "2002-12-31")


def l09_complete_claims(spark, d):
    paid, _ = adapters.closes(spark, d)
    return _rounded(claims.complete_claims(paid, claims.completion_factors(claims.chain_ladder(paid)), CLOSE))


def l10_pmpm_dashboard(spark, d):
    paid, members = adapters.closes(spark, d)
    return claims.pmpm_dashboard(claims.complete_claims(paid, claims.completion_factors(claims.chain_ladder(paid)), CLOSE), members, CLOSE)


def l10_pmpm_averages(spark, d):
    return claims.period_averages(l10_pmpm_dashboard(spark, d), CLOSE)


def l11_restatement_grid(spark, d):
    return _rounded(claims.restatement_grid(*adapters.closes(spark, d)))


def l11_restatement_by_segment(spark, d):
    return claims.restatement_by_segment(adapters.closes(spark, d)[0])


def l12_top_movers(spark, d):
    return claims.top_movers(claims.restatement_by_segment(adapters.closes(spark, d)[0]), ["incurred", "segment"]).select("close", "rank", "incurred", "segment", "change", "change_pct")


def l12_segment_change(spark, d):
    return claims.segment_change(claims.restatement_by_segment(adapters.closes(spark, d)[0]))


def l12_verdicts(spark, d):
    return claims.verdicts(l12_segment_change(spark, d))


def l13_chain_ladder(spark, d):
    return _rounded(claims.chain_ladder(adapters.closes(spark, d)[0]))


def f18_year_month_cube(spark, d):
    return claims.year_month_cube(adapters.closes(spark, d)[0], CLOSE)


def _rebill_claims(spark, d):
    """Denied (returned) and rebilled (not returned) lines as claims, stored once by kind.

    A rebill is paid its line number of months later; every seventh line's denial is overturned after 90 days, and half of those rebills are recouped.
    """
    claim = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("int"))

    def build() -> DataFrame:
        rows = read_table(spark, d, "lineitem").where(F.col("l_returnflag").isin("R", "N")).join(read_table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        day = F.to_date("l_shipdate")
        return rows.select(
            F.when(F.col("l_returnflag") == "R", "denial").otherwise("rebill").alias("kind"),
            claim.alias("claim"),
            F.col("l_orderkey").alias("ref"),
            F.col("o_custkey").alias("member"),
            (F.col("l_suppkey") % 10).alias("provider"),
            day.alias("day"),
            F.col("o_orderstatus").alias("line_of_business"),
            F.col("l_extendedprice").cast(MONEY).alias("paid"),
            F.add_months(day, F.col("l_linenumber")).alias("paid_day"),
            F.when(F.col("l_linenumber") == 7, F.date_add(day, 90)).alias("reversed_day"),
            (F.col("l_partkey") % 2 == 0).alias("recouped"),
        ).dropDuplicates(["kind", "claim", "ref"])  # A claim holds its reference: with it the rows are where the join left them.

    claims_table = forecast.stored(spark, "rebills", [f"{d}/{t}.parquet" for t in ("lineitem", "orders")], build, "kind")
    return claims_table.where("kind = 'denial'").drop("kind"), claims_table.where("kind = 'rebill'").drop("kind")


def e21_link_rebills(spark, d):
    return planning.link_rebills(*_rebill_claims(spark, d))


def l14_nsaf(spark, d):
    denials, rebills = _rebill_claims(spark, d)
    return planning.nsaf(denials, rebills, planning.link_rebills(denials, rebills))


#: The day at which the classes and the development are seen.
AS_OF = "2000-06-30"


def _triangle(spark, d):
    denials, rebills = _rebill_claims(spark, d)
    return planning.offset_triangle(denials, rebills, planning.link_rebills(denials, rebills), AS_OF)


def l14_development(spark, d):
    """Factors to ultimate of the offsets by age."""
    return planning.offset_development(_triangle(spark, d))


def l14_cohorts(spark, d):
    """Observed and developed offset ratios of each month's recoveries."""
    triangle = _triangle(spark, d)
    return planning.developed_cohorts(triangle, planning.offset_development(triangle))


def l14_nsaf_classes(spark, d):
    """Net savings by line of business and class of claim."""
    denials, rebills = _rebill_claims(spark, d)
    links = planning.link_rebills(denials, rebills)
    triangle = planning.offset_triangle(denials, rebills, links, AS_OF)
    cohorts = planning.developed_cohorts(triangle, planning.offset_development(triangle))
    return planning.nsaf_by_class(planning.classify(denials, rebills, links, AS_OF), cohorts)


def l15_nsaf_bridge(spark, d):
    return planning.nsaf_bridge(l14_nsaf(spark, d))


def l16_actual_vs_expected(spark, d):
    """2000 by market and category against 1999's split of 1.05 times 1999's total of each month."""
    dense = _dense(spark, d).withColumn("month", F.month(forecast.MONTH)).withColumn("year", F.year(forecast.MONTH))
    dims = ["MARKET", "SERVICE_CATEGORY"]
    old = dense.where("year = 1999").groupBy("month", *dims).agg(F.sum("PD").alias("paid"))
    total = old.groupBy("month").agg((F.sum("paid").cast("double") * 1.05).alias("forecast"))
    actual = dense.where("year = 2000").groupBy("month", *dims).agg(F.sum("PD").alias("actual"), F.sum("MM").alias("member_months"))
    return planning.actual_vs_expected(actual, total, planning.allocation_weights(old, ["month"], "paid"), ["month"], dims)


def l17_ma_bid(spark, d):
    """Suppliers as counties: cost from the balance, stars and risk from the key; amounts are decimals until the end."""
    k, tenth = F.col("s_suppkey"), F.lit(Decimal("0.1"))
    cost = F.abs(F.col("s_acctbal").cast("decimal(12,2)")) * tenth + 500
    some = lambda n: (k % n).cast("decimal(3,0)") * tenth
    plans = read_table(spark, d, "supplier").select(k.alias("county"), F.round(cost, 2).alias("base_cost"), (F.lit(2.5) + k % 6 * 0.5).alias("stars"), F.round(cost * (F.lit(Decimal("0.8")) + some(5)), 2).alias("bid"), (F.lit(Decimal("0.9")) + some(4)).alias("risk"))
    return planning.ma_bid(plans).select("county", "quartile", *[F.round(c, 2).cast("double").alias(c) for c in ("benchmark", "savings", "rebate", "payment")])


def l17_mlr(spark, d):
    """The medical loss ratio of each county's payment, with six sevenths of the risk-adjusted bid as medical cost."""
    k, tenth = F.col("s_suppkey"), F.lit(Decimal("0.1"))
    risk = (F.lit(Decimal("0.9")) + (k % 4).cast("decimal(3,0)") * tenth).alias("risk")
    plans = l17_ma_bid(spark, d).join(read_table(spark, d, "supplier").select(k.alias("county"), risk, F.abs(F.col("s_acctbal").cast("decimal(12,2)")).alias("balance"), (k % 5).cast("decimal(3,0)").alias("step")), "county")
    bid = F.round((F.col("balance") * tenth + 500) * (F.lit(Decimal("0.8")) + F.col("step") * tenth), 2)
    medical = F.round((bid * F.col("risk")).cast("double") * 6 / 7, 4)
    return planning.medical_loss_ratio(plans.withColumn("medical", medical), "medical", "payment").select("county", "medical", "payment", "mlr", "meets_floor")


def _payloads(spark, d):
    """Weekly payloads of the events: two laboratory types, ten regions, event types as viruses."""
    e = read_table(spark, d, "events").select(F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 7).alias("w"), (F.col("user_id") % 2).alias("lab"), (F.col("user_id") % 10).alias("r"), F.length("event_type").alias("v"), "value")
    virus = e.groupBy("w", "lab", "r", "v").agg(F.count(F.lit(1)).alias("n"))
    join = lambda c: F.array_join(F.array_sort(F.collect_list(c)), ",")
    part = lambda *x: F.concat(F.lit("["), F.concat_ws(",", *x), F.lit("]"))
    regions = virus.groupBy("w", "lab", "r").agg(part(join(part("v", F.lit("null"), F.lit(0), "n"))).alias("vs"), F.sum("n").alias("m2"))
    types = regions.groupBy("w", "lab").agg(part(part(F.lit(1), part(join(part("r", "vs", "m2"))))).alias("ts"))
    weeks = types.groupBy("w").agg(part(join(part("lab", "ts"))).alias("ls"))
    return weeks.select(F.concat(F.lit('{"data":['), part("w", "ls"), F.lit("]}")).alias("payload"))


def l18_surveillance_regions(spark, d):
    return surveillance.flatten_regions(_payloads(spark, d)).select("week", "lab_type", "region_type", "region", "m2", "m3")


def l18_surveillance_viruses(spark, d):
    return surveillance.flatten_viruses(surveillance.flatten_regions(_payloads(spark, d)))


#: Laboratory types (fixed values); a type without a label shows its id.
LAB_TYPES = [(0, "Clinical Labs"), (1, "Public Health Labs")]


def l18_labelled(spark, d):
    """Counts by week, laboratory type and region with labels; regions are named by the region table, those that it lacks by their id."""
    viruses = surveillance.flatten_viruses(surveillance.flatten_regions(_payloads(spark, d)))
    labs = spark.createDataFrame(LAB_TYPES, "lab_type int, lab string")
    places = read_table(spark, d, "region").select(F.col("r_regionkey").cast("int").alias("region"), F.col("r_name").alias("place"))
    rows = frames.decode(frames.decode(viruses, labs, "lab_type", "lab"), places, "region", "place")
    return rows.groupBy("week", "lab", "place").agg(F.sum("n").alias("n"), F.count_distinct("virus").alias("n_viruses"))


def _docs(spark, d):
    return read_table(spark, d, "documents").select("doc_id", "text")


def m05_keywords(spark, d):
    return text.top_words(text.keyword_freq(_docs(spark, d), "doc_id", "text", STOP), "doc_id", 5)


def l19_transcript_report(spark, d):
    """The extractive summary of each document."""
    return transcripts.summaries(_docs(spark, d), "doc_id", "text")


#: Licences stand for companies, as texts name them: name, ticker, aliases.
NAMED = [
    ("Apache Foundation", None, ["Apache License", "Apache License, Version 2.0", "apache"]),
    ("Free Software", "GNU", ["GNU General Public License", "General Public License", "GPL"]),
    ("Institute", "MIT", ["MIT License"]),
    ("Commons", "CC", ["Creative Commons", "CC BY-NC"]),
]


def l19_mentions(spark, d):
    """Mentions of the dictionary, tickers and capitalised phrases of each document with two contexts."""
    named = spark.createDataFrame(NAMED, "name string, ticker string, aliases array<string>")
    found = transcripts.mentions(_docs(spark, d), "doc_id", "text", named)
    return found.select("doc_id", "rank", "name", "ticker", "n", "confidence", "source", *[F.get("contexts", F.lit(k)).alias(f"context_{k + 1}") for k in (0, 1)])


def m12_mentions(spark, d):
    """Nation names do not occur in the texts, so frequent language markers stand for the dictionary."""
    docs = _docs(spark, d)
    names = spark.createDataFrame([("english", "the"), ("english", "and"), ("german", "der"), ("german", "und"), ("french", "les"), ("spanish", "los")], "name string, alias string")
    merged = text.merge_mentions("doc_id", ("dictionary", text.dictionary_mentions(docs, names, "doc_id", "text")), ("ticker", text.pattern_mentions(docs, "doc_id", "text", "[A-Z]{3,5}", ["THE"], 2)), ("phrase", text.pattern_mentions(docs, "doc_id", "text", "[A-Z][a-z]+ [A-Z][a-z]+", [], 2)))
    return text.top_mentions(merged, "doc_id", 10)


def m01_page_text(spark, d):
    t = text.html_to_text(F.col("html"))
    return read_table(spark, d, "pages").select("page_id", F.length(t).alias("n_chars"), text.word_count(t).alias("n_words"), F.substring(t, 1, 80).alias("head"), t.alias("text"))


def m01_article_text(spark, d):
    """Each page as a transcript source: title and article, and whether they have the 200 words of a whole transcript."""
    pages = read_table(spark, d, "pages").select("page_id", text.article_text(F.col("html")).alias("text"))
    words = text.word_count(F.col("text"))
    return pages.select("page_id", "text", words.cast("bigint").alias("n_words"), (words >= 200).alias("whole"))


def l20_source_advanced(spark, d):
    """The source against a stored snapshot that is a month older, of the same month, a month newer, and empty."""
    raw = forecast.extract_snapshot(adapters.raw_fact(spark, d)).select("VAL_DATE").distinct()
    out = None
    for case, stored in (("older", raw.select(F.add_months("VAL_DATE", -1).alias("VAL_DATE"))), ("equal", raw), ("newer", raw.select(F.add_months("VAL_DATE", 1).alias("VAL_DATE"))), ("none", raw.where("false"))):
        own = forecast.source_advanced(raw, stored).select(F.lit(case).alias("stored"), "*")
        out = own if out is None else out.unionByName(own)
    return out


def l21_reconcile(spark, d):
    """Paid of each month by two lineages: all claims, and the dense table without orphans."""
    a = _facts(spark, d).groupBy(forecast.MONTH).agg(F.sum("PD").cast("double").alias("a"))
    b = _dense(spark, d).groupBy(forecast.MONTH).agg(F.sum("PD").cast("double").alias("b"))
    return forecast.reconcile_paths(a.join(b, forecast.MONTH), "a", "b")


def n11_density(spark, d):
    return checks.density(_dense(spark, d), forecast.SPLIT, ["SEGMENT", "SERVICE_CATEGORY"], F.col("PD") == 0)


def j09_gaps(spark, d):
    return frames.gap_diagnostics(_dense(spark, d), forecast.SPLIT, forecast.MONTH)


def e18_nearest_date(spark, d):
    """Each order of a customer with the nearest of the customer's other-status orders within three days."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    left = o.where("o_orderstatus = 'F'").drop("o_orderstatus")
    right = o.where("o_orderstatus = 'O'").select("o_custkey", F.col("day").alias("near_day"), F.col("o_orderkey").alias("near_key"))
    return frames.nearest_by_date(left, right, "day", "near_day", ["o_orderkey"], ["o_custkey"]).select("o_orderkey", "near_key", "near_day")


def c24_projection_flags(spark, d):
    """The dense table with its population, run metadata and the flags of a projection from 2001 on."""
    rows = scenarios.populations(scenarios.projection_flags(_dense(spark, d), "2001-01-01"))
    rows = scenarios.stamp_run(rows, "2000-12-31", "2000-12-01", 21)
    return rows.select(*forecast.SPLIT, forecast.MONTH, "POPULATION", "IS_PROJECTION", "HORIZON_MONTH", "VAL_DATE", "TRAIN_END", "PROJECTION_START", "PROJECTION_END")


def d09_usable_splits(spark, d):
    return scenarios.usable_splits(forecast.signals(_dense(spark, d)), ["target_lag12", "slope_12"], forecast.SPLIT, 12)


def _page_titles(spark, d):
    """Titles of the pages by scheme: plain and secure ones."""
    t = read_table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), "url")
    plain = t.where(F.startswith("url", F.lit("http://"))).select("page_id", "title")
    return plain, t.where(F.startswith("url", F.lit("https://"))).select(F.col("page_id").alias("secure_id"), F.col("title").alias("secure_title"))


def e19_fuzzy_titles(spark, d):
    """Each page without encryption with the encrypted page of the most similar title."""
    return titles.fuzzy_match(*_page_titles(spark, d), "title", "secure_title")


def e19_title_pairs(spark, d):
    """The candidates of e19_fuzzy_titles: different normalised titles that share half of their words."""
    plain, secure = [
        df.select(titles.normal_title(F.col(c)).alias("title")).where("title is not null").distinct().withColumn("id", F.col("title")) for df, c in zip(_page_titles(spark, d), ("title", "secure_title"), strict=True)
    ]
    return titles.title_pairs(plain, secure).select("l_title", "r_title")


def c22_train_start(spark, d):
    """First month with a year of history, and months from there to the end of 2000."""
    out = scenarios.train_start(_dense(spark, d), forecast.SPLIT, 12)
    return out.withColumn("n_train_months", scenarios.n_train_months(F.lit("2000-12-01").cast("date"), F.col("TRAIN_START")))


def f07_weighted_mean(spark, d):
    """PMPM weighted by exposure, and the exact median of paid, by market and category."""
    out = _dense(spark, d).groupBy("MARKET", "SERVICE_CATEGORY").agg(F.round(weighted_mean(F.col("PD"), F.col("MM")), 6).alias("pmpm"), approx_median(F.col("PD").cast("double"), exact=True).alias("median_paid"))
    return _rounded(out)


def j04_year_month_pivot(spark, d):
    paid, _ = adapters.closes(spark, d)
    return _rounded(claims.pivot_year_month(paid.where(F.col("close") == F.lit(CLOSE).cast("date")), "paid"))


def d13_flat_series(spark, d):
    return seasonality.flat_series(l07_seasonality(spark, d), ["MARKET", "SERVICE_CATEGORY"])


def e07_pair_metrics(spark, d):
    """Rates of both metrics of each market and month, as rows and then paired."""
    keys = ["MARKET", forecast.MONTH]
    total = _dense(spark, d).groupBy(*keys).agg(F.sum("PD").alias("PD"), F.sum("UTIL").alias("UTIL"), F.sum("MM").alias("MM"))
    both = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("rate")) for m, v in (("PMPM", ratio(F.col("PD"), F.col("MM"))), ("UTIL", rate_per_k(F.col("UTIL"), F.col("MM"))))])).alias("x")
    return _rounded(scenarios.pair_metrics(total.select(*keys, both).select(*keys, "x.*"), keys, "metric", "rate"))


def k12_backtest(spark, d):
    """Error and residual percentiles by horizon of the trailing year's rate, over three origins."""
    scored = scenarios.backtest(_dense(spark, d), ["2000-03-01", "2000-06-01", "2000-09-01"], 6)
    error = forecast.holdout_metrics(scored, ["HORIZON"], "PREDICTED", "ACTUAL")
    return _rounded(error.join(forecast.intervals(scored, ["HORIZON"], "PREDICTED", "ACTUAL").drop("n"), "HORIZON"), 4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        l08_wcd_monthly, l08_wcd_relativities, l01_coverage, l02_completed_combined, l03_control_totals, l04_signals, l04_enriched, l05_train_and_project, l06_final_output, l06_fitted_output, k01_first_level, k12_fitted_backtest,
        l07_seasonality, l07_clustered_shapes, k07_sweep, k10_cluster_factors, k08_friedman, l09_complete_claims, l10_pmpm_dashboard, l10_pmpm_averages, l11_restatement_grid, l11_restatement_by_segment,
        l12_top_movers, l12_segment_change, l12_verdicts, l13_chain_ladder, f18_year_month_cube, e21_link_rebills, l14_nsaf, l14_development, l14_cohorts, l14_nsaf_classes, l15_nsaf_bridge, l16_actual_vs_expected,
        l17_ma_bid, l17_mlr, l18_surveillance_regions, l18_surveillance_viruses, l18_labelled, l19_transcript_report, l19_mentions, m01_page_text, m01_article_text, m05_keywords, m12_mentions,
        l20_source_advanced, l21_reconcile, n11_density, j09_gaps, e18_nearest_date, e19_fuzzy_titles, e19_title_pairs, c22_train_start, c24_projection_flags, d09_usable_splits,
        d13_flat_series, e07_pair_metrics, f07_weighted_mean, j04_year_month_pivot, k12_backtest,
    )
}
