"""Net savings, actual against expected, and bid arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import MONEY, lag_months, ratio
from ..operators.checks import CheckFailed


def link_rebills(denials: DataFrame, rebills: DataFrame, near: int = 3, window: int = 365) -> DataFrame:
    """Each rebill with at most one denial, at the first tier that links it; a denial can have several rebills, which all offset it.

    Tier 1: the explicit reference; 2: member, provider and date; 3: dates at most ``near`` days
    apart and one candidate only; 4: the last denial within ``window`` days before it, for review, not
    accepted. A rebill that a tier links is no candidate of the next one. Claims are unique on each side.

    Two shuffles serve all tiers: by reference and provider, and by member, provider and time bucket. Within them windows over
    denials and rebills in the order of time find the neighbours of each rebill, so that a reference or member with very many
    claims makes no pairs and a member is cut by time.
    """
    side = lambda df, kind: df.select("claim", "ref", "member", "provider", F.unix_date("day").alias("at"), F.lit(kind).alias("kind"))
    rows = side(denials, 0).unionByName(side(rebills, 1))
    denial = F.when((F.col("kind") == 0) & F.col("at").isNotNull(), F.struct("at", "claim"))

    # Of the denials of a day the last row is the smallest claim; the second window runs back in time.
    by_ref = Window.partitionBy("ref", "provider")
    up, down = by_ref.orderBy("at", "kind", F.desc("claim")), by_ref.orderBy(F.desc("at"), "kind", F.desc("claim"))
    last = lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    far = lambda x: F.when(x.isNotNull(), F.struct(F.abs(F.col("at") - x["at"]).alias("far"), x["claim"].alias("claim"), x["at"].alias("at")))
    rows = rows.withColumn("_before", last(denial, up)).withColumn("_after", last(denial, down))
    known = F.col("ref").isNotNull() & F.col("provider").isNotNull() & F.col("at").isNotNull()
    first = F.when((F.col("kind") == 1) & known, F.least(far(F.col("_before")), far(F.col("_after"))))
    rows = rows.select("member", "provider", "claim", "at", "kind", first.alias("_first"))

    # A denial goes to each bucket that may hold a rebill from ``near`` days before it to ``window`` days after it; wide buckets make few copies.
    bucket = lambda c: F.floor(c / (4 * window))
    reach = F.when(F.col("kind") == 0, F.sequence(bucket(F.col("at") - near), bucket(F.col("at") + window))).otherwise(F.array(bucket(F.col("at"))))
    spread = rows.withColumn("bucket", F.explode_outer(reach))
    who = Window.partitionBy("member", "provider", "bucket")
    around = who.orderBy("at").rangeBetween(-near, near)
    is_denial = F.when(F.col("kind") == 0, 1)
    spread = spread.withColumn("_last", last(denial, who.orderBy("at", "kind", F.desc("claim"))))
    spread = spread.withColumns({"_near": F.count(is_denial).over(around), "_sole": F.min(denial).over(around)}).where("kind = 1")
    whole = F.col("member").isNotNull() & F.col("provider").isNotNull() & F.col("at").isNotNull()
    gap = F.col("at") - F.col("_last.at")
    link = lambda x, tier: F.struct(x["claim"].alias("d_claim"), F.lit(tier).alias("tier"), (F.col("at") - x["at"]).alias("days"))
    found = F.when(F.col("_first").isNotNull(), link(F.col("_first"), 1))
    for tier, holds, x in ((2, gap == 0, "_last"), (3, F.col("_near") == 1, "_sole"), (4, gap <= window, "_last")):
        found = found.when(whole & holds, link(F.col(x), tier))
    return spread.select(F.col("claim").alias("r_claim"), found.alias("x")).where("x is not null").select("r_claim", "x.*")


def nsaf(denials: DataFrame, rebills: DataFrame, links: DataFrame, strata: str = "line_of_business") -> DataFrame:
    """Gross denied, offset of the linked rebills (tiers 1 to 3), offset ratio and net factor, by stratum and in all."""
    paid = links.where("tier <= 3").join(rebills.select(F.col("claim").alias("r_claim"), F.col("paid").alias("rebill")), "r_claim").groupBy("d_claim").agg(F.sum("rebill").alias("offset"))
    rows = denials.join(paid, F.col("claim") == F.col("d_claim"), "left").select(strata, F.col("paid").alias("gross"), F.coalesce("offset", F.lit(0).cast(MONEY)).alias("offset"), F.col("d_claim").isNotNull().alias("matched"))
    out = rows.rollup(strata).agg(
        F.count(F.lit(1)).alias("n_denials"),
        F.count_if("matched").alias("n_matched"),
        F.sum("gross").alias("g"),
        F.sum("offset").alias("o"),
        F.sum(F.when(F.col("matched"), F.col("gross"))).alias("gm"),
    )
    return out.select(
        F.coalesce(strata, F.lit("all")).alias(strata),
        "n_denials",
        "n_matched",
        F.col("g").cast("double").alias("gross"),
        F.col("o").cast("double").alias("offset"),
        F.round(ratio(F.col("o"), F.col("g")), 6).alias("offset_ratio"),
        F.round(ratio(F.col("o"), F.col("gm")), 6).alias("matched_ratio"),
        F.round(1 - ratio(F.col("o"), F.col("g")), 6).alias("net_factor"),
    )


def nsaf_bridge(result: DataFrame, strata: str = "line_of_business") -> DataFrame:
    """Gross, offset and net as lines."""
    lines = F.array(*[F.struct(F.lit(k).alias("line_no"), F.lit(n).alias("line"), v.alias("amount")) for k, n, v in ((1, "gross", F.col("gross")), (2, "offset", -F.col("offset")), (3, "net", F.col("gross") - F.col("offset")))])
    return result.select(strata, F.explode(lines).alias("x")).select(strata, "x.line_no", "x.line", F.round("x.amount", 2).alias("amount"))


def classify(denials: DataFrame, rebills: DataFrame, links: DataFrame, as_of: str, window: int = 365) -> DataFrame:
    """The denials known at ``as_of`` with class, gross and offset by what was paid until then.

    ``denials``: claim, day (of the recovery), paid, and where an appeal overturned them reversed_day and recouped (whether the rebill's
    payment was taken back); ``rebills``: claim, paid, paid_day. Classes: matched (tiers 1 to 3 with a payment); D, overturned: the recovery is
    taken back, and a rebill that was not recouped stays a cost; C, a rebill was paid but its link awaits review (tier 4);
    A, the time to rebill is still open; B, it is over: no offset. Offsets above the recovery stay negative savings.
    """
    end = F.lit(as_of).cast("date")
    paid = rebills.where(F.col("paid_day") <= end).select(F.col("claim").alias("r_claim"), F.col("paid").alias("rebill"))
    by_denial = links.join(paid, "r_claim").groupBy(F.col("d_claim").alias("claim")).agg(F.sum(F.when(F.col("tier") <= 3, F.col("rebill"))).alias("linked"), F.count_if(F.col("tier") == 4).alias("in_review"))
    rows = denials.where(F.col("day") <= end).join(by_denial, "claim", "left")
    none = F.lit(0).cast(MONEY)
    over = F.coalesce(F.col("reversed_day") <= end, F.lit(False))
    kind = F.when(over, "D").when(F.col("linked").isNotNull(), "matched").when(F.col("in_review") > 0, "C").when(F.date_add("day", window) > end, "A").otherwise("B")
    offset = F.when(over & F.col("recouped"), none).otherwise(F.coalesce("linked", none))
    return rows.withColumns({"class": kind, "gross": F.when(over, none).otherwise(F.col("paid")).cast(MONEY), "offset": offset.cast(MONEY)}).drop("linked", "in_review")


def offset_triangle(denials: DataFrame, rebills: DataFrame, links: DataFrame, as_of: str, ages: int = 18) -> DataFrame:
    """cohort (month of recovery), age (months since), gross and offset paid up to that age, for the ages that ``as_of`` has seen; payments after the last age count there.

    Two time axes: a cohort's recoveries, and when their offsets were paid. An appeal that takes a rebill back is a negative entry
    at the age of the reversal.
    """
    end = F.lit(as_of).cast("date")
    month = lambda c: F.trunc(c, "month")
    known = denials.where(F.col("day") <= end).select(F.col("claim").alias("d_claim"), month("day").alias("cohort"), "paid", "reversed_day", "recouped")
    age = lambda c: F.least(F.greatest(lag_months(c, F.col("cohort")), F.lit(0)), F.lit(ages))
    pays = links.where("tier <= 3").join(rebills.where(F.col("paid_day") <= end).select(F.col("claim").alias("r_claim"), "paid_day", F.col("paid").alias("amount")), "r_claim").join(known, "d_claim")
    back = F.when((F.col("reversed_day") <= end) & F.col("recouped"), F.struct(age(F.greatest("reversed_day", "paid_day")).alias("age"), (-F.col("amount")).alias("amount")))
    entries = pays.select("cohort", F.explode(F.array_compact(F.array(F.struct(age(F.col("paid_day")).alias("age"), F.col("amount").alias("amount")), back))).alias("e")).groupBy("cohort", "e.age").agg(F.sum("e.amount").alias("amount"))
    cohorts = known.groupBy("cohort").agg(F.sum("paid").alias("gross")).withColumn("age", F.explode(F.sequence(F.lit(0), F.least(F.lit(ages), lag_months(end, F.col("cohort"))))))
    w = Window.partitionBy("cohort").orderBy("age")
    return cohorts.join(entries, ["cohort", "age"], "left").select("cohort", "age", "gross", F.sum(F.coalesce("amount", F.lit(0).cast(MONEY))).over(w).alias("offset"))


def offset_development(triangle: DataFrame) -> DataFrame:
    """age, link (offsets at the next age over offsets at this one, of the cohorts that have seen both) and to_ultimate (the product of the links from here on); one row an age."""
    later = triangle.select("cohort", (F.col("age") - 1).alias("age"), F.col("offset").alias("next"))
    links = triangle.join(later, ["cohort", "age"]).groupBy("age").agg(F.sum("offset").alias("before"), F.sum("next").alias("after"))
    links = links.select("age", F.round(F.coalesce(ratio(F.col("after"), F.col("before")), F.lit(1.0)), 6).alias("link"))
    return links.withColumn("to_ultimate", F.round(F.product("link").over(Window.orderBy(F.desc("age")).rowsBetween(Window.unboundedPreceding, 0)), 6))


def developed_cohorts(triangle: DataFrame, development: DataFrame) -> DataFrame:
    """Each cohort at its last age: the observed offset ratio, the ratio developed to ultimate, the factor by which gross savings are stated net, and whether it is final."""
    last = triangle.groupBy("cohort").agg(F.max("age").alias("age"), F.max("gross").alias("gross"), F.max_by("offset", "age").alias("offset"))
    rows = last.join(development, "age", "left").withColumn("observed", F.round(ratio(F.col("offset"), F.col("gross")), 6))
    ultimate = F.round(ratio(F.col("offset"), F.col("gross")) * F.coalesce("to_ultimate", F.lit(1.0)), 6)
    return rows.select("cohort", "age", F.col("gross").cast("double").alias("gross"), "observed", ultimate.alias("ultimate"), F.round(1 - ultimate, 6).alias("nsaf"), F.col("to_ultimate").isNull().alias("final"))


def nsaf_by_class(classified: DataFrame, cohorts: DataFrame, strata: str = "line_of_business") -> DataFrame:
    """By stratum and class: claims, gross, the offset applied and its basis, and the stratum's offset ratio, matched ratio and net factor.

    Matched and overturned claims take their own payments, C the stratum's matched ratio, A its cohort's developed ratio, B nothing.
    """
    rate = cohorts.select("cohort", F.greatest("ultimate", F.lit(0.0)).alias("rate"))
    rows = classified.withColumn("cohort", F.trunc("day", "month")).groupBy(strata, "class", "cohort").agg(F.count(F.lit(1)).alias("n"), F.sum("gross").alias("gross"), F.sum("offset").alias("own"))
    rows = rows.join(rate, "cohort", "left").groupBy(strata, "class").agg(F.sum("n").alias("n_claims"), F.sum("gross").alias("gross"), F.sum("own").alias("own"), F.sum(F.round(F.col("gross") * F.coalesce("rate", F.lit(0.0)), 4).cast(MONEY)).alias("developed"))
    matched = rows.where("class = 'matched'").select(strata, ratio(F.col("own"), F.col("gross")).alias("matched_ratio"))
    rows = rows.join(matched, strata, "left")
    applied = F.when(F.col("class") == "C", F.round(F.col("gross") * F.coalesce("matched_ratio", F.lit(0.0)), 4).cast(MONEY)).when(F.col("class") == "A", F.col("developed")).otherwise(F.col("own"))
    rows = rows.withColumn("applied", applied.cast(MONEY))
    total = rows.groupBy(strata).agg(ratio(F.sum("applied"), F.sum("gross")).alias("offset_ratio"))
    basis = F.element_at(F.create_map(*[F.lit(x) for pair in CLASS_BASIS for x in pair]), F.col("class"))
    return rows.join(total, strata).select(
        strata,
        "class",
        "n_claims",
        F.col("gross").cast("double").alias("gross"),
        F.round(F.col("applied").cast("double"), 2).alias("offset"),
        basis.alias("basis"),
        F.round("matched_ratio", 6).alias("matched_ratio"),
        F.round("offset_ratio", 6).alias("offset_ratio"),
        F.round(1 - F.col("offset_ratio"), 6).alias("net_factor"),
    )


#: What the offset of each class rests on.
CLASS_BASIS = (("matched", "linked payments"), ("A", "developed"), ("B", "none"), ("C", "matched ratio"), ("D", "reversed"))


def allocation_weights(df: DataFrame, group: list[str], measure: str) -> DataFrame:
    """Weights that sum to one in each group; groups are totalled first and joined back."""
    total = df.groupBy(*group).agg(F.sum(measure).alias("_total"))
    return df.join(total, group).withColumn("weight", ratio(F.col(measure), F.col("_total"))).drop("_total")


def actual_vs_expected(actual: DataFrame, forecast: DataFrame, weights: DataFrame, period: list[str], dims: list[str]) -> DataFrame:
    """Forecast allocated by weight, against actuals: variance, ratio and per member, rolled up over ``dims``."""
    expected = allocate(forecast, weights, period, dims)
    both = actual.join(expected, [*period, *dims], "full_outer")
    rolled = both.rollup(*dims).agg(F.sum("actual").alias("a"), F.sum("expected").alias("e"), F.sum("member_months").alias("m"))
    a, e = F.coalesce("a", F.lit(0).cast(MONEY)), F.coalesce("e", F.lit(0).cast(MONEY))
    return rolled.select(
        *[F.coalesce(d, F.lit("all")).alias(d) for d in dims],
        F.round(a.cast("double"), 2).alias("actual"),
        F.round(e.cast("double"), 2).alias("expected"),
        F.round((a - e).cast("double"), 2).alias("variance"),
        F.round(ratio(a, e), 6).alias("ae_ratio"),
        F.round(ratio(a - e, F.col("m")), 4).alias("variance_per_member"),
    )


#: Benchmark percentage by cost quartile (lowest cost first), rebate share and quality factor by star rating (fixed values).
QUARTILE_PCT = ("1.150", "1.075", "1.000", "0.950")
REBATES = ((4.5, "0.70"), (3.5, "0.65"), (0.0, "0.50"))
BONUS = ((4.0, "1.05"), (0.0, "1.00"))


def _by_stars(c, table):
    out = None
    for least, v in table:
        out = F.when(c >= least, F.lit(Decimal(v))) if out is None else out.when(c >= least, F.lit(Decimal(v)))
    return out


def benchmark(base, quartile, stars):
    """Base cost times the quartile's percentage times the quality factor, rounded once to 4 places; exact on decimals."""
    pct = F.element_at(F.array(*[F.lit(Decimal(x)) for x in QUARTILE_PCT]), quartile)
    return F.round(base * pct * _by_stars(stars, BONUS), 4)


def ma_bid(plans: DataFrame) -> DataFrame:
    """county, base_cost, stars, bid, risk -> benchmark, savings, rebate and payment per member.

    The quartile ranks counties over the whole country: one row a county.
    """
    ranked = plans.withColumn("quartile", F.ntile(4).over(Window.orderBy("base_cost", "county")))
    return payment(ranked.withColumn("benchmark", benchmark(F.col("base_cost"), F.col("quartile"), F.col("stars"))))


def payment(df: DataFrame) -> DataFrame:
    gain = F.col("benchmark") - F.col("bid")
    savings = F.when(gain > 0, gain).otherwise(F.lit(0))
    out = df.withColumns({"savings": F.round(savings, 4), "rebate": F.round(savings * _by_stars(F.col("stars"), REBATES), 4)})
    return out.withColumn("payment", F.round((F.col("bid") + F.col("rebate")) * F.col("risk"), 2))


def medical_loss_ratio(plans: DataFrame, medical: str, revenue: str, floor: str = "0.85") -> DataFrame:
    """``plans`` with mlr (expected medical cost over revenue) and meets_floor."""
    mlr = F.round(ratio(F.col(medical), F.col(revenue)), 6)
    return plans.withColumns({"mlr": mlr, "meets_floor": mlr >= float(floor)})


def assert_rolls_up(expected: DataFrame, forecast: DataFrame, period: list[str], tolerance: float = 0.01) -> DataFrame:
    """``expected`` itself; raises if its total of a period is not the forecast's, or a period of the forecast has no allocation."""
    both = forecast.select(*period, "forecast").join(expected.groupBy(*period).agg(F.sum("expected").cast("double").alias("total")), period, "full_outer")
    gap = both.where(~(F.coalesce(F.abs(F.col("total") - F.col("forecast")), F.lit(float("inf"))) <= tolerance)).limit(5).collect()
    if gap:
        raise CheckFailed(f"allocation does not add up to the forecast: {[r.asDict() for r in gap]}")
    return expected


def allocate(forecast: DataFrame, weights: DataFrame, period: list[str], dims: list[str]) -> DataFrame:
    """The forecast of each period dealt out over ``dims`` by weight, checked against its total."""
    out = forecast.join(weights.select(*period, *dims, "weight"), period).select(*period, *dims, F.round(F.col("forecast") * F.col("weight"), 4).cast(MONEY).alias("expected"))
    return assert_rolls_up(out, forecast, period)
