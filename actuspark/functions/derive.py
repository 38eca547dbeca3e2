"""Scalar columns that the health-cost plans share. Divisions by zero or null give null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
#: Spellings of a service category (fixed values).
CATEGORIES = {"IP": "INPATIENT", "INPATIENT": "INPATIENT", "PH": "PHYSICIAN", "RX": "PHARMACY"}
DUAL_PLANS = ("MA DSNP",)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def rate_per_k(util: Column, mm: Column) -> Column:
    """Units per thousand members and year."""
    return ratio(util.cast("double") * 12000, mm)


def pmpm(paid: Column, mm: Column) -> Column:
    return ratio(paid, mm)


def unit_cost(paid: Column, util: Column) -> Column:
    return ratio(paid, util)


def count_from_rate(rate: Column, mm: Column, base: int = 12000) -> Column:
    return rate * mm / base


def collapse_category(c: Column) -> Column:
    out = c
    for k, v in CATEGORIES.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def is_dual(plan: Column) -> Column:
    return F.when(plan.isin(*DUAL_PLANS), 1).otherwise(0)


def first_positive(*cols: Column) -> Column:
    return F.coalesce(*[F.when(c > 0, c) for c in cols])


def unit_source(**cols: Column) -> Column:
    """The name of the column that ``first_positive`` takes."""
    return F.coalesce(*[F.when(c > 0, F.lit(n)) for n, c in cols.items()])


def yyyymm_to_date(c: Column) -> Column:
    s = c.cast("string")
    return F.make_date(F.substring(s, 1, 4).cast("int"), F.substring(s, 5, 2).cast("int"), F.lit(1))


def quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def snap_zero(c: Column, eps: float = 1e-9) -> Column:
    return F.when(F.abs(c) < eps, 0.0).otherwise(c)


def floor_zero(c: Column) -> Column:
    return F.when(c < 0, 0.0).otherwise(c)


def clip(c: Column, lo: float = 0.5, hi: float = 2.0, default: float = 1.0) -> Column:
    return F.least(F.greatest(F.coalesce(c, F.lit(default)), F.lit(lo)), F.lit(hi))


def label_or(c: Column, *fallback: Column) -> Column:
    return F.coalesce(c, F.concat(*fallback))


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def lag_months(close: Column, incurred: Column) -> Column:
    """Whole months, whatever the days."""
    return month_index(close) - month_index(incurred)


def cap_lag(lag: Column, most: int = 23) -> Column:
    return F.least(lag, F.lit(most))


def reportable_month(close: Column) -> Column:
    """The last incurred month that a close reports: the end of the month two before."""
    return F.last_day(F.add_months(close, -2))


def ytd_flag(month: Column, cutoff: Column) -> Column:
    return (F.year(month) == F.year(cutoff)) & (month <= cutoff)


def segment_label(*parts: Column) -> Column:
    return F.concat_ws(" / ", *parts)


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def measure_year(d: Column, cut: str) -> Column:
    return F.when(d <= F.lit(cut).cast("date"), "Y1").otherwise("Y2")


def truncate(c: Column, n: int, mark: str = "...") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(mark))).otherwise(c)


def category_rank(c: Column, order: list[str]) -> Column:
    return reduce(lambda out, kv: F.when(c == kv[1], kv[0]).otherwise(out), enumerate(order), F.lit(len(order)))


def to_number(c: Column, kind: str = "double") -> Column:
    """Null where the text is no number."""
    return c.try_cast(kind)


def weighted_mean(num: Column, den: Column) -> Column:
    """An aggregate: the sum of ``num`` over the sum of ``den``."""
    return ratio(F.sum(num), F.sum(den))


def approx_median(c: Column, exact: bool = False) -> Column:
    return F.median(c) if exact else F.percentile_approx(c, 0.5)


def video_id(url: Column) -> Column:
    """The eleven-character id of a video link (query, short link or embedded), or of a bare id; else null."""
    host, path, query = (F.coalesce(F.try_parse_url(url, F.lit(p)), F.lit("")) for p in ("HOST", "PATH", "QUERY"))
    first = lambda c, pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    short = F.when(host.endswith("youtu.be"), first(path, r"^/([\w-]{11})(?:/|$)"))
    full = F.when(host.contains("youtube.com"), F.coalesce(first(query, r"(?:^|&)v=([\w-]{11})(?:&|$)"), first(path, r"/(?:embed|shorts|live)/([\w-]{11})")))
    return F.coalesce(short, full, first(url, r"^([\w-]{11})$"))


def month_number(name: Column) -> Column:
    """1 to 12 of an English month name; null for other texts."""
    return F.month(F.try_to_date(F.concat(F.lit("2000 "), F.initcap(name)), "yyyy MMMM"))


def chi_square_tail(x: Column, degrees: Column) -> Column:
    """The probability that a chi-square variable of ``degrees`` exceeds ``x``: one minus the regularised incomplete gamma function, by its series of positive terms."""
    a, h = degrees.cast("double") / 2, x.cast("double") / 2
    # ln of Gamma(a + 1): a (a - 1) ... down to 1, or to 1/2 and the root of pi.
    log_gamma = F.aggregate(F.sequence(F.lit(0), F.ceil(a).cast("int") - 1), F.when(degrees % 2 == 1, F.log(F.sqrt(F.pi()))).otherwise(F.lit(0.0)), lambda s, i: s + F.log(a - i))
    first = F.exp(a * F.log(h) - h - log_gamma)
    start = F.struct(first.alias("term"), first.alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(400)), start, lambda s, n: F.struct((s["term"] * h / (a + n)).alias("term"), (s["sum"] + s["term"] * h / (a + n)).alias("sum")))["sum"]
    return F.when(h <= 0, F.lit(1.0)).when(h > 250, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - series))
