"""Linkage, classes and development of net savings against loops and the method's worked figures."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from actuspark.plans import planning

D = dt.date
DENIAL = "claim string, ref int, member int, provider int, day date, line_of_business string, paid decimal(18,4), reversed_day date, recouped boolean"
REBILL = "claim string, ref int, member int, provider int, day date, line_of_business string, paid decimal(18,4), paid_day date"


def brute_links(denials, rebills, near=3, window=365):
    out = []
    for r, r_ref, r_m, r_p, r_day, *_ in rebills:
        gap = lambda d: (r_day - d[4]).days
        same = [d for d in denials if (d[2], d[3]) == (r_m, r_p)]
        close = [d for d in same if abs(gap(d)) <= near]
        tiers = [
            [d for d in denials if (d[1], d[3]) == (r_ref, r_p)],
            [d for d in same if gap(d) == 0],
            close if len(close) == 1 else [],
            [d for d in same if 0 <= gap(d) <= window],
        ]
        for tier, found in enumerate(tiers, 1):
            if found:
                best = min(found, key=lambda d: (abs(gap(d)), d[0]))
                out.append((r, best[0], tier, gap(best)))
                break
    return sorted(out)


def test_links_equal_loops_also_for_a_member_with_many_claims(spark):
    rnd = random.Random(3)
    who = lambda: (1, 1) if rnd.random() < 0.5 else (rnd.randint(2, 9), rnd.randint(1, 2))
    day = lambda: D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 1500))
    denials = [(f"d{n}", rnd.randint(1, 400), *who(), day(), "A", Decimal(n), None, None) for n in range(300)]
    rebills = [(f"r{n}", rnd.randint(200, 800), *who(), day(), "A", Decimal(n), None) for n in range(300)] + [("none", None, 77, 1, D(2021, 1, 1), "A", Decimal(1), None)]
    links = planning.link_rebills(spark.createDataFrame(denials, DENIAL), spark.createDataFrame(rebills, REBILL))
    got = sorted((r["r_claim"], r["d_claim"], r["tier"], r["days"]) for r in links.collect())
    assert got == brute_links(denials, rebills) and {t for *_, t, _ in got} == {1, 2, 3, 4}
    # No rebill offsets two denials.
    assert len({r for r, *_ in got}) == len(got)


def test_worked_cohort_of_500_recoveries(spark):
    """375 matched, 100 never rebilled, 25 rebilled but not linked for sure: offset ratio 28.8 %, factor 71.2 %."""
    old = D(2024, 1, 10)
    denials = [(f"d{n}", n, n, 1, old, "A", Decimal(20000), None, None) for n in range(500)]
    rebills = [(f"r{n}", n, n, 1, old, "A", Decimal(7200), D(2024, 3, 1)) for n in range(375)] + [(f"r{n}", -n, n, 1, D(2024, 5, 10), "A", Decimal(1), D(2024, 6, 1)) for n in range(375, 400)]
    d, r = spark.createDataFrame(denials, DENIAL), spark.createDataFrame(rebills, REBILL)
    links = planning.link_rebills(d, r)
    triangle = planning.offset_triangle(d, r, links, "2026-06-30")
    cohorts = planning.developed_cohorts(triangle, planning.offset_development(triangle))
    rows = {x["class"]: x for x in planning.nsaf_by_class(planning.classify(d, r, links, "2026-06-30"), cohorts).collect()}
    figures = {k: (x["n_claims"], x["gross"], x["offset"]) for k, x in rows.items()}
    assert figures == {"matched": (375, 7_500_000.0, 2_700_000.0), "B": (100, 2_000_000.0, 0.0), "C": (25, 500_000.0, 180_000.0)}
    assert {(x["matched_ratio"], x["offset_ratio"], x["net_factor"]) for x in rows.values()} == {(0.36, 0.288, 0.712)}


def test_classes_follow_the_day_of_sight(spark):
    d = spark.createDataFrame(
        [
            ("open", 1, 1, 1, D(2024, 5, 1), "A", Decimal(100), None, None),
            ("shut", 2, 2, 1, D(2023, 1, 1), "A", Decimal(100), None, None),
            ("back", 3, 3, 1, D(2023, 1, 1), "A", Decimal(100), D(2023, 6, 1), True),
            ("kept", 4, 4, 1, D(2023, 1, 1), "A", Decimal(100), D(2023, 6, 1), False),
            ("late", 5, 5, 1, D(2023, 1, 1), "A", Decimal(100), D(2030, 6, 1), True),
            ("next", 6, 6, 1, D(2025, 1, 1), "A", Decimal(100), None, None),
            ("loss", 7, 7, 1, D(2023, 1, 1), "A", Decimal(10), None, None),
        ],
        DENIAL,
    )
    r = spark.createDataFrame([(f"r{n}", n, n, 1, D(2023, 2, 1), "A", Decimal(30), D(2023, 3, 1) if n != 1 else D(2024, 9, 1)) for n in (1, 3, 4, 5, 7)], REBILL)
    links = planning.link_rebills(d, r)
    got = {x["claim"]: (x["class"], float(x["gross"]), float(x["offset"])) for x in planning.classify(d, r, links, "2024-06-30").collect()}
    assert got == {"open": ("A", 100, 0), "shut": ("B", 100, 0), "back": ("D", 0, 0), "kept": ("D", 0, 30), "late": ("matched", 100, 30), "loss": ("matched", 10, 30)}
    # The reversal is a negative entry at its age; a later look sees the payment that was still to come.
    tri = {(str(x["cohort"]), x["age"]): float(x["offset"]) for x in planning.offset_triangle(d, r, links, "2024-06-30").collect()}
    assert tri["2023-01-01", 2] == 120 and tri["2023-01-01", 5] == 90 and tri["2024-05-01", 1] == 0
    assert planning.classify(d, r, links, "2024-09-30").where("claim = 'open'").first()["class"] == "matched"


def test_worked_development_pattern(spark):
    """Ratios of 9.4, 20.5, 26.0, 28.3, 28.7 and 28.8 % by age give the factors 3.064, 1.405, 1.108, 1.018, 1.003 and develop 20.5 % to 28.8 %."""
    seen = ["94", "205", "260", "283", "287", "288"]
    full = [("old", k, Decimal(1000), Decimal(v)) for k, v in enumerate(seen)]
    young = [("young", k, Decimal(1000), Decimal(v)) for k, v in enumerate(seen[:2])]
    triangle = spark.createDataFrame(full + young, "cohort string, age int, gross decimal(18,4), offset decimal(18,4)")
    development = planning.offset_development(triangle)
    assert [round(r["to_ultimate"], 3) for r in development.orderBy("age").collect()] == [3.064, 1.405, 1.108, 1.018, 1.003]
    cohorts = {r["cohort"]: r for r in planning.developed_cohorts(triangle, development).collect()}
    assert (round(cohorts["young"]["ultimate"], 3), round(cohorts["young"]["nsaf"], 3), cohorts["young"]["final"], cohorts["old"]["final"]) == (0.288, 0.712, False, True)


def test_links_read_the_claims_few_times(spark):
    from actuspark.plans import queries

    plan = queries.QUERIES["l14_nsaf"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "l_returnflag" not in plan and spark.range(1).select(F.lit(1)).count() == 1


def test_all_tiers_take_two_shuffles(spark):
    """One by reference and one by member; no tier reads the claims again."""
    links = planning.link_rebills(spark.createDataFrame([], DENIAL), spark.createDataFrame([], REBILL))
    assert links._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_links_at_the_edges_of_windows_and_without_dates(spark):
    days = [-3, -2, 0, 1, 3, 4, 365, 366, 1457, 1460, 1463, 1825, 1826]
    rebills = [(f"r{n}-{k}", None if k % 3 else 7, n, 1, D(2018, 1, 1) + dt.timedelta(days=1460 * n % 4000 + k), "A", Decimal(1), None) for n in range(12) for k in days]
    denials = [(f"d{n}-{k}", 7 if n == 5 else -n, n, 1, D(2018, 1, 1) + dt.timedelta(days=1460 * n % 4000 + k), "A", Decimal(1), None, None) for n in range(12) for k in (0, 1460)]
    links = planning.link_rebills(spark.createDataFrame([*denials, ("no day", 7, 5, 1, None, "A", Decimal(1), None, None)], DENIAL), spark.createDataFrame([*rebills, ("undated", 7, 5, 1, None, "A", Decimal(1), None)], REBILL))
    assert sorted((r["r_claim"], r["d_claim"], r["tier"], r["days"]) for r in links.collect()) == brute_links([d for d in denials], rebills)
