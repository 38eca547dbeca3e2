"""Goldens and invariants of the health-cost plans, and every SQL against its query on the smallest tables."""

import datetime as dt
import json
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from actuspark.functions import derive, windows
from actuspark.operators import checks, frames
from actuspark.plans import calendar_index, forecast, planning, queries, seasonality, surveillance, text
from actuspark.plans.oracles import ORACLE_SQL
from actuspark.sources import sinks, versions

SF = "/root/testdata/sf0.001"
D = dt.date


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_scalars(spark):
    day = lambda s: F.lit(s).cast("date")
    got = one(
        spark,
        rate=derive.rate_per_k(F.lit(3), F.lit(0)),
        pmpm=derive.pmpm(F.lit(10.0), F.lit(4)),
        cat=derive.collapse_category(F.lit("PH")),
        unit=derive.first_positive(F.lit(0.0), F.lit(2.0), F.lit(3.0)),
        none=derive.first_positive(F.lit(0.0), F.lit(None).cast("double")),
        month=derive.yyyymm_to_date(F.lit(202402)),
        quarter=derive.quarter_label(day("2024-05-09")),
        lag=derive.lag_months(day("2025-01-31"), day("2024-11-30")),
        cap=derive.cap_lag(F.lit(24)),
        rep=derive.reportable_month(day("2025-01-31")),
        snap=derive.snap_zero(F.lit(1e-12)),
        clip=derive.clip(F.lit(None).cast("double")),
        cut=derive.truncate(F.lit("abcdef"), 3),
        rank=derive.category_rank(F.lit("Non-IP"), ["IP", "Non-IP"]),
    )
    assert (got["rate"], got["pmpm"], got["cat"], got["unit"], got["none"]) == (None, 2.5, "PHYSICIAN", 2.0, None)
    assert (got["month"], got["quarter"], got["lag"], got["cap"], got["rep"]) == (D(2024, 2, 1), "2024Q2", 2, 23, D(2024, 11, 30))
    assert (got["snap"], got["clip"], got["cut"], got["rank"]) == (0.0, 1.0, "abc...", 1)


def test_windows_look_back_only(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([0, 2, 4, 0, 8, 10])], "k string, m int, v double").withColumn("pos", F.col("m") + 1)
    w = windows.series(["k"], "m")
    rows = df.select("m", windows.roll_mean("v", w).alias("mean"), windows.roll_zeros("v", w).alias("zeros"), windows.roll_slope("v", "pos", w).alias("slope"), windows.rolling_quarter("v", w).alias("q"), windows.roll_var("v", w).alias("var")).orderBy("m").collect()
    assert [r["mean"] for r in rows[:4]] == [None, None, None, 2.0]
    assert rows[4]["zeros"] == 2 and rows[3]["slope"] == 2.0 and rows[3]["var"] == 4.0
    assert [r["q"] for r in rows] == [None, None, 6.0, 6.0, 12.0, 18.0]


def test_densify_and_its_totals(spark):
    facts = spark.createDataFrame([("a", "x", D(2024, 1, 1), 5), ("a", "x", D(2024, 3, 1), 7), ("b", "y", D(2024, 1, 1), 9)], "e string, s string, m date, v int")
    exposure = spark.createDataFrame([("a", D(2024, k, 1), 10) for k in (1, 2, 3, 4)], "e string, m date, mm int")
    dense = frames.densify(facts, exposure, ["e", "s"], ["e"], "m", ["v"])
    assert sorted((r["m"].month, r["v"]) for r in dense.collect()) == [(1, 5), (2, 0), (3, 7)]
    assert frames.orphans(facts, exposure, ["e", "m"]).count() == 1
    checks.assert_unique(dense, ["e", "s", "m"])
    with pytest.raises(checks.CheckFailed):
        checks.assert_tie(10.0, 11.0)
    with pytest.raises(ValueError):
        frames.assert_unique_right(facts, ["e"])


def test_relativities_average_to_one(spark):
    fact = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i), float(100 + 13 * (i % 7))) for i in range(70)] + [(D(2024, 1, 2), -5.0), (D(2024, 1, 2), None), (D(2030, 1, 1), 4.0)], "d date, v double")
    rel = calendar_index.relativities(calendar_index.valid_amounts(fact, "d", "v", "2024-01-01", "2024-12-31"))
    assert checks.check_relativities(rel).first()[:] == (7, 1.0)
    feb = calendar_index.monthly(rel, "2023-02-01", "2023-02-28").first()
    assert feb["total_days"] == 28 and abs(feb["wcd_index"] - 1) < 1e-6


def test_documented_goldens(spark):
    bid = planning.payment(spark.createDataFrame([(1050.0, 950.0, 4.5, 1.15)], "benchmark double, bid double, stars double, risk double")).first()
    assert round(bid["payment"]) == 1173
    denials = spark.createDataFrame([("d1", 1, 1, 1, D(2024, 1, 1), "A", 24500.0)], "claim string, ref int, member int, provider int, day date, line_of_business string, paid double")
    rebills = spark.createDataFrame([("r1", 1, 1, 1, D(2024, 2, 1), "A", 7350.0)], denials.schema)
    got = planning.nsaf(denials, rebills, planning.link_rebills(denials, rebills)).where("line_of_business = 'A'").first()
    assert got["gross"] - got["offset"] == 17150 and got["offset_ratio"] == 0.3


def test_tiers_of_linkage(spark):
    kind = "claim string, ref int, member int, provider int, day date, line_of_business string, paid double"
    d = spark.createDataFrame([("d1", 1, 1, 1, D(2024, 1, 1), "A", 1.0), ("d2", 2, 2, 1, D(2024, 1, 1), "A", 1.0), ("d3", 3, 3, 1, D(2024, 1, 1), "A", 1.0), ("d4", 4, 4, 1, D(2024, 1, 1), "A", 1.0)], kind)
    r = spark.createDataFrame([("r1", 1, 9, 1, D(2024, 6, 1), "A", 1.0), ("r2", 90, 2, 1, D(2024, 1, 1), "A", 1.0), ("r3", 91, 3, 1, D(2024, 1, 3), "A", 1.0), ("r4", 92, 4, 1, D(2024, 12, 1), "A", 1.0), ("r5", 93, 5, 1, D(2024, 1, 1), "A", 1.0)], kind)
    assert sorted((x["r_claim"], x["d_claim"], x["tier"]) for x in planning.link_rebills(d, r).collect()) == [("r1", "d1", 1), ("r2", "d2", 2), ("r3", "d3", 3), ("r4", "d4", 4)]


def test_attribution_adds_up(spark):
    df = spark.createDataFrame([(1.0, 3.0, 90.0, 2.0), (1.0, -1.0, 9.0, 1.0)], "a double, b double, pred double, base double")
    rows = forecast.rescale_attribution(df, ["a", "b"], "pred", "base").select("*", F.exp("base").alias("x")).collect()
    assert abs(rows[0]["a_units"] + rows[0]["b_units"] - (90 - rows[0]["x"])) < 1e-9 and rows[1]["a_units"] is None


def test_friedman_statistic(spark):
    rows = [("g", b, t, float(v)) for b, vs in enumerate([(1, 2, 3), (1, 3, 2), (1, 2, 3)]) for t, v in enumerate(vs)]
    assert seasonality.friedman(spark.createDataFrame(rows, "g string, b int, t int, v double"), "g", "b", "t", "v").first()["statistic"] == 4.6667


def test_surveillance_pads_short_arrays(spark):
    payload = json.dumps({"data": [[1, [[2, [[3, [[4, [[5, 10, 2, 7]], 9.5], [6, []]]]]]]]]})
    regions = surveillance.flatten_regions(spark.createDataFrame([(payload,)], "payload string"))
    got = sorted((r["region"], r["m2"], r["m10"]) for r in regions.collect())
    assert got == [(4, 9.5, None), (6, None, None)]
    virus = surveillance.flatten_viruses(regions).where("virus is not null").first()
    assert (virus["week"], virus["virus"], virus["cumulative"], virus["n"]) == (1, 5, 10, 7)


def test_sinks_are_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "VAL_DATE string, v int")
    for _ in range(2):
        sinks.write_slice(df, str(tmp_path / "t"))
    sinks.write_slice(df.where("VAL_DATE = 'a'").withColumn("v", F.lit(9)), str(tmp_path / "t"))
    assert sorted((r["VAL_DATE"], r["v"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("a", 9), ("b", 2)]
    legacy = df.select("v")
    legacy.write.parquet(str(tmp_path / "w"))
    rows = df.selectExpr("VAL_DATE", "'2000-12-01' AS TRAIN_END", "'A' AS HCC", "v")
    for part in (rows, rows.where("v = 1").withColumn("v", F.lit(7))):
        sinks.write_scenario(part, str(tmp_path / "w"))
    assert sorted(r["v"] for r in spark.read.parquet(str(tmp_path / "w")).collect()) == [2, 7]


def test_versions_are_published_whole(spark, tmp_path):
    df = spark.createDataFrame([("2000-01-01", 1, "a"), ("2000-02-01", 1, "b"), ("2000-02-01", None, "c")], "VAL_DATE string, id int, v string").withColumn("VAL_DATE", F.col("VAL_DATE").cast("date"))
    table = versions.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.replace(df)
    before = table.slices()
    rows = lambda: sorted(((str(r["VAL_DATE"]), r["id"], r["v"]) for r in table.read().collect()), key=str)
    table.upsert(df.where("VAL_DATE = '2000-02-01'").selectExpr("VAL_DATE", "id", "'new' AS v").unionByName(df.limit(1).selectExpr("date'2000-02-01' AS VAL_DATE", "5 AS id", "'more' AS v")), ["id"])
    want = [("2000-01-01", 1, "a"), ("2000-02-01", 1, "new"), ("2000-02-01", 5, "more"), ("2000-02-01", None, "new")]
    assert rows() == sorted(want, key=str)
    # The slice that was not touched is still the first version's, and a reader of one slice lists one folder.
    assert table.slices()["VAL_DATE=2000-01-01"] == before["VAL_DATE=2000-01-01"] != table.slices()["VAL_DATE=2000-02-01"]
    assert len(table.read().where("VAL_DATE = date'2000-01-01'").inputFiles()) >= 1
    with pytest.raises(Exception):
        table.replace(df.withColumn("v", F.raise_error(F.lit("no"))))
    assert rows() == sorted(want, key=str)


def test_the_monthly_table_is_built_once_and_read(spark, tmp_path):
    import shutil

    own = str(tmp_path / "sf")
    shutil.copytree(SF, own)
    os.chmod(own, 0o755)
    plan = lambda df: df._jdf.queryExecution().toString()
    for name in ("l04_signals", "l06_final_output", "l07_seasonality", "l16_actual_vs_expected", "k12_backtest", "d13_flat_series"):
        assert "lineitem" not in plan(queries.QUERIES[name](spark, own)).lower()
    first = queries._dense(spark, own).inputFiles()
    assert queries._dense(spark, own).inputFiles() == first
    os.remove(f"{own}/nation.parquet")
    shutil.copyfile(f"{SF}/nation.parquet", f"{own}/nation.parquet")
    os.utime(f"{own}/nation.parquet", (1, 1))
    assert queries._dense(spark, own).inputFiles() != first


def test_text(spark):
    got = one(spark, t=text.html_to_text(F.lit("<p>a &amp; b</p><script>x<y</script><b>c</b>")), n=text.word_count(F.lit("  a b ")))
    assert (got["t"], got["n"]) == ("a & b c", 2)
    docs = spark.createDataFrame([(1, "One two three four five six seven. Short one. Alpha beta gamma delta epsilon zeta eta theta!"), (2, None)], "doc_id int, text string")
    assert [r["pos"] for r in text.sentences(docs, "doc_id", "text").collect()] == [0, 2]


def test_page_text_is_whole(spark):
    rows = queries.m01_page_text(spark, SF).collect()
    assert rows and all(len(r["text"]) == r["n_chars"] and r["text"].startswith(r["head"]) for r in rows) and max(r["n_chars"] for r in rows) > 80


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def _rows(cols, rows):
    """Rows by column name, in an order that does not hang on the last place of a double."""
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    fix = lambda v: None if isinstance(v, float) and v != v else v
    key = lambda r: ([str(v) for v in r if not isinstance(v, float)], [f"{v:.2f}" for v in r if isinstance(v, float)])
    return sorted(cols), sorted((tuple(fix(r[k]) for k in order) for r in rows), key=key)


def _same(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6) if isinstance(a, float) and isinstance(b, float) else a == b


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, views, name):
    df = queries.QUERIES[name](spark, SF)
    want = views.sql(ORACLE_SQL[name])
    mine, theirs = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(want.columns, want.fetchall())
    assert mine[0] == theirs[0] and len(mine[1]) == len(theirs[1]) > 0
    assert [(x, y) for x, y in zip(mine[1], theirs[1], strict=True) if not all(map(_same, x, y))] == []


def test_entry(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 24


def test_the_quality_bonus_multiplies_the_quartile_percentage(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    row = spark.createDataFrame([(Decimal("1000.00"), 1, 4.0), (Decimal("1000.00"), 4, 3.5)], "base decimal(12,2), q int, stars double")
    got = [str(r[0]) for r in row.select(planning.benchmark(F.col("base"), F.col("q"), F.col("stars"))).collect()]
    assert got == ["1207.5000", "950.0000"]


def test_the_monthly_table_reads_the_lines_once(spark):
    """Its bounds, splits and amounts come from the stored monthly claims, its exposure from the orders."""
    plan = queries.QUERIES["l02_completed_combined"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "l_extendedprice" not in plan and "o_custkey" in plan
