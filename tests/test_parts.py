"""Operators that no query goes through: readers, sinks, gates, joins and small columns."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from actuspark.functions import derive, windows
from actuspark.operators import checks, frames
from actuspark.operators.titles import fuzzy_match
from actuspark.plans import claims, forecast, scenarios, seasonality, surveillance, text
from actuspark.sources import readers, sinks
from actuspark.streaming import increments

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_columns(spark):
    day = lambda s: F.lit(s).cast("date")
    got = one(
        spark,
        count=derive.count_from_rate(F.lit(120.0), F.lit(100)),
        source=derive.unit_source(ip=F.lit(0), op=F.lit(4), rx=F.lit(5)),
        floor=derive.floor_zero(F.lit(-2.0)),
        label=derive.label_or(F.lit(None).cast("string"), F.lit("ER"), F.lit("_X")),
        ytd=derive.ytd_flag(day("2024-02-01"), day("2024-03-01")),
        late=derive.ytd_flag(day("2024-04-01"), day("2024-03-01")),
        year=derive.measure_year(day("2024-07-01"), "2024-06-30"),
        number=derive.to_number(F.lit("1.5")),
        none=derive.to_number(F.lit("n/a")),
        month=derive.month_number(F.lit("march")),
        months=scenarios.n_train_months(day("2024-03-01"), day("2024-01-01")),
    )
    assert got[:] == (1.0, "op", 0.0, "ER_X", True, False, "Y2", 1.5, None, 3, 3)
    urls = ["https://www.youtube.com/watch?x=1&v=abcdefghi_-", "https://youtu.be/abcdefghi_-/x", "https://youtube.com/embed/abcdefghi_-", "abcdefghi_-", "https://example.com/?v=abcdefghi_-", "http://[bad", "", None]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "k int, u string")
    assert [r[0] for r in df.orderBy("k").select(derive.video_id(F.col("u"))).collect()] == ["abcdefghi_-"] * 4 + [None] * 4


def test_look_backs(spark):
    df = spark.createDataFrame([("a", 1, 4.0), ("a", 2, None), ("a", 3, 6.0)], "k string, m int, v double")
    w = windows.series(["k"], "m")
    got = df.withColumn("f", windows.ffill("v", w)).withColumns(windows.change_vs_prior("f", w)).orderBy("m").collect()
    assert [(r["f"], r["f_change"], r["f_change_pct"]) for r in got] == [(4.0, None, None), (4.0, 0.0, 0.0), (6.0, 2.0, 0.5)]


def test_readers(spark, tmp_path):
    for close, paid in (("202401", 5), ("202402", 7)):
        p = tmp_path / close
        p.mkdir()
        (p / f"clms_{close}.csv").write_text(f"incurred_year_month,plan_type,claim_type,plan_paid\n12/31/2023,HMO,IP,{paid}\n")
    got = readers.read_closes(spark, str(tmp_path), ["202401", "202402"])
    assert rows(got.select("close", "incurred_year_month", F.col("plan_paid").cast("int"))) == [(D(2024, 1, 31), D(2023, 12, 31), 5), (D(2024, 2, 29), D(2023, 12, 31), 7)]
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>One</title><pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate></item><item><title>Two</title><pubDate>x</pubDate></item></channel></rss>")
    feed = readers.read_feed(spark, str(tmp_path / "feed.xml"))
    assert [(r["title"], r["published"] and r["published"].isoformat()) for r in feed.orderBy("title").select("title", F.date_trunc("hour", "published").alias("published")).collect()][1] == ("Two", None)
    assert feed.where("published is not null").select(F.to_date("published")).first()[0] == D(2024, 1, 1)
    payload = json.dumps({"events": [{"segs": [{"utf8": "hello"}, {"utf8": "there"}]}, {}]})
    assert one(spark, t=readers.captions_to_text(F.lit(payload)))["t"] == "hello there"
    (tmp_path / "doc.txt").write_text("a\nb")
    assert readers.read_docs(spark, str(tmp_path / "doc.txt")).first()["text"] == "a\nb"
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "w.json").write_text(json.dumps({"data": [[1, [[2, [[3, [[4, []]]]]], [9, [[3, [[5, []]]]]]]]]}))
    regions = surveillance.flatten_regions(surveillance.read_surveillance(spark, str(tmp_path / "s")))
    assert rows(surveillance.by_lab_type(regions, 9).select("lab_type", "region")) == [(9, 5)]


def test_sinks_read_back(spark, tmp_path):
    df = spark.createDataFrame([("v1", "t1", "h1", 1), ("v1", "t1", "h2", 2)], "VAL_DATE string, TRAIN_END string, HCC string, n int")
    at = lambda n: str(tmp_path / n)
    sinks.write_scenario(df, at("s"))
    sinks.write_scenario(df.where("HCC = 'h2'").withColumn("n", F.lit(9)), at("s"))
    assert rows(spark.read.parquet(at("s")).select("HCC", "n")) == [("h1", 1), ("h2", 9)]
    sinks.overwrite_table(df, at("o"))
    sinks.overwrite_table(df.select("n"), at("o"))
    assert spark.read.parquet(at("o")).columns == ["n"]
    sinks.create_like(df, at("c"))
    assert spark.read.parquet(at("c")).schema == df.schema and spark.read.parquet(at("c")).isEmpty()
    sinks.publish_view(df, "published_rows")
    assert spark.table("published_rows").count() == 2
    assert {k for _, k in sinks.all_strings(df).dtypes} == {"string"}
    sinks.export_csv({"a": df.select("n"), "b": df.select("HCC")}, at("e"))
    back = spark.read.option("header", True).csv(at("e"))
    assert back.count() == 4 and {r["product"] for r in back.collect()} == {"a", "b"}
    header = spark.createDataFrame([(1, "x"), (2, "y")], "id int, title string")
    ranked = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "id int, rank int, name string")
    sinks.write_report_json(header, ranked, "id", ["rank"], at("j"))
    report = {r["id"]: r["rows"] for r in spark.read.json(at("j")).collect()}
    assert [(r["rank"], r["name"]) for r in report[1]] == [(1, "a"), (2, "b")] and report[2] is None


def test_closes_land_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("c1", 1), ("c2", 2)], "close string, n int").write.parquet(source)
    for _ in range(2):
        increments.land_closes(spark.readStream.schema("close string, n int").parquet(source), out, str(tmp_path / "check")).awaitTermination()
    spark.createDataFrame([("c2", 7)], "close string, n int").write.mode("append").parquet(source)
    increments.land_closes(spark.readStream.schema("close string, n int").parquet(source), out, str(tmp_path / "check")).awaitTermination()
    assert rows(spark.read.parquet(out).select("close", "n")) == [("c1", 1), ("c2", 7)]


def test_gates(spark):
    df = spark.createDataFrame([(D(2024, 1, k), v) for k, v in ((1, 1.0), (2, None), (3, 1.0))], "day date, v double")
    checks.assert_no_inflation(1.0, 1.005)
    checks.assert_rows(df)
    checks.assert_positive(df, "v")
    checks.assert_calendar(df, "day", "2024-01-01", "2024-01-03")
    for bad in (lambda: checks.assert_no_inflation(1.0, 1.02), lambda: checks.assert_rows(df.limit(0)), lambda: checks.assert_positive(df.withColumn("v", F.lit(0)), "v"), lambda: checks.assert_calendar(df, "day", "2024-01-01", "2024-01-04")):
        with pytest.raises(checks.CheckFailed):
            bad()
    assert checks.gate_output(df.withColumn("a", F.lit(1)), "v", "a").first()[:] == (3, 3, 0, 1)
    assert checks.inert(df, "v").first()["inert"] and not checks.inert(df.withColumn("v", F.lit(2.0)), "v").first()["inert"]


def test_joins_and_sums(spark):
    df = spark.createDataFrame([("a", "x", 1, 2.0), ("a", "y", 3, 2.0), ("b", "x", 5, 4.0)], "k string, s string, n int, c double")
    dim = spark.createDataFrame([("a", "Alpha")], "k string, label string")
    assert rows(frames.enrich(df.select("k", "n"), [(dim, ["k"])])) == [("a", 1, "Alpha"), ("a", 3, "Alpha"), ("b", 5, None)]
    assert {r["label"] for r in frames.decode(df, dim, "k", "label").collect()} == {"Alpha", "b"}
    assert frames.append(df.select("k"), df.select("n")).count() == 6
    assert rows(frames.dedup(df, ["k"], F.desc("n")).select("k", "n")) == [("a", 3), ("b", 5)]
    assert rows(frames.sum_numeric(df, ["k"])) == [("a", 4, 4.0), ("b", 5, 4.0)]
    buckets = frames.bucket_sums(df, ["k"], "n", {"x": F.col("s") == "x", "y": F.col("s") == "y"}).withColumn("t", F.col("x") + F.col("y"))
    assert rows(frames.shares(buckets, ["x"], "t").select("k", "x_share")) == [("a", 0.25), ("b", 1.0)]
    assert rows(frames.constant_in_group(df, ["k"], "c")) == [("a", 2.0), ("b", 4.0)]
    with pytest.raises(ValueError):
        frames.constant_in_group(df, ["k"], "n")
    wide = spark.createDataFrame([("a", 1.0, 2.0)], "k string, `1` double, `2` double")
    assert rows(frames.unpivot_months(wide, ["k"], ["1", "2"])) == [("a", "1", 1.0), ("a", "2", 2.0)]
    titles = spark.createDataFrame([("The Great Market Crash",), ("Market news, a great week",), ("Other",)], "title string")
    assert [r["tier"] for r in frames.search_titles(titles, "title", "great market").collect()] == [1]
    assert [r["tier"] for r in frames.search_titles(titles, "title", "week market").collect()] == [2]
    left = spark.createDataFrame([(1, "Great Market Crash!"), (2, "unlike anything")], "id int, a string")
    assert rows(fuzzy_match(left, titles, "a", "title").select("id", "title")) == [(1, "The Great Market Crash")]


def test_scenarios(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2023, 12, 1), "h1", 1), (D(2024, 2, 29), D(2023, 12, 1), "h1", 2)], "VAL_DATE date, TRAIN_END date, HCC string, n int")
    assert rows(scenarios.snapshot_slice(df, "2024-02-29").select("n")) == [(2,)]
    assert rows(scenarios.scenario(df, "2024-01-31", "2023-12-01", "h1").select("n")) == [(1,)] and scenarios.scenario(df, "2024-01-31", "2023-12-01", "h2").isEmpty()
    items = spark.createDataFrame([(1, "a", True), (2, "ad: b", True), (3, None, True), (4, "d", False)], "id int, title string, on boolean")
    assert [r["id"] for r in scenarios.latest_excluding(items, "title", ["^ad:"], 2, F.desc("id")).collect()] == [4, 3]
    assert rows(scenarios.latest_enabled(items.withColumn("g", F.lit(0)), ["g"], "on", 2, F.col("id")).select("id")) == [(1,), (2,)]
    factors = spark.createDataFrame([("a", "PMPM", 1.5), ("a", "UTIL", 0.5), ("b", "UTIL", 2.0)], "k string, metric string, factor double")
    assert rows(scenarios.join_factor(spark.createDataFrame([("a",), ("b",)], "k string"), factors, "PMPM", ["k"])) == [("a", 1.5), ("b", 1.0)]
    seg = spark.createDataFrame([("a", "OC"), ("a", "OHC")], "k string, SEGMENT string")
    assert rows(scenarios.lookup_segment(spark.createDataFrame([("a",), ("b",)], "k string"), seg, ["k"])) == [("a", "OC"), ("b", None)]
    assert rows(scenarios.combine_metrics(factors.where("metric = 'PMPM'").select("k", "factor"), factors.where("metric = 'UTIL'").select("k", F.col("factor").alias("u")), ["k"])) == [("a", 1.5, 0.5)]


def test_holdout_and_errors(spark):
    month = [(D(2024, k, 1), float(k), k + 1.0) for k in range(1, 7)]
    df = spark.createDataFrame(month, f"{forecast.MONTH} date, a double, p double")
    train, test = forecast.holdout(df, "2024-06-01", 2)
    assert (train.count(), test.count()) == (4, 2)
    got = forecast.holdout_metrics(df.withColumn("g", F.lit(1)), ["g"], "p", "a").first()
    assert (got["n"], got["rmse"], got["bias"]) == (6, 1.0, 1.0)
    assert forecast.intervals(df.withColumn("g", F.lit(1)), ["g"], "p", "a").first()[:] == (1, 6, -1.0, -1.0)
    from pyspark.ml.linalg import Vectors

    parts = forecast.attribute(spark.createDataFrame([(Vectors.dense(3.0, 5.0),)], ["features"]), [2.0, -1.0], [1.0, 1.0])
    assert parts.first()["contributions"] == [4.0, -4.0]


def test_shapes(spark):
    vectors = [(str(k), *[1.0 + (0.5 if (m < 6) == (k % 2 == 0) else 0.0) + 0.01 * k for m in range(12)]) for k in range(6)]
    df = spark.createDataFrame(vectors, "g string, " + ", ".join(f"`{m}` double" for m in seasonality.MONTHS))
    swept = seasonality.sweep_k(df, [2, 3])
    assert [k for k, _, _ in swept] == [2, 3] and swept[0][1] >= swept[1][1] and swept[0][2] > 0.9
    factors = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 3.0), ("c", 1, 2.0)], "g string, month int, factor double")
    clusters = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "g string, cluster int")
    assert rows(seasonality.cluster_median(factors, clusters, ["g"])) == [(0, 1, 2.0), (1, 1, 2.0)]
    line = spark.createDataFrame([("a", float(x), 2.0 * x + 1) for x in range(5)], "g string, x double, y double")
    assert rows(seasonality.residual_trend(line, ["g"], "x", "y")) == [("a", 2.0, 1.0)]
    grid = spark.createDataFrame([("a", D(2024, 1, 31), 1.0), ("a", D(2024, 2, 29), 2.0)], "k string, close date, v double")
    assert claims.pivot_reports(grid, ["k"], ("2024-01-31", "2024-02-29"), "v").first()[:] == ("a", 1.0, 2.0)
