import datetime

from pyspark.sql import functions as F

from tripweave.operators import visitors

DAY = datetime.date


def daily(spark):
    return spark.createDataFrame(
        [
            ("11110", DAY(2025, 1, 1), 1, 100.5), (" 11110", DAY(2025, 1, 2), 1, 50.25), ("11110", DAY(2025, 1, 1), 2, 30.0),
            ("11110", DAY(2025, 1, 1), 9, 999.0), ("99999", DAY(2025, 1, 1), 1, 7.0), ("22220", DAY(2025, 2, 1), 9, 5.0),
        ],
        "signgu_code string, date date, tou_div_cd int, tou_num double",
    )


def districts(spark):
    return spark.createDataFrame([("11110", "A", "P"), ("22220", "B", "P")], "code string, city_name_en string, province_id string")


def test_monthly_and_annual(spark):
    mapped = visitors.daily_by_city(daily(spark), districts(spark))
    dense = visitors.dense_statistics(mapped)
    assert dense.count() == 24
    jan = dense.where("city_name_en = 'A' AND month = '2025-01'").first()
    assert (jan["days"], jan["locals_total"], jan["locals_daily_avg"], jan["out_of_town_total"], jan["out_of_town_daily_avg"]) == (31, 150.75, 4.86, 30.0, 0.97)
    assert (jan["foreigners_total"], jan["total_visitors"], jan["total_daily_avg"]) == (0.0, 180.75, 5.83)
    assert dense.where("city_name_en = 'A' AND month <> '2025-01'").agg(F.sum("total_visitors")).first()[0] == 0.0
    annual = visitors.annual_statistics(dense).where("city_name_en = 'A'").first()
    assert (annual["days"], annual["total_visitors"], annual["total_visitors_daily_avg"]) == (365, 180.75, 0.5)
    # Only months with a known segment without the calendar.
    assert [r["month"] for r in visitors.monthly_statistics(mapped).collect()] == ["2025-01"]
    nested = visitors.statistics_envelope(dense).where("city_name_en = 'A'").first()
    assert len(nested["monthly_statistics"]) == 12 and nested["annual_daily_averages"]["total_visitors"] == 0.5


def test_resume_and_replace(spark):
    mapped = visitors.daily_by_city(daily(spark), districts(spark))
    stored = visitors.dense_statistics(mapped.where("city_name_en = 'A'"))
    assert {r[0] for r in visitors.skip_complete(mapped, stored).select("city_name_en").collect()} == {"B"}
    partial = stored.where("month < '2025-06'")
    assert {r[0] for r in visitors.skip_complete(mapped, partial).select("city_name_en").collect()} == {"A", "B"}
    merged = visitors.replace_statistics(stored, visitors.dense_statistics(mapped.where("city_name_en = 'B'")))
    assert merged.groupBy("city_name_en").count().count() == 2


def test_final_merge(spark):
    cities = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("", "z", 3), ("C", "w", 4)], "city_name_en string, title string, pos int")
    stats = spark.createDataFrame([("A", 2025), ("B", 2025)], "city_name_en string, year int")
    final = visitors.final_cities(visitors.last_city_per_name(cities, "pos"), stats)
    out = {r["city_name_en"]: r for r in final.collect()}
    assert out["A"]["outcome"] == "merged" and out["A"]["meta"]["title"] == "y"
    assert out["B"]["meta_note"].startswith("Wikipedia metadata") and out["B"]["meta"] is None
    assert out["C"]["statistics_status"] == "incomplete"
    assert visitors.merge_outcomes(final).first().asDict() == {"merged_count": 1, "wikipedia_only_count": 1, "visitor_only_count": 1, "total": 3}


def test_hot_city_is_pre_aggregated(spark):
    feed = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("city_name_en"),
        F.lit(DAY(2025, 3, 1)).alias("date"), F.lit(1).alias("tou_div_cd"), F.lit(0.1).alias("tou_num"),
    )
    sums = visitors.monthly_sums(feed)
    assert sums.where("city_name_en = 'HOT'").first()["locals"] == 1000
    assert "partial_sum" in sums._jdf.queryExecution().executedPlan().toString()
