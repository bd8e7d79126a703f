import pytest
from pyspark.sql import functions as F

from harvestry.llm.survivors import LEVEL, ORDER_HALF_LIFE, ORDER_MISSING, elect, unpivot, weighted_votes


def test_highest_sum_of_votes_wins_and_ties_go_to_the_first_row(spark):
    rows = [("p", "title", "A  b", 1, 1.0, 0.0), ("p", "title", "a B", 2, 1.0, 0.0), ("p", "title", "C", 3, 1.9, 0.0), ("p", "date", "x", 1, 1.0, 365.0), ("p", "date", "y", 2, 0.6, 0.0), ("q", "title", "m", 5, 1.0, 0.0), ("q", "title", "n", 4, 1.0, 0.0)]
    long = spark.createDataFrame([(*r, 0) for r in rows], "page string, field string, value string, row bigint, trust double, age_days double, tie bigint")
    out = {r.page: r for r in elect(weighted_votes(long, ["page"]), ["page"], ["title", "date"]).collect()}
    assert out["p"].title == "A  b" and out["p"].date == "y"
    assert out["q"].title == "n" and out["q"].date is None


def test_unpivot_and_elect_with_nulls_repeats_and_hot_group(spark):
    rows = [("hot", i, float(i % 97)) for i in range(3000)] + [("one", 1, 1.0), (None, 2, 1.0), ("none", 3, None), ("one", 1, 1.0)]
    df = spark.createDataFrame(rows, "page string, seq bigint, x double")
    trust, none = F.coalesce("x", F.lit(0.0)), F.lit(0)
    long = unpivot(df, ["page"], "seq", {"most": (F.col("x").isNotNull(), F.col("seq"), trust, none, none), "any": (F.lit(True), F.lit("same"), trust, none, none)})
    out = {r.page: (r.most, r.any) for r in elect(weighted_votes(long, ["page"]), ["page"], ["most", "any"], F.lit("0")).collect()}
    assert out == {"hot": ("96", "same"), "one": ("1", "same"), None: ("2", "same"), "none": ("0", "same")}
    assert elect(weighted_votes(long.filter("false"), ["page"]), ["page"], ["most"]).count() == 0


def test_levels_of_trust_keep_a_stated_order(spark):
    """Of any two rows the one with the higher level wins, however old; within a level the later one, to the second, none last."""
    days = [None, 0.0, 1.0, 1.0 - 1 / 86400, 36525.0, 69000.0]
    rows = [("p", "f", str(i * 10 + j), i * 10 + j, LEVEL**i, ORDER_MISSING if d is None else d, 0) for i in (0, 1, 11, 23) for j, d in enumerate(days)]
    for k in range(1, len(rows)):
        long = spark.createDataFrame([rows[k], rows[k - 1]], "page string, field string, value string, row bigint, trust double, age_days double, tie bigint")
        better = max(rows[k - 1 : k + 1], key=lambda r: (r[4], -r[5]))
        assert elect(weighted_votes(long, ["page"], ORDER_HALF_LIFE), ["page"], ["f"]).first().f == better[2]


@pytest.mark.parametrize("query", ["p2_found", "p2_records"])
def test_queries_give_one_row_per_page(spark, small, query):
    from harvestry.llm import survivors

    df = survivors.QUERIES[query](spark, small)
    key = df.columns[0] if query == "p2_found" else "page_key"
    assert df.count() == df.select(key, *([] if query == "p2_found" else ["page_rollup"])).distinct().count() > 0
