from pyspark.sql import functions as F

from harvestry.operators.deliveries import keep_one_delivery, post_key, repeated_deliveries

ROWS = [
    (1, "https://a.example/x", "20200102", "late"),
    (2, " https://a.example/x\n", "20200101", "early"),
    (3, "https://archive.example/web/20200101000000id_/https://a.example/x", "20200101", "tie"),
    (4, None, "20200101", "no post"),
    (5, "https://a.example/y", None, "no time"),
    (6, "https://a.example/y", "20990101", "has time"),
    (7, "http://archive.example/web/2020/http://archive.example/web/2021/https://a.example/z", None, "twice wrapped"),
    (8, "https://a.example/archive/x", None, "an archive folder is no archive"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "seq bigint, url string, at string, post string")


def kept(df):
    return sorted(r.seq for r in keep_one_delivery(df, post_key(F.col("url")), F.col("at"), "seq").collect())


def test_earliest_delivery_stays(spark):
    df = frame(spark)
    assert kept(df) == [2, 6, 7, 8]
    assert sorted(r.seq for r in repeated_deliveries(df, post_key(F.col("url")), F.col("at"), "seq").collect()) == [1, 3, 5]


def test_other_columns_stay_even_with_clashing_names(spark):
    out = keep_one_delivery(frame(spark), post_key(F.col("url")), F.col("at"), "seq")
    assert out.columns == ["seq", "url", "at", "post"]
    dropped = repeated_deliveries(frame(spark), post_key(F.col("url")), F.col("at"), "seq")
    assert dropped.columns == ["seq", "url", "at", "post"]


def test_empty_table(spark):
    assert kept(frame(spark, [])) == []


def test_hot_post_and_brute_force(spark):
    rows = [(i, "https://a.example/hot" if i % 3 else f"https://a.example/{i % 50}", str(20200000 + (i * 7919) % 100), "") for i in range(3000)]
    best = {}
    for seq, url, at, _ in rows:
        best[url] = min(best.get(url, (at, seq)), (at, seq))
    assert kept(frame(spark, rows)) == sorted(s for _, s in best.values())


def test_very_long_url(spark):
    long = "https://a.example/" + "x" * 200_000
    assert kept(frame(spark, [(1, long, "2", ""), (2, long + " ", "1", "")])) == [2]
