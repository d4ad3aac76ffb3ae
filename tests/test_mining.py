from mentionlake.operators import mining


def posts(spark, rows):
    return spark.createDataFrame(rows, "title string, selftext string, created_utc timestamp")


def test_counts_over_posts_and_comments(spark):
    from datetime import datetime

    new, old = datetime(2023, 1, 1), datetime(2019, 12, 31, 23, 59)
    comments = spark.createDataFrame(
        [("buy $gme GME", new), ("[removed]", new), (None, new), ("$old OLD", old), ("AAPL GME", new)],
        "body string, created_utc timestamp",
    )
    texts = posts(spark, [("$GME", None, new), (None, "hold ABC", new), ("XY", "z", old)])
    known = spark.createDataFrame([("AAPL",)], "symbol string")
    got = mining.mine_tokens(comments, texts, known, min_count=1)
    assert [tuple(r) for r in got.collect()] == [
        # $GME counts as a cashtag and as an all-caps word
        ("GME", 2, 3, 5, "cashtag+allcaps", "review"),
        ("ABC", 0, 1, 1, "allcaps", "review"),
    ]
    assert mining.mine_tokens(comments, texts, known, min_count=6).count() == 0


def test_one_lower_case_letter_tag(spark):
    from datetime import datetime

    texts = posts(spark, [("$f $F", "$toolong", datetime(2023, 1, 1))])
    none = spark.createDataFrame([], "body string, created_utc timestamp")
    known = spark.createDataFrame([], "symbol string")
    got = mining.mine_tokens(none, texts, known, min_count=1).collect()
    assert [tuple(r)[:4] for r in got] == [("F", 2, 0, 2)]
