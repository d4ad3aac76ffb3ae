import pytest

from mentionlake.operators import classify as cl, hits, promote as pr
from mentionlake.sources import candidates as files

COUNTS = "symbol string, cashtag_count long, allcaps_count long, total_count long, evidence string"
STOPLIST = ["MOON", "BECKY", "TSLAQ", "BABY", "IT"]


@pytest.fixture(scope="module")
def lists(spark):
    equity = spark.createDataFrame(
        [("PEAR", "sec_company_tickers", "Pear", "NYSE"), ("IT", "wayback_2020_nasdaqlisted", "Info Tech", None),
         ("Q", "sec_company_tickers", "Quick", None)],
        "symbol string, source string, name string, exchange string",
    )
    return {
        "equity": hits.symbol_hits(hits.merge_hits(equity)),
        "sec": hits.symbol_hits(hits.merge_hits(spark.createDataFrame(
            [("OTCX", "sec_exchange:OTC", "Otc X", "OTC")],
            "symbol string, source string, name string, exchange string"))),
        "coins": hits.first_names(spark.createDataFrame([("DOGE", "Dogecoin"), ("DOGE", "Another")], "symbol string, name string")),
        "stoplist": spark.createDataFrame([(s,) for s in STOPLIST], "symbol string"),
        "filings": spark.createDataFrame([("FILED", True, "Filed Corp"), ("NOTF", False, "x")], "symbol string, hit boolean, label string"),
    }


def classify(spark, lists, *rows):
    df = spark.createDataFrame([(s, c, a, c + a, "cashtag") for s, c, a in rows], COUNTS)
    return {r.symbol: r for r in cl.classify(df, **lists).collect()}


@pytest.mark.parametrize(
    "symbol, cash, caps, bucket, reason, sources, names, action",
    [
        ("PEAR", 60, 1, "confirmed", "equity_listing_match", "sec_company_tickers", "Pear", "review"),
        ("IT", 60, 1, "ambiguous", "equity_listing_match", "wayback_2020_nasdaqlisted", "Info Tech", "review"),
        ("Q", 60, 1, "ambiguous", "equity_listing_match", "sec_company_tickers", "Quick", "review"),
        ("MOON", 60, 1, "stoplist", "slang_or_profanity", "slang_stoplist", "", "review"),
        ("OTCX", 60, 1, "confirmed", "sec_otc_or_foreign_exchange", "sec_exchange:OTC", "Otc X", "review"),
        ("SHLDQ", 60, 1, "review_foreign", "suffix_nasdaq_bankruptcy_Q", "suffix_nasdaq_bankruptcy_Q", "", "review"),
        ("RYCEY", 60, 1, "review_foreign", "suffix_adr_Y", "suffix_adr_Y", "", "review"),
        ("BABYF", 60, 100, "review_foreign", "suffix_foreign_F", "suffix_foreign_F", "", "review"),
        ("BABYF", 60, 601, "stoplist", "foreign_suffix_false_positive:base_in_slang_or_common:BABY",
         "foreign_suffix_filter", "", "ignore"),
        ("BCKY", 60, 1, "stoplist", "foreign_suffix_false_positive:base_in_slang_or_common:BCK",
         "foreign_suffix_filter", "", "ignore"),
        ("DOGE", 60, 1, "crypto", "coingecko_symbol", "coingecko", "Another | Dogecoin", "review"),
        ("RDBX", 60, 1, "confirmed", "human_confident_equity", "manual_review_allowlist", "", "review"),
        ("TESLA", 60, 1, "alias", "alias_of:TSLA", "known_alias_map", "TSLA", "review"),
        ("FILED", 60, 1, "confirmed", "sec_edgar_fulltext", "sec_efts", "Filed Corp", "review"),
        ("NOTF", 200, 1, "review_foreign", "suffix_foreign_F", "suffix_foreign_F", "", "review"),
        ("WORD", 200, 1, "confirmed", "high_cashtag_spotcheck", "cashtag_threshold_200", "", "review"),
        ("WORD", 199, 1, "unrecognized", "unmatched_low_cashtag", "", "", "ignore_or_manual"),
    ],
)
def test_rules(spark, lists, symbol, cash, caps, bucket, reason, sources, names, action):
    row = classify(spark, lists, (symbol, cash, caps))[symbol]
    assert (row.bucket, row.reason, row.sources, row.matched_names, row.action) == (
        bucket, reason, sources, names, action)


def test_rare_candidates_are_left_out(spark, lists):
    assert classify(spark, lists, ("WORD", 49, 999)) == {}


@pytest.mark.parametrize(
    "symbol, cash, caps, reason",
    [
        ("BECKY", 10, 1, "symbol_in_stoplist"),
        ("TSLAQ", 10, 1, "symbol_in_stoplist"),
        ("BABYF", 10, 100, None),
        ("BABYF", 10, 101, "base_in_slang_or_common:BABY"),
        ("MILFY", 10, 1, "base_in_slang_or_common:MILF"),
        ("GAY", 1, 11, "high_allcaps_and_slang"),
        ("GAY", 1, 10, None),
        ("RYCEY", 1, 99, None),
    ],
)
def test_foreign_false_positives(spark, lists, symbol, cash, caps, reason):
    df = spark.createDataFrame([(symbol, cash, caps)], "symbol string, cashtag_count long, allcaps_count long")
    assert cl.filter_foreign(df, lists["stoplist"]).first().drop_reason == reason


def test_bucket_files_keep_rows_and_empty_cells(spark, lists, tmp_path):
    df = spark.createDataFrame([(s, 60, 1, 61, "cashtag") for s in ("PEAR", "MOON", "WORD")], COUNTS)
    rows = cl.classify(df, **lists)
    files.write_buckets(rows, str(tmp_path / "buckets"))
    back = files.read_buckets(spark, str(tmp_path / "buckets")).select(*cl.COLUMNS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.select(*cl.COLUMNS).collect()))


TICKERS = "symbol string, name string, exchange string, is_etf boolean, is_active boolean, ticker_source string"


def test_promotion(spark, lists):
    rows = [
        ("PEAR", 60, 1, 61, "e", "confirmed", "equity_listing_match", "s", "Pear | Pear Two", "review"),
        ("WORD", 300, 1, 301, "e", "confirmed", "high_cashtag_spotcheck", "s", "", "review"),
        ("SHLDQ", 60, 1, 61, "e", "review_foreign", "suffix_nasdaq_bankruptcy_Q", "s", None, "review"),
        ("RYCEY", 60, 1, 61, "e", "review_foreign", "suffix_adr_Y", "s", "", "review"),
        ("PEAR", 90, 1, 91, "e", "review_foreign", "suffix_adr_Y", "s", "", "review"),
        ("TSLAQ", 60, 1, 61, "e", "review_foreign", "suffix_nasdaq_bankruptcy_Q", "s", "", "review"),
    ]
    df = spark.createDataFrame(rows, files.CLASSIFIED_SCHEMA.replace("evidence string,", "evidence string, bucket string,"))
    tickers = spark.createDataFrame([("RYCEY", "Known", "X", False, True, "manual"),
                                     ("TSLAQ", "Bad", "CORPUS", False, True, "corpus_mined")], TICKERS)
    names = spark.createDataFrame([("pear", "APPLE")], "normalized_name string, symbol string")
    done = pr.promote(
        df.filter("bucket = 'confirmed'"), df.filter("bucket = 'review_foreign'"),
        stoplist=lists["stoplist"], tickers=tickers, names=names,
    )
    new = {r.symbol: (r.name, r.exchange, r.ticker_source) for r in done.new_tickers.collect()}
    assert new == {
        "PEAR": ("Pear", "CORPUS", "corpus_mined"),
        "WORD": ("Corpus-mined (high_cashtag_spotcheck)", "CORPUS", "corpus_mined"),
        "SHLDQ": ("Corpus-mined (suffix_nasdaq_bankruptcy_Q)", "OTC-BANKRUPTCY", "corpus_mined"),
    }
    assert "pear" not in {r.normalized_name for r in done.new_names.collect()}
    assert [(r.symbol, r.reason) for r in done.dropped.collect()] == [
        ("TSLAQ", "foreign_suffix_false_positive:symbol_in_stoplist")]
    checks = {(r.metric, r.item): r.n for r in pr.verification(tickers, done).collect()}
    assert checks == {
        ("before", "manual"): 1, ("before", "corpus_mined"): 1, ("after", "manual"): 1,
        ("after", "corpus_mined"): 4, ("promoted", ""): 4, ("present", ""): 4, ("dropped_but_mined", ""): 1,
    }
    merged = pr.merge_stoplist(done.dropped.withColumn("reason", done.dropped["bucket"]).limit(1), done.dropped)
    assert [(r.symbol, r.is_new) for r in merged.collect()] == [("TSLAQ", False)]
    assert merged.first().reason.endswith("symbol_in_stoplist")


def test_filings_of_one_symbol_are_one_row(spark):
    rows = [("abc ", False, "none"), ("ABC", True, "10-K"), ("ABC", None, None), ("XYZ", False, "q")]
    got = {r.symbol: (r.filed, r.label) for r in cl.filing_hits(spark.createDataFrame(rows, "symbol string, hit boolean, label string")).collect()}
    assert got == {"ABC": (True, "10-K"), "XYZ": (False, "q")}
