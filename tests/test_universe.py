import random

import pytest

from mentionlake.operators import hits, universe
from mentionlake.sources import listings, reference_lists

NASDAQ = """Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares
PEAR|Pear Inc. - Common Stock|Q|N|N|100|N|N
ZTEST|Test issue|Q|Y|N|100|N|N
FUND|"Fund ""X"" Trust"|Q|N|N|100|Y|N
|No symbol|Q|N|N|100|N|N
File Creation Time: 0101202400:00|||||||
"""
OTHER = """ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Round Lot Size|Test Issue|NASDAQ Symbol
PEAR|Pear elsewhere|N|PEAR|N|100|N|PEAR
lime|Lime Holdings|P|LIME|N|100|N|LIME
ODD|Odd One|W|ODD|N|100|N|ODD
file creation time: 0101202400:00|||||||
"""


@pytest.fixture
def directories(spark, tmp_path):
    (tmp_path / "nasdaqlisted.txt").write_text(NASDAQ, encoding="latin-1")
    (tmp_path / "otherlisted.txt").write_text(OTHER, encoding="latin-1")
    return (
        listings.read_nasdaq_listed(spark, str(tmp_path / "nasdaqlisted.txt")),
        listings.read_other_listed(spark, str(tmp_path / "otherlisted.txt")),
    )


def test_directories_and_merge(directories):
    merged = universe.merge_listings(directories, listings.ORDER)
    got = {r.symbol: (r.name, r.exchange, r.is_etf) for r in merged.collect()}
    assert got == {
        "PEAR": ("Pear Inc. - Common Stock", "NASDAQ", False),
        "FUND": ('Fund "X" Trust', "NASDAQ", True),
        "LIME": ("Lime Holdings", "NYSE Arca", False),
        "ODD": ("Odd One", "W", False),
    }


TICKERS = "symbol string, name string, exchange string, is_etf boolean, is_active boolean, ticker_source string"


def test_reload_overwrites_but_never_deactivates(spark, directories):
    known = spark.createDataFrame(
        [("PEAR", "old", "X", True, False, "manual"), ("GONE", "gone", "X", False, True, "nasdaq_current")],
        TICKERS,
    )
    merged = universe.merge_listings(directories, listings.ORDER)
    rows = {r.symbol: r for r in universe.upsert_tickers(known, merged, ["line"]).collect()}
    assert (rows["PEAR"].ticker_source, rows["PEAR"].is_active, rows["PEAR"].is_etf) == ("nasdaq_current", True, False)
    assert rows["GONE"].is_active and len(rows) == 5


def test_promotion_never_overwrites(spark, directories):
    known = spark.createDataFrame([("PEAR", "old", "X", True, False, "manual")], TICKERS)
    merged = universe.merge_listings(directories, listings.ORDER)
    new = universe.new_corpus_tickers(known, merged, ["line"])
    assert sorted(r.symbol for r in new.collect()) == ["FUND", "LIME", "ODD"]
    again = universe.new_corpus_tickers(known.unionByName(new), merged, ["line"])
    assert again.count() == 0


def test_names_first_listing_keeps_the_name(spark):
    listed = spark.createDataFrame(
        [("A1", "Pear Inc", 1), ("A2", "PEAR Corp.", 2), ("A3", "Inc. (x)", 3), ("A4", "Holdings", 4)],
        "symbol string, name string, line int",
    )
    old = spark.createDataFrame([("pear", "OLD"), ("fig", "OLD")], "normalized_name string, symbol string")
    got = dict(map(tuple, universe.upsert_ticker_names(old, listed, ["line"]).collect()))
    assert got["pear"] == "A1" and got["fig"] == "OLD"
    assert {r.symbol for r in universe.new_corpus_names(old, listed, ["line"]).collect()}.isdisjoint({"A1", "A2"})


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) - len(b) == 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def test_misspellings_against_brute_force(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("AB") for _ in range(rng.randrange(1, 6))) for _ in range(60)} | {"", "CCC"}
    left, right = sorted(words)[::2], sorted(words)
    as_frame = lambda ws: spark.createDataFrame([(w,) for w in ws] * 2, "symbol string")
    got = [tuple(r) for r in universe.misspellings(as_frame(left), as_frame(right)).collect()]
    want = {(a, b) for a in left for b in right if distance_one(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_single_word_aliases(spark):
    symbols = spark.createDataFrame([("PEAR",), ("FIG",)], "symbol string")
    names = spark.createDataFrame([("pear", "PR"), ("fig tree", "FT")], "normalized_name string, symbol string")
    assert [tuple(r) for r in universe.single_word_aliases(symbols, names).collect()] == [("PEAR", "PR")]


def test_reference_lists(spark, tmp_path):
    (tmp_path / "map.json").write_text('{"0":{"cik":1,"ticker":"pr","title":"Pear"},"1":{"ticker":" ","title":"x"}}')
    (tmp_path / "table.json").write_text(
        '{"fields":["cik","name","ticker","exchange"],"data":[[1,"Pear","PR","NYSE"],[2,"Fig","FG",null],[3,"Ox","OX","OTC"]]}'
    )
    (tmp_path / "coins.json").write_text(
        '[{"id":"a","symbol":"btx","name":"Bit X"},{"symbol":"toolong","name":"n"},{"symbol":"a-b","name":"n"},{"symbol":"","name":"n"}]'
    )
    (tmp_path / "words.txt").write_text("# words\nmoon\nYOLO # loud\n\nMOON\n")
    rows = hits.merge_hits(
        reference_lists.read_sec_map(spark, str(tmp_path / "map.json")),
        reference_lists.read_sec_exchange(spark, str(tmp_path / "table.json")),
    )
    got = {r.symbol: r for r in hits.symbol_hits(rows).collect()}
    assert got["PR"].sources == ["sec_company_tickers", "sec_exchange:NYSE"]
    assert got["PR"].names == ["Pear"] and got["PR"].exchanges == ["NYSE"]
    assert got["FG"].sources == ["sec_exchange:None"] and got["FG"].exchanges == []
    coins = reference_lists.read_coins(spark, str(tmp_path / "coins.json")).collect()
    assert [tuple(r) for r in coins] == [("BTX", "Bit X")]
    words = reference_lists.read_stoplist(spark, str(tmp_path / "words.txt")).collect()
    assert sorted(r.symbol for r in words) == ["MOON", "YOLO"]


def test_historical_snapshots(spark, tmp_path):
    (tmp_path / "wayback_2020_nasdaqlisted.txt").write_text(NASDAQ)
    (tmp_path / "wayback_2024_otherlisted.txt").write_text(OTHER)
    got = {(r.symbol, r.source) for r in reference_lists.read_historical(spark, str(tmp_path)).collect()}
    assert ("PEAR", "wayback_2020_nasdaqlisted") in got and ("LIME", "wayback_2024_otherlisted") in got
    assert len(got) == 5


def test_only_first_five_names(spark):
    rows = spark.createDataFrame([("A", f"n{i}") for i in range(9)] * 2, "symbol string, name string")
    assert hits.first_names(rows).first().names == ["n0", "n1", "n2", "n3", "n4"]


def test_each_snapshot_is_read_by_its_own_header(spark, tmp_path):
    head = "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares"
    other = "ETF|Test Issue|Security Name|Symbol"
    (tmp_path / "wayback_2020_nasdaqlisted.txt").write_text(f"{head}\nAAA|Alpha Inc|Q|N|N|100|N|N\nFile Creation Time: 1|||||||\n")
    (tmp_path / "wayback_2021_nasdaqlisted.txt").write_text(f"{other}\nY|N|Fig Fund|FIG\nN|Y|Test|ZZZ\n")
    (tmp_path / "wayback_2022_nasdaqlisted.txt").write_text("<html>\n<body>not found | sorry</body>\n" * 20)
    got = {(r.symbol, r.source) for r in reference_lists.read_historical(spark, str(tmp_path)).collect()}
    assert got == {("AAA", "wayback_2020_nasdaqlisted"), ("FIG", "wayback_2021_nasdaqlisted")}
    left_out = listings.unreadable(spark, str(tmp_path), "Symbol", "wayback_*_nasdaqlisted.txt").collect()
    assert [r.file.rsplit("/", 1)[1] for r in left_out] == ["wayback_2022_nasdaqlisted.txt"]
    with pytest.raises(Exception, match="not a symbol directory"):
        listings.read_nasdaq_listed(spark, str(tmp_path / "wayback_2022_nasdaqlisted.txt")).collect()


def test_long_lines_and_folders_of_files(spark, tmp_path):
    """No cell is lost however many a line has, and a snapshot may be a folder."""
    many = "|".join(f"extra {i}" for i in range(40))
    folder = tmp_path / "snapshot=wayback_2023_otherlisted"
    folder.mkdir()
    head = f"{many}|ACT Symbol|Security Name|Exchange|ETF|Test Issue"
    for i in range(2):
        cells = "|".join(["x"] * 40)
        (folder / f"part-{i}.csv").write_text(f'{head}\n{cells}|A{i}|"Bar | Co"|N|N|N\n')
    got = [tuple(r) for r in reference_lists.read_historical(spark, str(tmp_path)).orderBy("symbol").collect()]
    assert got == [(f"A{i}", "wayback_2023_otherlisted", "Bar | Co", "NYSE") for i in range(2)]
    assert reference_lists.read_historical(spark, str(folder)).count() == 2
