from mentionlake.functions import text as tx, times


def test_cashtags_need_a_word_boundary(values):
    texts = ["buy $gme, $TSLA!", "$toolong", "x$A $b1 $c_ $dé", "$$amc $AB$cd", ""]
    assert values(tx.cashtags, texts) == [["GME", "TSLA"], [], ["A"], ["AMC", "AB", "CD"], []]


def test_all_caps_are_whole_words(values):
    texts = ["GME to A MOON", "TOOLONG NAMES aBC ABc", "ÉAB ABÉ AB-CD AB_CD", "$GME AB1"]
    assert values(tx.all_caps, texts) == [["GME", "MOON"], ["NAMES"], ["AB", "CD"], ["GME"]]


def test_company_names(values):
    names = {
        "Banana Inc. - Common Stock": "banana",
        "Copper Corporation Common Stock": "copper",
        "Quantum Technologies, Inc. Common Stock": "quantum technologies",
        "Widget Holdings Group": "widget group",
        "Holdings of Note": "holdings of note",
        "Odd common inc stock": "odd",
        "Tea & Co. Class A Ordinary Shares (Cayman)": "tea",
        "Series B Partners L.P. Units": "series b partners l p",
        "Deep units rights warrants adr ads llc plc": "deep",
        "  \tSpaced   Out ltd.  ": "spaced out",
    }
    assert values(tx.normalize_company_name, list(names)) == list(names.values())


def test_long_name_reaches_the_fixpoint(values):
    name = "core" + " common inc stock" * 40
    assert values(tx.normalize_company_name, [name]) == ["core"]


def test_nul_escapes(values):
    texts = [r'{"a":"x\u0000y"}', r'{"a":"x\\u0000y"}', r'{"a":"\\\u0000\u0000"}', "{}"]
    want = [r'{"a":"xy"}', r'{"a":"x\\u0000y"}', r'{"a":"\\"}', "{}"]
    assert values(tx.strip_nul_escapes, texts) == want
    assert values(tx.strip_nul, ["a\x00b"]) == ["ab"]


def test_foreign_suffixes(values):
    symbols = ["ABF", "ABCF", "ABCY", "ABCQ", "ABCDQ", "ABCDE", "GAY"]
    assert values(tx.is_foreign_suffix, symbols) == [False, True, True, False, True, False, False]
    assert values(tx.foreign_base, ["abcf", "Q", "ABC"]) == ["ABC", "Q", "ABC"]
    assert values(tx.foreign_reason, ["HTZGQ", "ABCY", "ABCF"]) == [
        "suffix_nasdaq_bankruptcy_Q",
        "suffix_adr_Y",
        "suffix_foreign_F",
    ]


def test_exchange_names(values):
    assert values(tx.exchange_name, ["n", " P ", "W", "", None]) == [
        "NYSE",
        "NYSE Arca",
        "W",
        "OTHER",
        "OTHER",
    ]


def test_daily_titles(values):
    titles = ["Daily Discussion for Monday", "WHAT ARE YOUR MOVES tomorrow", "My daily chart", None]
    assert values(tx.is_daily_title, titles) == [True, True, False, False]


def test_bodies(values):
    assert values(tx.has_body, ["text", "[removed]", "[deleted]", None]) == [True, False, False, False]


def test_epoch_seconds(values):
    seen = values(
        lambda x: times.epoch_to_utc(x).cast("string"),
        ["1704067200", "1704067200.5", " 0 ", "soon", "NaN", "inf", "1e300", None],
    )
    assert seen == ["2024-01-01 00:00:00", "2024-01-01 00:00:00.5", "1970-01-01 00:00:00"] + [None] * 5


def test_one_edit_apart(spark):
    pairs = [("AAPL", "APPL"), ("AAPL", "AAPLS"), ("AAPL", "APL"), ("AAPL", "AAPL"), ("AAPL", "APLA"), ("", "A")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(tx.one_edit_apart(df.a, df.b)).collect()]
    assert got == [True, True, True, False, False, True]
