"""Queries of the symbol universe: directories, names, ticker tables, near symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mentionlake import jobs
from mentionlake.functions import text as tx
from mentionlake.operators import classify, hits, snapshots, universe
from mentionlake.operators.keyed_write import first_wins
from mentionlake.plans.bindings import ctes, frame
from mentionlake.plans.registry import query
from mentionlake.session import new_folder
from mentionlake.sources import listings as directories, reference_lists


def normalized(name: str) -> str:
    """Oracle text for the name normaliser: eight removal passes are enough for these names."""
    noise = (
        r"[,\s]+(class\s+[a-z0-9]+|series\s+[a-z0-9]+|common\s+stock|holdings?|corp\.?|inc\.?|ltd\.?"
        r"|company|limited|adr|units?)\b"
    )
    text = f"regexp_replace(lower(trim({name})), '\\([^)]*\\)', ' ', 'g')"
    for _ in range(8):
        text = f"trim(regexp_replace({text}, '{noise}', ' ', 'g'), ' ,.-')"
    text = f"regexp_replace({text}, '[^a-z0-9\\s&]', ' ', 'g')"
    return f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"


EXCHANGE = (
    "CASE exchange_code WHEN 'A' THEN 'NYSE American' WHEN 'N' THEN 'NYSE' WHEN 'P' THEN 'NYSE Arca' "
    "WHEN 'Z' THEN 'BATS' WHEN 'V' THEN 'IEX' ELSE exchange_code END"
)

# NASDAQ rows (code Q) come from their own directory, which is read first
MERGED = f"""
merged AS (
  SELECT symbol, name, exchange, is_etf, line_no FROM (
    SELECT symbol, security_name AS name, line_no, etf = 'Y' AS is_etf,
      CASE WHEN exchange_code = 'Q' THEN 'NASDAQ' ELSE {EXCHANGE} END AS exchange,
      row_number() OVER (PARTITION BY symbol
        ORDER BY CASE WHEN exchange_code = 'Q' THEN 0 ELSE 1 END, line_no) AS rn
    FROM b_listings WHERE test_issue = 'N') WHERE rn = 1)"""


def write_directories(rows: DataFrame, folder: str) -> tuple[str, str]:
    """The two symbol directories as pipe-delimited text with header and footer line."""
    footer = F.lit("File Creation Time: 0101202400:00")
    ordered = rows.select("*", F.lit(0).alias("tail")).orderBy("line_no")

    def cells(symbol: str, code: bool) -> list:
        code_cell = [F.col("exchange_code").alias("Exchange")] if code else []
        return [
            F.col("symbol").alias(symbol),
            F.col("security_name").alias("Security Name"),
            *code_cell,
            F.col("etf").alias("ETF"),
            F.lit("100").alias("Round Lot Size"),
            F.col("test_issue").alias("Test Issue"),
        ]

    paths = (f"{folder}/nasdaqlisted", f"{folder}/otherlisted")
    for path, own, symbol in zip(paths, (True, False), ("Symbol", "ACT Symbol")):
        of_file = ordered.filter((F.col("exchange_code") == "Q") == own).select(*cells(symbol, not own))
        names = of_file.columns
        end = rows.limit(1).select(
            footer.alias(names[0]), *[F.lit(None).cast("string").alias(c) for c in names[1:]]
        )
        of_file.unionByName(end).write.csv(path, sep="|", header=True, encoding="ISO-8859-1")
    return paths


@query(
    "listing_parse_merge",
    f"WITH {ctes('b_listings')}, {MERGED} SELECT symbol, name, exchange, is_etf FROM merged",
)
def listing_parse_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directories written, read back and merged."""
    nasdaq, other = write_directories(
        frame(spark, sf_dir, "b_listings"), new_folder(spark, "listings")
    )
    groups = [
        directories.read_nasdaq_listed(spark, nasdaq),
        directories.read_other_listed(spark, other),
    ]
    merged = universe.merge_listings(groups, directories.ORDER)
    return merged.select("symbol", "name", "exchange", "is_etf")


def merged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "b_listings").filter("test_issue = 'N'")
    listed = rows.select(
        "symbol",
        F.col("security_name").alias("name"),
        F.when(F.col("exchange_code") == "Q", "NASDAQ")
        .otherwise(tx.exchange_name(F.col("exchange_code")))
        .alias("exchange"),
        (F.col("etf") == "Y").alias("is_etf"),
        "line_no",
    )
    nasdaq = F.col("exchange") == "NASDAQ"
    return universe.merge_listings([listed.filter(nasdaq), listed.filter(~nasdaq)], ["line_no"])


@query(
    "normalize_names",
    f"""WITH {ctes('b_listings')}
SELECT line_no, security_name, {normalized('security_name')} AS normalized_name FROM b_listings""",
)
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, "b_listings")
    name = tx.normalize_company_name(F.col("security_name"))
    return rows.select("line_no", "security_name", name.alias("normalized_name"))


# tickers known before the load: every language code, and one per part brand (some get relisted)
KNOWN = """
known AS (
  SELECT symbol, concat('Old ', symbol) AS name, 'OLD' AS exchange, false AS is_etf, false AS is_active,
    'manual' AS ticker_source FROM b_tickers
  UNION ALL
  SELECT DISTINCT symbol, 'Mined', 'CORPUS', false, true, 'corpus_mined' FROM b_listings
  WHERE etf = 'Y' AND symbol NOT IN (SELECT symbol FROM b_tickers))"""


def known_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_hand = frame(spark, sf_dir, "b_tickers")
    mined = frame(spark, sf_dir, "b_listings").filter("etf = 'Y'").select("symbol").distinct()

    def rows(df: DataFrame, name, exchange: str, active: bool, source: str) -> DataFrame:
        return df.select(
            "symbol",
            name.alias("name"),
            F.lit(exchange).alias("exchange"),
            F.lit(False).alias("is_etf"),
            F.lit(active).alias("is_active"),
            F.lit(source).alias("ticker_source"),
        )

    old_name = F.concat(F.lit("Old "), "symbol")
    return rows(by_hand, old_name, "OLD", False, "manual").unionByName(
        rows(mined.join(by_hand, "symbol", "left_anti"), F.lit("Mined"), "CORPUS", True, "corpus_mined")
    )


@query(
    "tickers_upsert",
    f"""WITH {ctes('b_listings', 'b_tickers')}, {MERGED}, {KNOWN}
SELECT * FROM known WHERE symbol NOT IN (SELECT symbol FROM merged)
UNION ALL SELECT symbol, name, exchange, is_etf, true, 'nasdaq_current' FROM merged""",
)
def tickers_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, listed = known_tickers(spark, sf_dir), merged_listings(spark, sf_dir)
    return universe.upsert_tickers(known, listed, ["line_no"])


NAMES = f"""
names AS (
  SELECT normalized_name, symbol FROM (
    SELECT normalized_name, symbol, row_number() OVER (PARTITION BY normalized_name
      ORDER BY CASE WHEN exchange = 'NASDAQ' THEN 0 ELSE 1 END, line_no) AS rn
    FROM (SELECT symbol, exchange, line_no, {normalized('name')} AS normalized_name FROM merged))
  WHERE rn = 1 AND normalized_name <> '')"""


@query(
    "ticker_names_upsert",
    f"""WITH {ctes('b_listings', 'b_tickers')}, {MERGED}, {NAMES},
old AS (SELECT DISTINCT lower(p_name) AS normalized_name, 'OLD' AS symbol FROM part
  UNION ALL SELECT lower(symbol), 'OLD' FROM b_tickers)
SELECT * FROM names UNION ALL
SELECT * FROM old WHERE normalized_name NOT IN (SELECT normalized_name FROM names)""",
)
def ticker_names_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    by_part = part.select(F.lower("p_name").alias("normalized_name")).distinct()
    by_lang = frame(spark, sf_dir, "b_tickers").select(F.lower("symbol").alias("normalized_name"))
    old = by_part.unionByName(by_lang).withColumn("symbol", F.lit("OLD"))
    return universe.upsert_ticker_names(old, merged_listings(spark, sf_dir), ["group_rank", "line_no"])


@query(
    "alias_edit1",
    f"""WITH {ctes('b_listings', 'b_candidates')},
l AS (SELECT DISTINCT symbol FROM b_candidates), r AS (SELECT DISTINCT symbol FROM b_listings)
SELECT l.symbol, r.symbol AS near_symbol FROM l JOIN r ON levenshtein(l.symbol, r.symbol) = 1""",
)
def alias_edit1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.misspellings(
        frame(spark, sf_dir, "b_candidates"), frame(spark, sf_dir, "b_listings")
    )


@query(
    "name_alias",
    f"""WITH {ctes('b_listings', 'b_candidates', 'b_tickers')}, {MERGED}, {NAMES},
words AS (SELECT split_part(normalized_name, ' ', 1) AS normalized_name, max(symbol) AS symbol
  FROM names GROUP BY 1)
SELECT c.symbol, w.symbol AS alias_target FROM b_candidates AS c
JOIN words AS w ON lower(c.symbol) = w.normalized_name""",
)
def name_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names cut to their first word, so that one-word names exist in these tables."""
    rows = universe.name_rows(merged_listings(spark, sf_dir))
    named = first_wins(rows, ["normalized_name"], ["group_rank", "line_no"])
    first_word = F.split_part("normalized_name", F.lit(" "), F.lit(1))
    words = named.groupBy(first_word.alias("normalized_name")).agg(F.max("symbol").alias("symbol"))
    return universe.single_word_aliases(frame(spark, sf_dir, "b_candidates"), words)


HIT_ROWS = f"""
hit_rows AS (SELECT symbol, source, name, exchange FROM b_sec
  UNION SELECT symbol, source, name, exchange FROM b_equity)"""


@query(
    "set_union_hits",
    f"""WITH {ctes('b_sec', 'b_equity')}, {HIT_ROWS}
SELECT symbol, array_to_string(list_sort(list(DISTINCT source)), ';') AS sources,
  array_to_string(list_sort(list(DISTINCT exchange)), ';') AS exchanges,
  array_to_string(list_sort(list(DISTINCT name)), ' | ') AS matched_names
FROM hit_rows GROUP BY symbol""",
)
def set_union_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hits.all_hits(frame(spark, sf_dir, "b_sec"), frame(spark, sf_dir, "b_equity"))
    return hits.symbol_hits(rows, shown=None).select(
        "symbol",
        hits.joined_sources(F.col("sources")).alias("sources"),
        hits.joined_sources(F.col("exchanges")).alias("exchanges"),
        F.array_join("names", " | ").alias("matched_names"),
    )


def write_snapshots(rows: DataFrame, folder: str) -> None:
    """Each snapshot as a folder of files, every one with its header."""
    rows.write.partitionBy("snapshot").option("header", True).option("sep", "|").option("escape", '"').mode("append").csv(folder)


@query(
    "historical_listings",
    f"""WITH {ctes('b_listings')}
SELECT symbol, concat('wayback_', CAST(2019 + line_no % 6 AS INT),
    CASE WHEN exchange_code = 'Q' THEN '_nasdaqlisted' ELSE '_otherlisted' END) AS source,
  security_name AS name, CASE WHEN exchange_code = 'Q' THEN 'NASDAQ' ELSE {EXCHANGE} END AS exchange
FROM b_listings WHERE test_issue = 'N'""",
)
def historical_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six years of both directories, one with its columns in another order, and a page that is no directory."""
    folder = new_folder(spark, "history")
    listed = frame(spark, sf_dir, "b_listings").withColumn("year", (2019 + F.col("line_no") % 6).cast("string"))
    page = spark.range(30).select(F.lit("not found | <a href='/'>home</a>").alias("<html>"), F.lit("wayback_2018_nasdaqlisted").alias("snapshot"))
    write_snapshots(page, folder)
    for kind, symbol, own in (
        ("nasdaqlisted", "Symbol", F.col("exchange_code") == "Q"), ("otherlisted", "ACT Symbol", F.col("exchange_code") != "Q"),
    ):
        cells = {symbol: "symbol", "Security Name": "security_name", "Exchange": "exchange_code", "ETF": "etf", "Test Issue": "test_issue"}
        named = [F.col(c).alias(n) for n, c in cells.items()]
        snapshot = F.concat(F.lit("wayback_"), "year", F.lit(f"_{kind}")).alias("snapshot")
        for rows, columns in ((listed.filter("year <> '2021'"), named), (listed.filter("year = '2021'"), named[::-1])):
            write_snapshots(rows.filter(own).select(*columns, snapshot), folder)
    return reference_lists.read_historical(spark, folder)


OTC = "'OTC', 'OTCMKTS', 'OTCBB', 'PINK', 'GREY'"


@query(
    "otc_or_foreign",
    f"""WITH {ctes('b_sec', 'b_equity')}, hit_rows AS (
  SELECT symbol, source, exchange FROM b_sec UNION SELECT symbol, source, exchange FROM b_equity
  UNION SELECT concat(symbol, 'X'), concat('list:', exchange), NULL FROM b_sec
  UNION SELECT concat(symbol, 'Y'), 'sec_exchange:None', NULL FROM b_equity
  UNION SELECT concat(symbol, 'Z'), source, CASE WHEN exchange = 'OTC' THEN 'Pink' ELSE exchange END FROM b_sec)
SELECT symbol, CASE WHEN count(exchange) > 0 THEN count(*) FILTER (upper(exchange) IN ({OTC})) > 0
  ELSE count(*) FILTER (regexp_matches(source, '^sec_exchange:(OTC|None)|:OTC$')) > 0 END AS is_otc
FROM hit_rows GROUP BY symbol""",
)
def otc_or_foreign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a symbol's exchanges, or without any its sources, are over-the-counter; with symbols of each sort."""
    sec, equity = (frame(spark, sf_dir, n).select("symbol", "source", "name", "exchange") for n in ("b_sec", "b_equity"))
    other = lambda rows, end, source, exchange: rows.withColumns(
        {"symbol": F.concat("symbol", F.lit(end)), "source": source, "exchange": exchange})
    none = F.lit(None).cast("string")
    pink = F.when(F.col("exchange") == "OTC", "Pink").otherwise(F.col("exchange"))
    rows = hits.all_hits(
        sec, equity, other(sec, "X", F.concat(F.lit("list:"), "exchange"), none),
        other(equity, "Y", F.lit("sec_exchange:None"), none), other(sec, "Z", F.col("source"), pink))
    return hits.symbol_hits(rows).select("symbol", classify.is_otc_or_foreign(F.col("sources"), F.col("exchanges")).alias("is_otc"))


@query(
    "edit_one",
    """WITH words AS (SELECT p_partkey, upper(split_part(p_name, ' ', 1)) AS w FROM part),
pairs AS (SELECT p_partkey, w, CASE p_partkey % 5 WHEN 0 THEN w WHEN 1 THEN concat(w, 'F') WHEN 2 THEN substr(w, 2)
  WHEN 3 THEN concat('X', substr(w, 2)) ELSE concat(substr(w, 2), 'QY') END AS v FROM words)
SELECT p_partkey, w, v, levenshtein(w, v) = 1 AS near FROM pairs""",
)
def edit_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words beside themselves, one and two edits away."""
    pairs = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey", "upper(split_part(p_name, ' ', 1)) AS w").selectExpr(
        "*", "CASE p_partkey % 5 WHEN 0 THEN w WHEN 1 THEN concat(w, 'F') WHEN 2 THEN substr(w, 2)"
        " WHEN 3 THEN concat('X', substr(w, 2)) ELSE concat(substr(w, 2), 'QY') END AS v")
    return pairs.withColumn("near", tx.one_edit_apart(F.col("w"), F.col("v")))


@query(
    "json_reference_lists",
    f"""WITH {ctes('b_sec', 'b_coins')}
SELECT DISTINCT symbol, 'sec_company_tickers' AS source, name, CAST(NULL AS VARCHAR) AS exchange FROM b_sec
UNION SELECT symbol, source, name, exchange FROM b_sec
UNION SELECT symbol, 'coingecko', name, NULL FROM b_coins WHERE regexp_full_match(symbol, '[A-Z0-9]{{1,5}}')""",
)
def json_reference_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three JSON lists written in their published shapes and read back.

    Each list is split into documents of about five hundred entries.
    """
    folder = new_folder(spark, "lists")

    def in_documents(df: DataFrame) -> DataFrame:
        documents = 1 + df.count() // 500
        return df.withColumn("part", F.pmod(F.xxhash64("symbol", "name"), F.lit(documents)))

    sec = in_documents(frame(spark, sf_dir, "b_sec"))
    coins = in_documents(frame(spark, sf_dir, "b_coins").distinct())

    def write(df: DataFrame, value, path: str) -> str:
        docs = df.groupBy("part").agg(value.alias("value")).select("value")
        docs.write.option("maxRecordsPerFile", 1).text(path)
        return path

    entries = F.collect_list(F.struct(F.lower("symbol").alias("ticker"), F.col("name").alias("title")))
    keyed = F.to_json(
        F.map_from_entries(F.transform(entries, lambda x, i: F.struct(i.cast("string"), x)))
    )
    cells = F.collect_list(F.array("exchange", "name", "symbol"))
    table = F.to_json(
        F.struct(
            F.array(F.lit("exchange"), F.lit("name"), F.lit("ticker")).alias("fields"),
            cells.alias("data"),
        )
    )
    listed = F.to_json(F.collect_set(F.struct("symbol", "name")))
    parts = [
        reference_lists.read_sec_map(spark, write(sec, keyed, f"{folder}/map")),
        reference_lists.read_sec_exchange(spark, write(sec, table, f"{folder}/table")),
        reference_lists.read_coins(spark, write(coins, listed, f"{folder}/coins")).select(
            "symbol",
            F.lit("coingecko").alias("source"),
            "name",
            F.lit(None).cast("string").alias("exchange"),
        ),
    ]
    return hits.merge_hits(*parts)


@query(
    "universe_load",
    f"""WITH {ctes('b_listings')}, {MERGED}, {NAMES}
SELECT 'ticker' AS kind, symbol, name AS value, exchange, is_etf FROM merged
UNION ALL SELECT 'name', symbol, normalized_name, '', false FROM names""",
)
def universe_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directories loaded into the versioned tables, twice: the second load changes nothing."""
    folder = new_folder(spark, "universe")
    nasdaq, other = write_directories(frame(spark, sf_dir, "b_listings"), f"{folder}/listings")
    tables = jobs.UniverseTables(f"{folder}/tickers", f"{folder}/names")
    for _ in range(2):
        jobs.load_universe(spark, nasdaq, other, tables)
    tickers = snapshots.read(spark, tables.tickers, jobs.TICKERS)
    names = snapshots.read(spark, tables.names, jobs.NAMES)
    return tickers.select(
        F.lit("ticker").alias("kind"), "symbol", F.col("name").alias("value"), "exchange", "is_etf"
    ).unionByName(
        names.select(
            F.lit("name").alias("kind"),
            "symbol",
            F.col("normalized_name").alias("value"),
            F.lit("").alias("exchange"),
            F.lit(False).alias("is_etf"),
        )
    )
