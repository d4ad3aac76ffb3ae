"""Values that decide results and therefore have to be exactly these.

The slang stoplist is not here: it is a long word list the operator of the pipeline maintains, so
it is an input table (see ``sources.reference_lists.read_stoplist``).
"""

# ---- fixed values: archive load -------------------------------------------------------------
DEFAULT_SUBREDDITS = ("wallstreetbets", "stocks", "pennystocks", "smallstreetbets")
DELETED_AUTHOR = "[deleted]"
EMPTY_BODIES = ("[deleted]", "[removed]")
ZSTD_MAX_WINDOW = 2**31

# ---- fixed values: corpus mining ------------------------------------------------------------
MIN_TOKEN_COUNT = 50
MINE_START_DATE = "2020-01-01"
SYMBOL_SHAPE = "^[A-Z]{1,5}$"
WORD_CHARS = r"\p{L}\p{N}\p{M}_"
CASHTAG = r"\$([A-Za-z]{1,5}+)(?![" + WORD_CHARS + "])"
# the look-ahead in front turns most positions away before the dearer look-behind is tried
ALL_CAPS = "(?=[A-Z]{2})(?<![" + WORD_CHARS + "])([A-Z]{2,5}+)(?![" + WORD_CHARS + "])"

# ---- fixed values: listing files ------------------------------------------------------------
LISTING_FOOTER = "FILE CREATION TIME"
EXCHANGE_NAMES = {
    "A": "NYSE American",
    "N": "NYSE",
    "P": "NYSE Arca",
    "Z": "BATS",
    "V": "IEX",
}

# ---- fixed values: words dropped from issuer names, in matching order ------------------------
NAME_NOISE = (
    r"class\s+[a-z0-9]+",
    r"series\s+[a-z0-9]+",
    r"ordinary\s+shares?",
    r"common\s+stock",
    r"common\s+shares?",
    r"preferred\s+stock",
    r"american\s+depositary\s+shares?",
    r"ads",
    r"adr",
    r"warrants?",
    r"rights?",
    r"units?",
    r"holdings?",
    r"holding\s+company",
    r"incorporated",
    r"corporation",
    r"company",
    r"limited",
    r"corp\.?",
    r"inc\.?",
    r"ltd\.?",
    r"llc\.?",
    r"plc\.?",
    r"co\.?",
    r"lp\.?",
    r"&\s*co\.?",
)

# ---- fixed values: candidate classification -------------------------------------------------
MIN_CASHTAG = 50
SPOTCHECK_CASHTAG = 200
OTC_EXCHANGES = ("OTC", "OTCMKTS", "OTCBB", "PINK", "GREY")
FOREIGN_FALSE_BASES = ("BECK", "BCK", "BAB", "BABY", "MIL", "MILF", "GAY", "GAYM", "PSS", "SEN")
KNOWN_ALIASES = {
    "APPL": "AAPL",
    "TESLA": "TSLA",
    "AMZ": "AMZN",
    "AMZNQ": "AMZN",
    "NOKIA": "NOK",
    "LUCID": "LCID",
    "NIKE": "NKE",
    "MFST": "MSFT",
    "MSFTQ": "MSFT",
    "TSMC": "TSM",
    "BOFA": "BAC",
    "BRKB": "BRK.B",
    "BRKA": "BRK.A",
    "BRK": "BRK.B",
    "GOOG": "GOOGL",
    "ALPH": "GOOGL",
    "FACEBK": "META",
    "FB": "META",
}
CONFIDENT_EQUITY = (
    "SEARS", "CCIV", "RDBX", "DEAC", "NGA", "CCCX", "IPOE", "IPOC", "IPOB", "VGAC", "LGVW", "GIK",
    "STPK", "AABB", "ENZC", "RDS", "MMTLP", "EHANG", "DRYS",
    "ABML", "LTNC", "NOVC", "TSNP", "CLIS", "INND", "SGMD", "ALYI", "HMBL", "SIRC", "NSAV", "ILUS",
    "GTEH", "BLSP", "DECN", "CYBL", "SANP",
)

# ---- fixed values: thread polling -----------------------------------------------------------
DAILY_TITLE = "(?i)(daily discussion|what are your moves|moves for)"
DAILY_SUBREDDIT = "wallstreetbets"
HOT_LIMIT = 15
FETCH_LIMIT = 2048
REPLY_GRACE_HOURS = 12
TRUNCATION_STREAK_LIMIT = 3
DRAIN_IDLE_POLLS = 6
DRAIN_MAX_HOURS = 18
COMMENT_PASSES = {"1h": (55, 70), "24h": (23 * 60 + 30, 24 * 60 + 30)}

# ---- fixed values: reports ------------------------------------------------------------------
MARKET_HOURS_UTC = (13, 20)
REQUESTS_PER_MINUTE_ALERT = 80
COMPRESS_AFTER_DAYS = 7
VERDICT_ZERO = "Verdict: zero truncations — poller is capturing everything fetchable."
VERDICT_OFF_HOURS = (
    "Verdict: no truncations during market hours (UTC 13:00–20:59) — healthy; "
    "off-hours truncations only (%d total)."
)
VERDICT_REPEATED = (
    "Verdict: repeated truncations during market hours — need /api/morechildren paginator."
)
VERDICT_ISOLATED = (
    "Verdict: isolated truncation(s) during market hours — watch the next open; "
    "capture % alone is not actionable."
)
