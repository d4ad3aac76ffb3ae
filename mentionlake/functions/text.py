"""Text expressions: tokens in posts, clean-up of archive fields, issuer names, symbol shapes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mentionlake import fixed_values as fixed


def cashtags(text: Column) -> Column:
    """All ``$abc`` tokens of one to five letters, upper-cased, in order of appearance."""
    found = F.regexp_extract_all(text, F.lit(fixed.CASHTAG), F.lit(1))
    return F.transform(found, F.upper)


def all_caps(text: Column) -> Column:
    """All stand-alone words of two to five capital letters."""
    return F.regexp_extract_all(text, F.lit(fixed.ALL_CAPS), F.lit(1))


def post_text(title: Column, selftext: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(selftext, F.lit("")))


def has_body(body: Column) -> Column:
    return body.isNotNull() & ~body.isin(*fixed.EMPTY_BODIES)


def archive_author(author: Column) -> Column:
    return F.nullif(author, F.lit(fixed.DELETED_AUTHOR))


def strip_nul(text: Column) -> Column:
    return F.translate(text, "\x00", "")


def strip_nul_escapes(json_text: Column) -> Column:
    r"""Remove ``\u0000`` from JSON text, leaving an escaped backslash before ``u0000`` alone."""
    cleaned = F.regexp_replace(json_text, r"(?<!\\)((?:\\\\)*)\\u0000", "$1")
    return F.when(json_text.contains("\\u0000"), cleaned).otherwise(json_text)


def is_blank(text: Column) -> Column:
    return text.rlike(r"(?U)^\s*$")


def is_daily_title(title: Column) -> Column:
    return F.coalesce(title, F.lit("")).rlike(fixed.DAILY_TITLE)


# every noise phrase contains one of these words, so their count bounds the passes needed
_NOISE_WORD = (
    "class|series|ordinary|common|preferred|american|ads|adr|warrant|right|unit|holding"
    "|incorporated|corporation|company|limited|corp|inc|ltd|llc|plc|co|lp"
)
_NOISE_PHRASE = r"(?U)[,\s]+(?:" + "|".join(fixed.NAME_NOISE) + r")\b"


def normalize_company_name(name: Column) -> Column:
    """Lower-case issuer name without corporate and share-class words.

    Removing one phrase can make another one appear ("common inc stock"), so the removal repeats.
    A pass that finds anything removes at least one noise word, hence (noise words + 1) passes
    always reach the fixpoint.
    """
    trimmed = F.regexp_replace(name, r"(?U)^\s+|\s+$", "")
    text = F.regexp_replace(F.lower(trimmed), r"\([^)]*\)", " ")
    passes = F.sequence(F.lit(0), F.size(F.regexp_extract_all(text, F.lit(f"({_NOISE_WORD})"))))
    stripped = F.aggregate(
        passes,
        text,
        lambda acc, _: F.btrim(F.regexp_replace(acc, _NOISE_PHRASE, " "), F.lit(" ,.-")),
    )
    words = F.regexp_replace(stripped, r"(?U)[^a-z0-9\s&]", " ")
    return F.trim(F.regexp_replace(words, r"(?U)\s+", " "))


def is_foreign_suffix(symbol: Column) -> Column:
    """ADR, foreign and bankruptcy endings: F or Y from four letters on, Q at exactly five."""
    return symbol.rlike("^.{3,}[FY]$") | symbol.rlike("^.{4}[FYQ]$")


def foreign_base(symbol: Column) -> Column:
    return F.regexp_replace(F.upper(symbol), "^(.+)[FYQ]$", "$1")


def foreign_reason(symbol: Column) -> Column:
    return (
        F.when(symbol.rlike("^.{4}Q$"), "suffix_nasdaq_bankruptcy_Q")
        .when(symbol.endswith("Y"), "suffix_adr_Y")
        .when(symbol.endswith("F"), "suffix_foreign_F")
        .otherwise("suffix_adr_foreign")
    )


def exchange_name(code: Column) -> Column:
    """Display name of an exchange code; unknown codes stay, empty ones become OTHER."""
    code = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    names = F.create_map(*[F.lit(x) for pair in fixed.EXCHANGE_NAMES.items() for x in pair])
    return F.coalesce(names[code], F.nullif(code, F.lit("")), F.lit("OTHER"))


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value for ``key`` in a small fixed table, else NULL."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def one_edit_apart(left: Column, right: Column) -> Column:
    """Edit distance exactly one: one insertion, deletion or substitution."""
    return F.levenshtein(left, right, 1) == 1


def plain_path(address: Column) -> Column:
    """File address as listed: without the local scheme and with its escapes undone."""
    local = F.regexp_replace(address, "^file:/+", "/")
    return F.url_decode(F.replace(local, F.lit("+"), F.lit("%2B")))
