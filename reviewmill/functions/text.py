"""Row-wise text expressions: markup, links, whitespace, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace and word characters, written out so that every regex
# engine reads them the same way.
WS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\p{L}\p{N}_"

HTML_TAG = r"<[^>]+>"
URL = rf"(?i)(https?://|www\.)[^{WS}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#([{WORD}]+)"
TOKEN = r"[a-z0-9_]+"
# Whitespace outside these characters is turned into spaces later, so only
# letters, digits, underscore and whitespace survive.
UNSAFE = rf"[^a-z0-9_{WS}]"


def _replace_where(col: Column, hint: Callable[[Column], Column], pattern: str, new: str) -> Column:
    """``pattern`` replaced in texts that ``hint`` doesn't rule out, which is quicker than to search them."""
    return F.transform(F.array(col), lambda t: F.when(~hint(t), t).otherwise(F.regexp_replace(t, pattern, new)))[0]


def _may_hold_url(text: Column) -> Column:
    return F.contains(text, F.lit("://")) | F.contains(F.lower(text), F.lit("www."))


def strip_html(col: Column) -> Column:
    return _replace_where(col, lambda t: F.contains(t, F.lit("<")), HTML_TAG, " ")


def strip_urls(col: Column) -> Column:
    return _replace_where(col, _may_hold_url, URL, " ")


def strip_mentions(col: Column) -> Column:
    return _replace_where(col, lambda t: F.contains(t, F.lit("@")), MENTION, " ")


def unwrap_hashtags(col: Column) -> Column:
    return _replace_where(col, lambda t: F.contains(t, F.lit("#")), HASHTAG, " $1 ")


def collapse_ws(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, f"[{WS}]+", " "))


def strip_markup(col: Column) -> Column:
    return unwrap_hashtags(strip_mentions(strip_urls(strip_html(col))))


def remove_web_noise(col: Column) -> Column:
    return collapse_ws(strip_markup(col))


def clean_structure(col: Column) -> Column:
    # Symbols and whitespace both end up as single spaces, so what is left are the tokens.
    return F.array_join(tokens(strip_markup(col)), " ")


def safe_text_token(col: Column) -> Column:
    """A description as one token: lower case, words joined by underscores."""
    dashed = F.translate(F.lower(col), "-", "_")
    return collapse_ws(F.translate(F.regexp_replace(dashed, UNSAFE, " "), " ", "_"))


def tokens(col: Column) -> Column:
    """All ``[a-z0-9_]+`` runs of the lower-cased text, in order."""
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))


def is_blank(col: Column) -> Column:
    """Null, or nothing but whitespace."""
    return col.isNull() | ~F.rlike(col.cast("string"), F.lit(f"[^{WS}]"))


def word_count(col: Column) -> Column:
    """Whitespace-separated words; 0 for blank text, null for null."""
    return F.regexp_count(col, F.lit(f"[^{WS}]+"))


def strip_ws(col: Column) -> Column:
    def padded(text: Column) -> Column:
        return F.rlike(F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1))), F.lit(f"[{WS}]"))

    return _replace_where(col, padded, f"^[{WS}]+|[{WS}]+$", "")
