"""Emoticons, emoji and broken encodings, all as native expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.text import safe_text_token

# The code points with Unicode's property Emoji beyond ASCII, without
# the letters of flags.
EMOJI_RANGES = """
a9 ae 203c 2049 2122 2139 2194-2199 21a9-21aa 231a-231b 2328 23cf 23e9-23f3 23f8-23fa 24c2 25aa-25ab 25b6 25c0
25fb-25fe 2600-2604 260e 2611 2614-2615 2618 261d 2620 2622-2623 2626 262a 262e-262f 2638-263a 2640 2642 2648-2653
265f-2660 2663 2665-2666 2668 267b 267e-267f 2692-2697 2699 269b-269c 26a0-26a1 26a7 26aa-26ab 26b0-26b1 26bd-26be
26c4-26c5 26c8 26ce-26cf 26d1 26d3-26d4 26e9-26ea 26f0-26f5 26f7-26fa 26fd 2702 2705 2708-270d 270f 2712 2714 2716
271d 2721 2728 2733-2734 2744 2747 274c 274e 2753-2755 2757 2763-2764 2795-2797 27a1 27b0 27bf 2934-2935 2b05-2b07
2b1b-2b1c 2b50 2b55 3030 303d 3297 3299 1f004 1f0cf 1f170-1f171 1f17e-1f17f 1f18e 1f191-1f19a 1f201-1f202 1f21a
1f22f 1f232-1f23a 1f250-1f251 1f300-1f321 1f324-1f393 1f396-1f397 1f399-1f39b 1f39e-1f3f0 1f3f3-1f3f5 1f3f7-1f4fd
1f4ff-1f53d 1f549-1f54e 1f550-1f567 1f56f-1f570 1f573-1f57a 1f587 1f58a-1f58d 1f590 1f595-1f596 1f5a4-1f5a5 1f5a8
1f5b1-1f5b2 1f5bc 1f5c2-1f5c4 1f5d1-1f5d3 1f5dc-1f5de 1f5e1 1f5e3 1f5e8 1f5ef 1f5f3 1f5fa-1f64f 1f680-1f6c5
1f6cb-1f6d2 1f6d5-1f6d7 1f6dc-1f6e5 1f6e9 1f6eb-1f6ec 1f6f0 1f6f3-1f6fc 1f7e0-1f7eb 1f7f0 1f90c-1f93a 1f93c-1f945
1f947-1f9ff 1fa70-1fa7c 1fa80-1fa89 1fa8f-1fac6 1face-1fadc 1fadf-1fae9 1faf0-1faf8
"""
EMOJI_CLASS = "".join(
    "-".join(rf"\x{{{point}}}" for point in part.split("-")) for part in EMOJI_RANGES.split()
)
VARIATION_SELECTOR = r"[\x{fe00}-\x{fe0f}]"
_MODIFIER = r"[\x{1f3fb}-\x{1f3ff}]"
_ONE = rf"[{EMOJI_CLASS}]{VARIATION_SELECTOR}?{_MODIFIER}?"
# What an emoji begins with; quicker to rule out at a place than the long class.
_BEGIN = r"[0-9#*\x{a9}\x{ae}\x{203c}-\x{10ffff}]"
# A flag, a keycap, or pictographs glued by zero-width joiners.
EMOJI = (
    rf"(?={_BEGIN})(?:"
    r"[\x{1f1e6}-\x{1f1ff}]{2}"
    rf"|[0-9#*]{VARIATION_SELECTOR}?\x{{20e3}}"
    rf"|{_ONE}(?:\x{{200d}}{_ONE})*)"
)

# Every emoji holds one of these characters, which is quicker to rule out.
EMOJI_HINT = r"[\x{a9}\x{ae}\x{2000}-\x{10ffff}]"
# Lead bytes of UTF-8 emoji, as Latin-1 and code page 1252 both show them. A text
# without them gains no emoji by decoding, and the text itself wins ties.
MOJIBAKE_HINT = r"[\x{c2}\x{e2}\x{e3}\x{f0}]"

# Characters code page 1252 puts at bytes 0x80 to 0x9f.
CP1252_BYTES = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡",
    0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘",
    0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜",
    0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}


def _quote(literal: str) -> str:
    """Escape every ASCII symbol, which Java and RE2 both accept."""
    return "".join("\\" + c if ord(c) < 128 and not c.isalnum() and c not in "_ " else c for c in literal)


def alternation(keys: Iterable[str]) -> str:
    """One pattern that prefers the longest key at each position."""
    return "|".join(_quote(k) for k in sorted(set(keys), key=lambda k: (-len(k), k)))


def _map_literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(mapping.items()) for x in pair])


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _weave(col: Column, pattern: str, token_of, hint: str | None = None) -> Column:
    """Replace each match by `` token ``, where ``token_of`` maps a match to its token.

    ``hint`` is a cheap pattern that every text with a match also matches.
    """

    def replaced(text: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        padded = F.transform(found, lambda m: F.concat(F.lit(" "), token_of(m), F.lit(" ")))
        woven = F.zip_with(gaps, padded, lambda gap, token: F.concat(gap, F.coalesce(token, F.lit(""))))
        return F.when(text.rlike(hint or pattern), F.array_join(woven, "")).otherwise(text)

    return _bind(col, replaced)


def convert_emoticons(col: Column, emoticons: Mapping[str, str]) -> Column:
    if not emoticons:
        return col
    lookup = _map_literal(emoticons)
    return _weave(
        col,
        alternation(emoticons),
        lambda m: F.coalesce(F.try_element_at(lookup, m), F.lit(config.NEUTRAL)),
    )


def without_selector(col: Column) -> Column:
    return F.regexp_replace(col, VARIATION_SELECTOR, "")


def emoji_description(name: Column, unknown: str = config.UNKNOWN_EMOJI) -> Column:
    token = safe_text_token(name)
    return F.when(token != "", token).otherwise(F.lit(unknown))


def _hinted(keys: Iterable[str]) -> bool:
    return all(any(ord(c) >= 0x2000 for c in key) for key in keys)


def emoji_pattern(keys: Iterable[str]) -> str:
    """Whole emoji sequences first, then given keys that are none, the longest first."""
    known = alternation(keys)
    return f"{EMOJI}|{known}" if known else EMOJI


def convert_emojis(col: Column, emojis: Mapping[str, str], names: Mapping[str, str] | None = None) -> Column:
    """Emoji to their token, else their name, else the unknown token.

    The longest sequence at a place is one emoji; it is looked up as it is, then
    without variation selectors.
    """
    names = names or {}
    empty = F.create_map().cast("map<string,string>")
    tokens = _map_literal(emojis) if emojis else empty
    described = _map_literal(names) if names else empty

    def token_of(match: Column) -> Column:
        bare = without_selector(match)
        known = [F.try_element_at(tokens, match), F.try_element_at(tokens, bare)]
        if not names:
            return F.coalesce(*known, F.lit(config.UNKNOWN_EMOJI))
        name = F.coalesce(F.try_element_at(described, match), F.try_element_at(described, bare), F.lit(""))
        return F.coalesce(*known, emoji_description(name))

    keys = [*emojis, *names]
    return _weave(col, emoji_pattern(keys), token_of, EMOJI_HINT if _hinted(keys) else None)


def count_emoticons(col: Column, emoticons: Mapping[str, str]) -> Column:
    return F.regexp_count(col, F.lit(alternation(emoticons))) if emoticons else F.lit(0)


def count_emojis(col: Column, keys: Iterable[str] = ()) -> Column:
    return F.regexp_count(col, F.lit(emoji_pattern(keys)))


def repair_mojibake(col: Column) -> Column:
    """Undo a wrong Latin-1 or cp1252 decoding when that brings emoji back.

    Three readings of the text as bytes are tried; the reading with the most
    emoji wins and the text itself wins ties.
    """
    return _bind(col, _repaired)


def _repaired(col: Column) -> Column:
    specials = "".join(CP1252_BYTES.values())
    as_bytes = "".join(chr(b) for b in CP1252_BYTES)

    def decode(binary: Column) -> Column:
        return F.try_validate_utf8(binary.cast("string"))

    latin1 = decode(F.encode(F.regexp_replace(col, r"[^\x{00}-\x{ff}]", ""), "ISO-8859-1"))
    encodable = F.regexp_replace(col, rf"[^\x{{00}}-\x{{7f}}\x{{a0}}-\x{{ff}}{specials}]", "")
    cp1252 = decode(F.encode(F.translate(encodable, specials, as_bytes), "ISO-8859-1"))
    runs = F.regexp_extract_all(
        F.translate(col, specials, as_bytes), F.lit(r"[\x{00}-\x{ff}]+|[^\x{00}-\x{ff}]+"), F.lit(0)
    )
    run_hex = F.transform(
        runs,
        lambda r: F.when(r.rlike(r"^[\x{00}-\x{ff}]"), F.hex(F.encode(r, "ISO-8859-1"))).otherwise(
            F.hex(F.encode(r, "UTF-8"))
        ),
    )
    mixed = decode(F.unhex(F.array_join(run_hex, "")))
    readings = F.transform(
        F.array_distinct(F.array(col, latin1, cp1252, mixed)),  # the first of equal readings, so ties stay as they are
        lambda reading, i: F.struct(
            F.when(reading.isNull(), -1)
            .when(reading.rlike(EMOJI_HINT), F.regexp_count(reading, F.lit(EMOJI)))
            .otherwise(0)
            .alias("n"),
            (-i).alias("order"),
            reading.alias("text"),
        ),
    )
    return F.when(col.rlike(MOJIBAKE_HINT), F.array_max(readings)["text"]).otherwise(col)
