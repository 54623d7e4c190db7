"""Spelling candidates and similarity of single words."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill import config

REPEATED = r"([a-z])\1{2,}"
CONTAINED_SCORE, FAR_SCORE = 90.0, 60.0


def repeat_candidates(col: Column) -> Column:
    """The word itself and its letter runs (three or more) cut to one and to two."""
    return F.array_distinct(
        F.array(col, F.regexp_replace(col, REPEATED, "$1"), F.regexp_replace(col, REPEATED, "$1$1"))
    )


def _ambiguous(rules: Mapping[str, Sequence[str]]) -> dict[str, tuple[str, ...]]:
    """Symbols with several readings."""
    return {symbol: tuple(sorted(set(letters))) for symbol, letters in rules.items() if len(set(letters)) > 1}


def _classes(rules: Mapping[str, Sequence[str]]) -> tuple[str, str]:
    """Arguments for translate: every symbol and letter of a rule to one letter for all that look alike."""
    name: dict[str, str] = {}
    for symbol, letters in rules.items():
        linked = {name.get(x, x) for x in (symbol, *letters)}
        best = min(linked, key=lambda x: (x.isdigit(), x))
        for x in (symbol, *letters):
            name.setdefault(x, x)
        name = {x: best if y in linked else y for x, y in name.items()}
    pairs = sorted((x, y) for x, y in name.items() if x != y)
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


def lookalike_key(col: Column, rules: Mapping[str, Sequence[str]] = config.LEET) -> Column:
    """Equal for all spellings that may be read alike: characters by class, runs cut to one."""
    return F.regexp_replace(F.translate(col, *_classes(rules)), r"(.)\1+", "$1")


def lookalike_pattern(word: Column, rules: Mapping[str, Sequence[str]] = config.LEET) -> Column:
    """The expression that a token matches if one of its readings is ``word``.

    A reading counts as it is, or with all its runs of three or more letters cut
    to one, or all of them to two. It is one pattern for a word, however many
    readings a token has.
    """
    symbols: dict[str, str] = {}
    for symbol, letters in sorted(rules.items()):
        for letter in letters:
            symbols[letter] = symbols.get(letter, letter) + symbol
    known = F.create_map(*[F.lit(x) for c, s in symbols.items() for x in (c, f"[{s}]")])
    runs = F.regexp_extract_all(word, F.lit(r"((.)\2*)"), F.lit(1))

    def spelled(of: list[str], longer: str) -> Column:
        """``of``: what a run of one and of two letters stands for; ``longer``: any longer run."""

        def run(r: Column) -> Column:
            one = F.substring(r, 1, 1)
            kind = F.coalesce(F.try_element_at(known, one), one)
            text = F.when(F.length(r) == 1, F.lit(of[0])).when(F.length(r) == 2, F.lit(of[1])).otherwise(F.lit(longer))
            return F.replace(F.replace(text, F.lit("X"), kind), F.lit("N"), F.length(r).cast("string"))

        return F.array_join(F.transform(runs, run), "")

    return F.concat(
        F.lit("^(?:"), spelled(["X", "X{2}"], "X{N}"),
        F.lit("|"), spelled(["(?:X|X{3,})", "X{2}"], "(?!)"),
        F.lit("|"), spelled(["X", "X{2,}"], "(?!)"), F.lit(")$"),
    )


def letter_reading(col: Column, rules: Mapping[str, Sequence[str]] = config.LEET) -> Column:
    """Symbols with one reading as that letter; symbols with several stay and stand for any of them."""
    single = {s: letters[0] for s, letters in sorted(rules.items()) if len(set(letters)) == 1}
    return F.translate(col, "".join(single), "".join(single.values()))


def open_letters(rules: Mapping[str, Sequence[str]] = config.LEET) -> str:
    """The body of a character class: letters and the symbols that ``letter_reading`` leaves."""
    return "a-z" + "".join(sorted(_ambiguous(rules)))


def reading_candidates(col: Column, rules: Mapping[str, Sequence[str]] = config.LEET) -> Column:
    """The letter reading, as it is and with its runs cut to one and to two."""
    reading = letter_reading(col, rules)

    def cut(by: int) -> Column:
        text = reading
        for symbol, letters in sorted(_ambiguous(rules).items()):
            for letter in letters:
                text = F.regexp_replace(text, f"(?={symbol}*{letter})[{letter}{symbol}]{{3,}}", letter * by)
        return F.regexp_replace(text, rf"([{open_letters(rules)}])\1{{2,}}", "$1" * by)

    return F.array_distinct(F.array(reading, cut(1), cut(2)))


def open_class(col: Column, rules: Mapping[str, Sequence[str]] = config.LEET) -> Column:
    """Symbols with several readings and those letters as one letter, so that equal readings are equal."""
    return F.translate(col, *_classes(_ambiguous(rules)))


def open_score(a: str, b: str, rules: Mapping[str, Sequence[str]] = config.LEET) -> Column:
    """``fuzzy_score`` of the best reading of ``a``, in which symbols stand for their letters, with the word ``b``."""
    several = sorted(_ambiguous(rules).items())

    def reads(word: str) -> str:
        return "".join(
            f" or (c = '{symbol}' and substr({word}, j, 1) in ({', '.join(repr(x) for x in letters)}))" for symbol, letters in several
        )

    of_a, of_b = F.col(a), F.col(b)
    for symbol, letters in several:
        of_a = F.replace(of_a, F.lit(symbol), F.lit(f"[{''.join(letters)}]"))
        for letter in letters:
            of_b = F.replace(of_b, F.lit(letter), F.lit(f"[{letter}{symbol}]"))
    first = F.lit(False)
    for symbol, letters in several:
        first = first | ((F.substring(a, 1, 1) == symbol) & F.substring(b, 1, 1).isin(*letters))
    starts = first | (F.substring(a, 1, 1) == F.substring(b, 1, 1))
    return F.when(starts, _score(a, b, F.rlike(F.col(b), of_a) | F.rlike(F.col(a), of_b), reads))


# The expressions below take column names and are written as SQL text: nested
# lambdas read better that way and reach the JVM in one call.


#: A bigint holds a word of so many characters, one bit each, and the carry of an addition.
WORD_BITS = 62


def _by_bits(a: str, b: str, also: str) -> str:
    """SQL for the common subsequence of a word with one of at most ``WORD_BITS`` characters.

    A bit for each character of ``b``; it is cleared once the subsequence grows
    there. One addition moves all bits for a character of ``a``.
    """
    full = f"(shiftleft(1L, length({b})) - 1L)"
    return f"""
        length({b}) - bit_count(aggregate(
            transform(
                transform(sequence(1, length({a})), i -> substr({a}, i, 1)),
                c -> aggregate(sequence(1, length({b})), 0L,
                    (mask, j) -> mask | if(substr({b}, j, 1) = c{also}, shiftleft(1L, j - 1), 0L))),
            {full},
            (open, mask) -> ((open + (open & mask)) | (open & ~mask)) & {full}))"""


def _by_rows(a: str, b: str, also: str) -> str:
    """SQL for the common subsequence of longer words, row by row of the usual table."""
    return f"""
        element_at(aggregate(
            transform(sequence(1, length({a})), i -> substr({a}, i, 1)),
            array_repeat(0, length({b}) + 1),
            (above, c) -> aggregate(
                sequence(1, length({b})),
                array(0),
                (done, j) -> array_append(done, if(
                    substr({b}, j, 1) = c{also},
                    element_at(above, j) + 1,
                    greatest(element_at(above, j + 1), element_at(done, -1))
                ))
            )
        ), -1)"""


def _common_subsequence(a: str, b: str, also: str) -> str:
    return f"if(length({b}) <= {WORD_BITS}, {_by_bits(a, b, also)}, {_by_rows(a, b, also)})"


def common_subsequence(a: str, b: str, also: str = "") -> Column:
    """Length of the longest common subsequence of two non-empty words.

    ``also`` is SQL for further pairs that count as equal: ``c`` is the character of ``a``, ``j`` the place in ``b``.
    """
    return F.expr(_common_subsequence(a, b, also))


def _no_more(_: str) -> str:
    return ""


def window_ratio(a: str, b: str, reads: Callable[[str], str] = _no_more) -> Column:
    """The best 200 * LCS / total length of the shorter word with a window of the longer one.

    A window is as long as the shorter word, or shorter where it begins or ends
    the longer one.
    """

    def best(longer: str, shorter: str, left: str, right: str) -> str:
        size, places = f"length({shorter})", f"length({longer})"
        # windows that hang over an end by up to all but one character
        windows = f"""
            transform(sequence(2 - {size}, {places}), s ->
                substr({longer}, greatest(s, 1), {size} + least(s, 1) - 1))"""
        return f"""
            array_max(transform({windows}, w ->
                200 * {_common_subsequence(left, right, reads(right))} / double({size} + length(w))))"""

    return F.expr(f"if(length({a}) >= length({b}), {best(a, b, 'w', b)}, {best(b, a, a, 'w')})")


def _score(a: str, b: str, contained: Column, reads: Callable[[str], str]) -> Column:
    la, lb = F.length(a), F.length(b)
    total = la + lb
    base = (1 - (total - 2 * common_subsequence(a, b, reads(b))) / total) * 100
    share = F.when(F.greatest(la, lb) <= 8 * F.least(la, lb), CONTAINED_SCORE / 100).otherwise(FAR_SCORE / 100)
    inside = F.greatest(base, share * F.when(contained, F.lit(100.0)).otherwise(window_ratio(a, b, reads)))
    return F.when(F.greatest(la, lb) * 2 >= F.least(la, lb) * 3, inside).otherwise(base)


def fuzzy_score(a: str, b: str) -> Column:
    """Similarity 0 to 100 of two words: 200 * LCS / total length.

    When one word is at least half as long again as the other, the best window of
    it counts, too: ``CONTAINED_SCORE`` percent of ``window_ratio``, or
    ``FAR_SCORE`` percent when it is more than eight times as long.
    """
    contained = F.contains(F.col(a), F.col(b)) | F.contains(F.col(b), F.col(a))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(_score(a, b, contained, _no_more))


def length_gap(size: str, ratio: str | float) -> Column:
    """How much longer or shorter a dictionary word may be."""
    return F.expr(f"greatest(1, int(floor({size} * double({ratio}))))")


def allowed_distance(l1: str, l2: str, threshold: str) -> Column:
    """Largest insert/delete distance that still reaches ``threshold``, with the parity of l1 - l2."""
    loose = f"int(floor(({l1} + {l2}) * (100 - double({threshold})) / 100 + 1e-9D))"
    return F.expr(f"{loose} - pmod({loose} + {l1} + {l2}, 2)")


def window_distance(l1: str, l2: str, threshold: str) -> str:
    """SQL for the largest insert/delete distance of the shorter word to a window that still reaches ``threshold``; -1 for none."""
    most = f"if(greatest({l1}, {l2}) <= 8 * least({l1}, {l2}), {CONTAINED_SCORE}D, {FAR_SCORE}D)"
    return f"""
        if(greatest({l1}, {l2}) * 2 >= least({l1}, {l2}) * 3 and {threshold} <= {most},
            int(floor((1 - {threshold} / {most}) * 2 * least({l1}, {l2}) + 1e-9D)), -1)"""


def deletions(word: str, count: str) -> str:
    """SQL for the distinct strings left after deleting 0, 1 or 2 characters, never the first one."""
    return f"""
        array_distinct(case {count}
            when 0 then array({word})
            when 1 then transform(
                sequence(2, greatest(2, length({word}))),
                i -> concat(substr({word}, 1, i - 1), substr({word}, i + 1)))
            else flatten(transform(
                sequence(2, greatest(2, length({word}) - 1)),
                i -> transform(
                    sequence(i, greatest(i, length({word}) - 1)),
                    j -> concat(substr({word}, 1, i - 1), substr({word}, i + 1, j - i), substr({word}, j + 2)))))
        end)"""


def substrings(word: str, size: str) -> str:
    """SQL for the distinct substrings of a length that start with the word's first character."""
    return f"""
        array_distinct(filter(
            transform(sequence(1, length({word}) - {size} + 1), i -> substr({word}, i, {size})),
            s -> substr(s, 1, 1) = substr({word}, 1, 1)))"""


def _cut_points(size: str, distance: str) -> str:
    """SQL for (part, start, size) of ``distance + 1`` even parts of a word with ``size`` characters."""
    return f"""
        transform(sequence(0, {distance}), i -> struct(
            i as part,
            int(i * {size} div ({distance} + 1)) as start,
            int((i + 1) * {size} div ({distance} + 1)) - int(i * {size} div ({distance} + 1)) as size))"""


def word_parts(word: str, distance: str) -> str:
    """SQL for the join keys of a word's parts: first character, part number, characters."""
    return f"""
        transform({_cut_points(f"length({word})", distance)},
            p -> concat(substr({word}, 1, 1), p.part, ':', substr({word}, p.start + 1, p.size)))"""


def token_parts(token: str, word_size: str, distance: str, left: str, right: str) -> str:
    """SQL for the keys a token shares with a word of ``word_size`` whose part moved by -left to right places."""
    return f"""
        array_distinct(flatten(transform({_cut_points(word_size, distance)},
            p -> transform(
                filter(
                    transform(sequence(-{left}, {right}), s -> p.start + s),
                    s -> s >= 0 and s + p.size <= length({token})),
                s -> concat(substr({token}, 1, 1), p.part, ':', substr({token}, s + 1, p.size))))))"""
