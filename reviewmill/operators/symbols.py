"""Emoticons and emoji by lexicon tables of any size.

A text's places where a symbol may begin give candidate substrings of the lengths
that symbols with that first character have. The distinct ones are joined with the
lexicon; of what matches, the leftmost symbol counts, of several at one place the
longest, and then the next one behind it. Matches that touch no other match are
settled by themselves, so only overlapping ones are looked at in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.symbols import EMOJI, EMOJI_HINT, emoji_description, without_selector
from reviewmill.scale import hot_cold_join, materialize

#: Characters of a text in which an emoji is looked for first; longer sequences are looked for to the end.
EMOJI_REACH = 64
#: Up to so many beginnings of two characters are looked for as they are, with more of them first characters only.
MAX_BEGINNINGS = 1000


def _characters(text: Column, body) -> Column:
    """``body(characters)`` with the text cut once."""
    return F.transform(F.array(F.split(text, "")), body)[0]


def _piece(characters: Column, start: Column | int, size: Column | int) -> Column:
    """``size`` characters from place ``start``, counted from 1."""
    return F.array_join(F.slice(characters, start, size), "")


def _places(rows: DataFrame, begin: str, reach: int) -> DataFrame:
    """(row, pieces, heads, starts): texts cut before every place where ``begin`` matches, and the places' numbers.

    Characters between such places cost no more than the pattern. ``heads`` are
    the pieces without what lies ``reach`` or more characters behind their first.
    """
    pieces = rows.filter(F.col("text").rlike(begin)).select("row", F.split("text", f"(?={begin})", -1).alias("pieces"))
    starts = F.expr("""
        aggregate(pieces, struct(1 AS start, cast(array() AS array<int>) AS starts), (s, piece) -> struct(
            s.start + length(piece) AS start, array_append(s.starts, s.start) AS starts)).starts
    """)
    return pieces.select("row", "pieces", F.transform("pieces", lambda piece: F.left(piece, F.lit(reach))).alias("heads"), starts.alias("starts"))


def _near(i: Column, reach: int) -> Column:
    """The next ``reach`` characters from place number ``i``."""
    return F.left(F.array_join(F.slice("heads", i + 1, reach), ""), F.lit(reach))


def _class(characters) -> str:
    return "[" + "".join(rf"\x{{{ord(c):x}}}" for c in sorted(characters)) + "]"


def _candidates(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(row, start, symbol): substrings that begin like a symbol and are as long as one that begins so."""
    for known in (2, 1):  # characters; with too many beginnings of two, one is looked at: a row for each character there is
        grouped = lexicon.groupBy(F.left("symbol", F.lit(known)).alias("c")).agg(F.collect_set(F.length("symbol")).alias("sizes"))
        shapes = (grouped.limit(MAX_BEGINNINGS + 1) if known > 1 else grouped).collect()
        if len(shapes) <= MAX_BEGINNINGS:
            break
    if not shapes:
        return rows.select("row", F.lit(1).alias("start"), F.lit("").alias("symbol")).limit(0)
    sizes = F.create_map(*[x for r in shapes for x in (F.lit(r["c"]), F.array(*map(F.lit, sorted(r["sizes"]))))])
    reach = max(n for r in shapes for n in r["sizes"])
    seconds: dict[str, set[str]] = {}
    for r in shapes:
        seconds.setdefault(r["c"][0], set()).add(r["c"][1:])
    alone = [c for c, after in seconds.items() if "" in after]
    pairs = [_class([c]) + _class(after) for c, after in sorted(seconds.items()) if "" not in after]
    begin = f"(?={_class(seconds)})(?:{'|'.join([*([_class(alone)] if alone else []), *pairs])})"

    def at(start: Column, i: Column) -> Column:
        def here(near: Column) -> Column:
            like = [F.coalesce(F.try_element_at(sizes, F.left(near, F.lit(n))), F.array().cast("array<int>")) for n in (1, 2)]
            fitting = F.filter(F.array_distinct(F.concat(*like)), lambda n: n <= F.length(near))
            return F.transform(fitting, lambda n: F.struct(start.alias("start"), F.left(near, n).alias("symbol")))

        return F.transform(F.array(_near(i, reach)), here)[0]

    return _places(rows, begin, reach).select("row", F.inline(F.flatten(F.transform("starts", at))))


def _emoji(rows: DataFrame) -> DataFrame:
    """(row, start, symbol): the whole emoji that begins at a place."""
    whole = F.lit(f"^(?:{EMOJI})")

    def at(start: Column, i: Column) -> Column:
        def here(near: Column) -> Column:
            far = F.regexp_substr(F.array_join(F.slice("pieces", i + 1, F.size("pieces")), ""), whole)
            # a joiner and a pictograph with its modifiers may stand beyond the end
            symbol = F.when(F.length(near) <= EMOJI_REACH - 5, near).when(near.isNotNull(), far)
            return F.struct(start.alias("start"), symbol.alias("symbol"))

        return F.transform(F.array(F.regexp_substr(_near(i, EMOJI_REACH), whole)), here)[0]

    hinted = rows.filter(F.col("text").rlike(EMOJI_HINT))
    found = F.filter(F.transform("starts", at), lambda x: x["symbol"].isNotNull())
    return _places(hinted, EMOJI, EMOJI_REACH).select("row", F.inline(found))


def _known(candidates: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(row, start, symbol, token) of the candidates that are symbols."""
    candidates = materialize(candidates)  # read three times
    counts = materialize(candidates.groupBy("symbol").agg(F.count("*").alias("n")).join(lexicon, "symbol"))
    return hot_cold_join(candidates, counts.select("symbol", "token"), "symbol", counts)


def _settled(matches: DataFrame) -> DataFrame:
    """(row, found ARRAY<start, size, token>): leftmost matches, of several at a place the preferred, then the longest one."""
    sized = matches.withColumn("size", F.length("symbol"))
    order = Window.partitionBy("row").orderBy("start", "prefer", F.desc("size"))
    reach = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = sized.withColumn("_apart", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    islands = apart.withColumn("_island", F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    entry = F.struct("start", "prefer", (-F.col("size")).alias("less"), "token")
    together = islands.groupBy("row", "_island").agg(F.sort_array(F.collect_list(entry)).alias("all"))
    kept = F.expr(
        """
        aggregate(all, struct(0 AS reach, slice(all, 1, 0) AS kept), (s, x) -> IF(
            x.start >= s.reach, struct(x.start - x.less AS reach, array_append(s.kept, x) AS kept), s)).kept
        """
    )
    each = together.select("row", F.explode(kept).alias("x"))
    found = F.struct(F.col("x.start").alias("start"), (-F.col("x.less")).alias("size"), F.col("x.token").alias("token"))
    return each.groupBy("row").agg(F.sort_array(F.collect_list(found)).alias("found"))


def _woven(text: Column, found: Column) -> Column:
    """The text with every found place replaced by its token between blanks."""

    def weave(characters: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            last = F.element_at(found, F.greatest(i, F.lit(1)))
            begin = F.when(i == 0, F.lit(1)).otherwise(last["start"] + last["size"])
            return F.concat(_piece(characters, begin, x["start"] - begin), F.lit(" "), x["token"], F.lit(" "))

        last = F.element_at(found, -1)
        rest = F.slice(characters, last["start"] + last["size"], F.size(characters))
        return F.concat(F.array_join(F.transform(found, one), ""), F.array_join(rest, ""))

    return _characters(text, weave)


def _replaced(df: DataFrame, row_id: str, text: str, matches: DataFrame) -> DataFrame:
    found = _settled(matches).select(F.col("row").alias("_row"), F.col("found").alias("_found"))
    joined = df.join(found, df[row_id] == found["_row"], "left")
    new = F.when(F.col("_found").isNotNull(), _woven(F.col(text), F.col("_found"))).otherwise(F.col(text))
    return joined.select(*[new.alias(c) if c == text else F.col(c) for c in df.columns])


def _rows(df: DataFrame, row_id: str, text: str) -> DataFrame:
    return df.select(F.col(row_id).alias("row"), F.col(text).alias("text")).filter("text IS NOT NULL AND text <> ''")


def _lexicon(table: DataFrame, symbol: str, token: str) -> DataFrame:
    rows = table.select(F.col(symbol).alias("symbol"), F.col(token).alias("token")).filter("symbol <> ''")
    return rows.groupBy("symbol").agg(F.min("token").alias("token"))


def emoticon_matches(df: DataFrame, row_id: str, text: str, emoticons: DataFrame, symbol: str = "emoticon", token: str = "sentiment") -> DataFrame:
    """(row, start, symbol, token, prefer) of every place where an emoticon may stand, overlapping ones included."""
    lexicon = _lexicon(emoticons, symbol, token).withColumn("token", F.coalesce("token", F.lit(config.NEUTRAL)))
    known = _known(_candidates(_rows(df, row_id, text), lexicon), lexicon)
    return known.select("row", "start", "symbol", "token", F.lit(0).alias("prefer"))


def convert_emoticons(
    df: DataFrame, row_id: str, text: str, emoticons: DataFrame, symbol: str = "emoticon", token: str = "sentiment"
) -> DataFrame:
    """``df`` with the emoticons in ``text`` replaced by `` token ``, as ``functions.symbols.convert_emoticons`` does by a map.

    ``row_id`` is unique and not null. The lexicon is a table of any size; of
    repeated symbols the smallest token counts, a missing one is neutral, empty
    symbols stand for nothing. Null and empty texts stay as they are.
    """
    return _replaced(df, row_id, text, emoticon_matches(df, row_id, text, emoticons, symbol, token))


def emoji_matches(
    df: DataFrame, row_id: str, text: str, emojis: DataFrame, names: DataFrame | None = None,
    unknown: str = config.UNKNOWN_EMOJI,
) -> DataFrame:
    """(row, start, symbol, token, prefer) of every place where an emoji or another key of the tables may stand."""
    rows = _rows(df, row_id, text)
    tokens = _lexicon(emojis, "emoji", "token")
    described = _lexicon(names, "emoji", "name") if names is not None else tokens.limit(0)
    described = described.withColumn("token", emoji_description(F.coalesce("token", F.lit("")), unknown))
    ranked = tokens.withColumn("rank", F.lit(0)).unionByName(described.withColumn("rank", F.lit(1)))
    whole = materialize(_emoji(rows))  # read three times
    distinct = whole.groupBy("symbol").agg(F.count("*").alias("n"))
    forms = distinct.select("symbol", F.posexplode(F.array("symbol", without_selector(F.col("symbol")))).alias("bare", "form"))
    listed = ranked.select(F.col("symbol").alias("form"), "token", "rank")
    found = forms.join(listed, "form").groupBy("symbol").agg(F.min_by("token", F.struct("rank", "bare")).alias("token"))
    counts = materialize(distinct.join(found, "symbol", "left").withColumn("token", F.coalesce("token", F.lit(unknown))))
    sequences = hot_cold_join(whole, counts.select("symbol", "token"), "symbol", counts)
    # keys that are no emoji, as the map form takes them: behind any emoji that begins at the same place
    others = ranked.groupBy("symbol").agg(F.min_by("token", "rank").alias("token"))
    known = _known(_candidates(rows, others), others)
    columns = ["row", "start", "symbol", "token"]
    return sequences.select(*columns, F.lit(0).alias("prefer")).unionByName(known.select(*columns, F.lit(1).alias("prefer")))


def convert_emojis(
    df: DataFrame, row_id: str, text: str, emojis: DataFrame, names: DataFrame | None = None,
    unknown: str = config.UNKNOWN_EMOJI,
) -> DataFrame:
    """``df`` with the emoji in ``text`` replaced, as ``functions.symbols.convert_emojis`` does by maps.

    ``emojis`` holds (emoji, token), ``names`` (emoji, name), both of any size. An
    emoji is looked up as it is, then without variation selectors, then by name.
    """
    return _replaced(df, row_id, text, emoji_matches(df, row_id, text, emojis, names, unknown))


def symbol_count(matches: DataFrame, name: str) -> DataFrame:
    """One row: how many symbols a replacement pass converts."""
    return _settled(matches).agg(F.coalesce(F.sum(F.size("found")), F.lit(0)).cast("bigint").alias(name))
