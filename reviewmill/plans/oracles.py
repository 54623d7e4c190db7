"""The same queries as SQL over the same tables, for result checks."""

from __future__ import annotations

import re
import string

from reviewmill import config
from reviewmill.functions.symbols import CP1252_BYTES
from reviewmill.functions.text import HASHTAG, HTML_TAG, MENTION, UNSAFE, URL, WS
from reviewmill.plans import queries as Q

CFG = Q.CFG


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_quoted(v) for v in values) + ")"


def _values(mapping: dict[str, str]) -> str:
    return ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in mapping.items())


def _replace(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, {_quoted(pattern)}, {_quoted(by)}, 'g')"


# Scalar expressions as text, built like the column functions.


def strip_html(x: str) -> str:
    return _replace(x, HTML_TAG, " ")


def strip_urls(x: str) -> str:
    return _replace(x, URL, " ")


def strip_mentions(x: str) -> str:
    return _replace(x, MENTION, " ")


def unwrap_hashtags(x: str) -> str:
    return _replace(x, HASHTAG, r" \1 ")


def collapse_ws(x: str) -> str:
    return f"trim({_replace(x, f'[{WS}]+', ' ')})"


def strip_markup(x: str) -> str:
    return unwrap_hashtags(strip_mentions(strip_urls(strip_html(x))))


def clean_structure(x: str) -> str:
    return collapse_ws(_replace(f"lower({strip_markup(x)})", UNSAFE, " "))


def safe_token(x: str) -> str:
    dashed = f"replace(lower({x}), '-', '_')"
    return collapse_ws(f"replace({_replace(dashed, UNSAFE, ' ')}, ' ', '_')")


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, {_quoted(f'[^{WS}]')}))"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {_quoted(f'[^{WS}]+')}))"


def with_emoji(x: str) -> str:
    for word, emoji in Q.EMOJI_FOR.items():
        x = f"replace({x}, {_quoted(f' {word} ')}, {_quoted(f' {emoji} ')})"
    return x


def display(x: str, default: str | None = None) -> str:
    return f"CASE WHEN {x} IN ('0', '0.0') THEN 'Negatif' WHEN {x} IN ('1', '1.0') THEN 'Positif' ELSE {default or x} END"


def weave(x: str, pattern: str, token_case: str) -> str:
    """Gaps and replaced matches, alternating; ``token_case`` is SQL over the match ``m``."""
    p = _quoted(pattern)
    return (
        f"array_to_string(list_transform(list_zip(string_split_regex({x}, {p}), list_append(list_transform("
        f"regexp_extract_all({x}, {p}), lambda m: ' ' || ({token_case}) || ' '), '')), lambda z: z[1] || z[2]), '')"
    )


def runs_to(x: str, n: int) -> str:
    for letter in string.ascii_lowercase:
        x = f"regexp_replace({x}, '{letter}{{3,}}', '{letter * n}', 'g')"
    return x


HAS_RUN = "(" + "|".join(f"{c}{c}{c}" for c in string.ascii_lowercase) + ")"
_LEET_CASES = " ".join(
    f"WHEN '{d}' THEN [{', '.join(_quoted(o) for o in letters)}]" for d, letters in config.LEET.items()
)
READINGS = (
    "list_distinct(list_reduce(list_prepend([''], list_transform(string_split(token, ''), "
    f"lambda c: CASE c {_LEET_CASES} ELSE [c] END)), lambda acc, opts: flatten(list_transform("
    f"acc, lambda p: list_transform(opts, lambda o: p || o)))))"
)


def lcs(a: str, b: str) -> str:
    return (
        f"list_reduce(list_prepend([0 for z in range(0, length({b}) + 1)], [[i::bigint] for i in range(1, length({a}) + 1)]), "
        "lambda r, ii: list_reduce(list_prepend([0::bigint], "
        f"[[j::bigint] for j in range(1, length({b}) + 1)]), lambda acc, jj: list_append(acc, "
        f"CASE WHEN {a}[ii[1]] = {b}[jj[1]] THEN r[jj[1]] + 1 ELSE greatest(r[jj[1] + 1], acc[jj[1]]) END)))[-1]"
    )


def similar(source: str, ratio: float, threshold: float, contained: bool) -> str:
    """Every (token, word, score) above a threshold by comparing whole blocks."""
    near = (
        f"abs(length(t.token) - length(d.word)) <= greatest(1, floor(length(t.token) * {ratio})::int) "
        f"AND t.token[1] = d.word[1]"
    )
    ratio_ok = "greatest(length(t.token), length(d.word)) * 2 >= least(length(t.token), length(d.word)) * 3"
    extra = f"""
        UNION ALL SELECT t.token, d.word, 90.0::double AS score FROM (SELECT DISTINCT token FROM {source}) t
        JOIN dict d ON {near} WHERE {ratio_ok} AND (contains(t.token, d.word) OR contains(d.word, t.token))""" if contained else ""
    return f"""
        SELECT token, word, score FROM (
            SELECT token, word, (1 - (length(token) + length(word) - 2 * {lcs("token", "word")}) / (length(token) + length(word))) * 100 AS score
            FROM (SELECT t.token, d.word FROM (SELECT DISTINCT token FROM {source}) t JOIN dict d ON {near}
                  WHERE levenshtein(t.token, d.word) <= floor((length(t.token) + length(d.word)) * {100 - threshold} / 100.0 + 1e-9))
        ) WHERE score >= {threshold} - 1e-9 {extra}"""


PROTECTED = f"(token IN {_list((*config.SPECIAL_TOKENS, *Q.NEGATIONS))} OR contains(token, '_'))"


def excluded(x: str) -> str:
    return f"({x} IN {_list(config.SPECIAL_TOKENS)} OR contains({x}, '_'))"


def _choices(found: str) -> str:
    """Rank candidates per token and rule, as the normaliser does."""
    return f"""
        SELECT token, rule, word, row_number() OVER (
            PARTITION BY token, rule ORDER BY score DESC, length(candidate), length(word), word) AS place
        FROM ({found})"""


_STEM_PREFIX, _STEM_SUFFIX = (_quoted(a) for a in Q.AFFIXES)

CTES = {
    "tok": """SELECT id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (
        SELECT doc_id AS id, regexp_extract_all(lower(text), '[a-z0-9_]+') AS t FROM documents)""",
    "dfreq": "SELECT token, count(DISTINCT id) AS df, count(*) AS n FROM tok GROUP BY token",
    "dict": """SELECT token AS word FROM dfreq
        WHERE regexp_full_match(token, '[a-z]{4,}') AND df * 50 >= (SELECT count(*) FROM documents)""",
    "stops": "SELECT token AS word FROM dfreq WHERE df * 2 > (SELECT count(*) FROM documents)",
    "effective_stops": f"SELECT word FROM stops WHERE word NOT IN {_list(Q.NEGATIONS)}",
    "slang": f"SELECT * FROM (VALUES {_values(Q.SLANG)}) v(token, target)",
    "looked": f"""SELECT v.token, CASE WHEN {PROTECTED.replace('token', 'v.token')} THEN 'protected'
            WHEN s.target IS NOT NULL THEN 'slang' WHEN d.word IS NOT NULL THEN 'dictionary' END AS source,
            CASE WHEN NOT {PROTECTED.replace('token', 'v.token')} AND s.target IS NOT NULL THEN s.target ELSE v.token END AS looked
        FROM dfreq v LEFT JOIN slang s ON v.token = s.token LEFT JOIN dict d ON v.token = d.word""",
    "residue": "SELECT token FROM looked WHERE source IS NULL",
    "rep_cands": f"""SELECT DISTINCT token, 0 AS rule, unnest([token, {runs_to('token', 1)}, {runs_to('token', 2)}]) AS candidate
        FROM residue WHERE regexp_matches(token, {_quoted(HAS_RUN)})""",
    "leet_cands": f"""SELECT DISTINCT token, 1 AS rule, unnest([r, {runs_to('r', 1)}, {runs_to('r', 2)}]) AS candidate
        FROM (SELECT token, unnest({READINGS}) AS r FROM residue
              WHERE regexp_matches(token, '[0-9]') AND regexp_matches(token, '[a-z]'))""",
    "cands": "SELECT * FROM rep_cands UNION ALL SELECT * FROM leet_cands",
    "cand_exact": "SELECT c.token, c.rule, c.candidate, c.candidate AS word, 100.0::double AS score FROM cands c JOIN dict d ON c.candidate = d.word",
    "cand_open": """SELECT c.* FROM cands c ANTI JOIN cand_exact e ON c.token = e.token AND c.rule = e.rule
        WHERE regexp_full_match(c.candidate, '[a-z]+')""",
    "spellings": "SELECT DISTINCT candidate AS token FROM cand_open",
    "cand_similar": similar("spellings", CFG.candidate_length_ratio, CFG.repeat_threshold, True),
    "all_cands": f"""SELECT DISTINCT token, 0 AS rule, unnest([token, {runs_to('token', 1)}, {runs_to('token', 2)}]) AS candidate FROM dfreq""",
    "all_exact": "SELECT c.*, c.candidate AS word, 100.0::double AS score FROM all_cands c JOIN dict d ON c.candidate = d.word",
    "all_open": """SELECT c.* FROM all_cands c ANTI JOIN all_exact e ON c.token = e.token WHERE regexp_full_match(c.candidate, '[a-z]+')""",
    "all_spellings": "SELECT DISTINCT candidate AS token FROM all_open",
    "all_similar": similar("all_spellings", CFG.candidate_length_ratio, CFG.repeat_threshold, True),
    "typo_tokens": "SELECT token FROM residue WHERE regexp_full_match(token, '[a-z]{4,}')",
    "typo_similar": similar("typo_tokens", CFG.typo_length_ratio, CFG.typo_threshold, False),
    "typo_ranked": """SELECT token, word, score, row_number() OVER (
        PARTITION BY token ORDER BY round(score, 9) DESC, length(word), word) AS place FROM typo_similar""",
    "typos": f"""SELECT token, arg_min(word, place) AS word FROM typo_ranked
        WHERE place <= {CFG.typo_rank} AND abs(length(word) - length(token)) <= 1 GROUP BY token""",
    "found_exact": f"SELECT token, rule, word FROM ({_choices('SELECT * FROM cand_exact')}) WHERE place = 1",
    "found": f"""SELECT token, rule, word FROM ({_choices('''SELECT * FROM cand_exact UNION ALL
            SELECT o.token, o.rule, o.candidate, s.word, round(s.score, 9) AS score
            FROM cand_open o JOIN cand_similar s ON o.candidate = s.token''')}) WHERE place = 1
        UNION ALL SELECT token, 2 AS rule, word FROM typos""",
    "decided_exact": """SELECT l.token, coalesce(f.word, l.looked) AS normalized,
            coalesce(l.source, ['repeated', 'leet'][f.rule + 1], 'not_found') AS source
        FROM looked l LEFT JOIN (SELECT token, min(rule) AS rule, arg_min(word, rule) AS word FROM found_exact GROUP BY token) f USING (token)""",
    "decided": """SELECT l.token, coalesce(f.word, l.looked) AS normalized,
            coalesce(l.source, ['repeated', 'leet', 'typo'][f.rule + 1], 'not_found') AS source
        FROM looked l LEFT JOIN (SELECT token, min(rule) AS rule, arg_min(word, rule) AS word FROM found GROUP BY token) f USING (token)""",
}


def _stems(vocab: str) -> str:
    return f"""SELECT v.token, coalesce(s.stem, v.token) AS stem FROM (SELECT DISTINCT token FROM {vocab}) v LEFT JOIN (
        SELECT f.token, arg_min(f.form, struct_pack(a := -length(f.form), b := f.form)) AS stem
        FROM (SELECT token, unnest([regexp_replace(token, {_STEM_SUFFIX}, ''), regexp_replace(token, {_STEM_PREFIX}, ''),
                regexp_replace(regexp_replace(token, {_STEM_PREFIX}, ''), {_STEM_SUFFIX}, '')]) AS form
              FROM (SELECT DISTINCT token FROM {vocab}) WHERE NOT {excluded('token')} AND token NOT IN (SELECT word FROM dict)) f
        JOIN dict d ON f.form = d.word WHERE f.form <> f.token GROUP BY f.token) s USING (token)"""


def _rule_stems(vocab: str) -> str:
    """All derivations of all tokens by all rules; the shortest, then the one by the first rules."""
    rules = ", ".join(f"({i}, {', '.join(_quoted(x) for x in r[:4])}, {r[4]})" for i, r in enumerate(Q.AFFIX_RULES))
    return f"""SELECT v.token, coalesce(s.stem, v.token) AS stem FROM {vocab} v LEFT JOIN (
        WITH RECURSIVE rules AS (SELECT * FROM (VALUES {rules}) r(place, prefix, suffix, head, tail, least)),
        derived AS (
            SELECT token, token AS form, []::INTEGER[] AS path FROM {vocab} WHERE NOT {excluded('token')} AND token NOT IN (SELECT word FROM dict)
            UNION ALL
            SELECT token, head || substr(form, length(prefix) + 1, length(form) - length(prefix) - length(suffix)) || tail, list_append(path, place)
            FROM derived JOIN rules ON starts_with(form, prefix) AND ends_with(form, suffix)
                AND length(form) - length(prefix) - length(suffix) >= least
            WHERE form NOT IN (SELECT word FROM dict))
        SELECT token, arg_min(form, struct_pack(a := len(path), b := path)) AS stem FROM derived JOIN dict ON form = word GROUP BY token
        ) s ON v.token = s.token"""


def _cleaning(kind: str) -> dict[str, str]:
    d = f"decided{kind}"
    return {
        f"norm{kind}": f"SELECT DISTINCT normalized AS token FROM {d}",
        f"stems{kind}": _stems(f"norm{kind}"),
        f"struct{kind}": f"""SELECT id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (
            SELECT doc_id AS id, regexp_extract_all({clean_structure(collapse_ws(strip_markup('text')))}, '[a-z0-9_]+') AS t FROM documents)""",
        f"kept{kind}": f"""SELECT t.id, t.pos, d.normalized AS token, s.stem FROM struct{kind} t JOIN {d} d ON t.token = d.token
            JOIN stems{kind} s ON d.normalized = s.token
            WHERE {excluded('d.normalized')} OR (length(d.normalized) >= 2 AND d.normalized NOT IN (SELECT word FROM effective_stops))""",
        f"near{kind}": f"""SELECT *, lead(token) OVER w AS nxt, lag(token) OVER w AS prv FROM kept{kind}
            WINDOW w AS (PARTITION BY id ORDER BY pos)""",
        f"merged{kind}": f"""SELECT id, pos, CASE WHEN {_joins('token', 'nxt')} THEN token || '_' || nxt
                WHEN {_joins('prv', 'token')} THEN NULL ELSE stem END AS word FROM near{kind}""",
        f"cleaned{kind}": f"""SELECT doc_id AS id, coalesce(trim(t), '') AS clean_text FROM documents LEFT JOIN (
            SELECT id, string_agg(word, ' ' ORDER BY pos) AS t FROM merged{kind} WHERE word IS NOT NULL GROUP BY id) m ON doc_id = id""",
    }


def _joins(left: str, right: str) -> str:
    return (
        f"coalesce({left} IN {_list(Q.NEGATIONS)} AND {right} NOT IN {_list(Q.NEGATIONS)} "
        f"AND {right} NOT IN {_list(config.SPECIAL_TOKENS)}, false)"
    )


CTES |= _cleaning("") | _cleaning("_exact")


def _model(prefix: str, docs: str, train: str, score: str) -> dict[str, str]:
    """TF-IDF and Naive Bayes over ``docs`` (id, label, text); fit on ``train``, score ``score``."""
    p = prefix
    grams = lambda source: f"""SELECT id, term, count(*) AS tf FROM (
        SELECT id, unnest(w) AS term FROM {source} UNION ALL
        SELECT id, unnest(list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda z: z[1] || ' ' || z[2])) AS term
        FROM {source} WHERE len(w) >= 2) GROUP BY id, term"""  # noqa: E731
    return {
        f"{p}_train": f"SELECT id, label, regexp_extract_all(text, '[a-z0-9_]{{2,}}') AS w FROM ({train})",
        f"{p}_score": f"SELECT id, regexp_extract_all(text, '[a-z0-9_]{{2,}}') AS w FROM ({score})",
        f"{p}_counts": grams(f"{p}_train"),
        f"{p}_vocab": f"""SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM (
            SELECT term, count(*) AS df, (SELECT count(*) FROM {p}_train) AS n FROM {p}_counts GROUP BY term)
            WHERE df >= {CFG.min_df} AND df <= {CFG.max_df} * n""",
        f"{p}_raw": f"SELECT id, term, tf, tf * idf AS raw FROM {p}_counts JOIN {p}_vocab USING (term)",
        f"{p}_weights": f"SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM {p}_raw",
        f"{p}_sums": f"""SELECT label, term, sum(weight) AS s FROM {p}_weights JOIN {p}_train USING (id) GROUP BY label, term""",
        f"{p}_theta": f"""SELECT l.label, v.term, ln((coalesce(s.s, 0) + 1.0) / (t.total + (SELECT count(*) FROM {p}_vocab))) AS log_prob
            FROM (SELECT DISTINCT label FROM {p}_train) l CROSS JOIN {p}_vocab v
            LEFT JOIN {p}_sums s ON s.label = l.label AND s.term = v.term
            JOIN (SELECT label, sum(s) AS total FROM {p}_sums GROUP BY label) t ON t.label = l.label""",
        f"{p}_priors": f"SELECT label, ln(count(*) / (SELECT count(*) FROM {p}_train)) AS log_prior FROM {p}_train GROUP BY label",
        f"{p}_sraw": f"SELECT id, term, tf * idf AS raw FROM ({grams(f'{p}_score')}) JOIN {p}_vocab USING (term)",
        f"{p}_sweights": f"SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM {p}_sraw",
        f"{p}_dots": f"SELECT id, label, sum(weight * log_prob) AS dot FROM {p}_sweights JOIN {p}_theta USING (term) GROUP BY id, label",
        f"{p}_joint": f"""SELECT s.id, p.label, p.log_prior + coalesce(d.dot, 0) AS score FROM {p}_score s CROSS JOIN {p}_priors p
            LEFT JOIN {p}_dots d ON d.id = s.id AND d.label = p.label""",
        f"{p}_proba": f"""SELECT id, label, score, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY id) AS proba
            FROM (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM {p}_joint)""",
        f"{p}_pred": f"""SELECT id, arg_max(label, struct_pack(a := score, b := -label)) AS prediction, max(proba) AS confidence
            FROM {p}_proba GROUP BY id""",
    }


def _all_grams(source: str) -> str:
    return f"""SELECT id, term, count(*) AS tf FROM (
        SELECT id, unnest(w) AS term FROM {source} UNION ALL
        SELECT id, unnest(list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda z: z[1] || ' ' || z[2])) FROM {source} WHERE len(w) >= 2)
        GROUP BY id, term"""


def _split(prefix: str, source: str) -> dict[str, str]:
    p = prefix
    return {
        f"{p}quotas": f"""SELECT label, whole + CASE WHEN row_number() OVER (ORDER BY exact - whole DESC, label) <= tests - sum(whole) OVER ()
                THEN 1 ELSE 0 END AS quota FROM (
            SELECT label, n * tests / total AS exact, floor(n * tests / total) AS whole, tests FROM (
                SELECT quality AS label, count(*) AS n, (SELECT count(*) FROM {source}) AS total,
                    ceil({CFG.test_size}::double * (SELECT count(*) FROM {source})) AS tests FROM {source} GROUP BY quality))""",
        f"{p}split": f"""SELECT doc_id, quality, row_number() OVER (
                PARTITION BY quality ORDER BY md5('{CFG.seed}|' || doc_id::varchar), doc_id) <= quota AS is_test
            FROM {source} JOIN {p}quotas ON quality = {p}quotas.label""",
    }


CTES |= _split("", "labelled") | _split("first_", "firsts")
CTES |= {
    "labelled": "SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)",
    "reviews": "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
    "lines": """SELECT doc_id, unnest(range(len(t))) AS line_no, unnest(t) AS text FROM (
        SELECT doc_id, string_split(text, chr(10)) AS t FROM documents)""",
    "structured": f"SELECT doc_id AS id, quality AS label, {clean_structure('text')} AS text FROM labelled",
    "struct_split": "SELECT s.*, split.is_test FROM structured s JOIN split ON s.id = split.doc_id",
    "train_split": "SELECT id, label, text FROM struct_split WHERE NOT is_test",
    "all_structured": f"SELECT doc_id AS id, {clean_structure('text')} AS text FROM documents",
    "full_split": "SELECT c.id, c.clean_text AS text, f.quality AS label, f.is_test FROM cleaned c JOIN first_split f ON c.id = f.doc_id",
    "firsts": "SELECT min(doc_id) AS doc_id, quality FROM labelled GROUP BY text, quality",
    "pairs": "SELECT quality AS actual, 1 - toxic AS predicted FROM labels",
    "matrix": """SELECT a.x AS actual, p.x AS predicted, count(t.actual) AS n FROM (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) p(x)
        LEFT JOIN pairs t ON t.actual = a.x AND t.predicted = p.x GROUP BY a.x, p.x""",
}
CTES |= _model("m", "structured", "SELECT id, label, text FROM structured", "SELECT id, text FROM structured")
CTES |= _model("s", "struct_split", "SELECT * FROM train_split", "SELECT id, text FROM all_structured")


def _metrics(source: str) -> str:
    return f"""SELECT coalesce(count(*) FILTER (actual = predicted) / nullif(count(*), 0), 0) AS accuracy,
        coalesce(count(*) FILTER (actual = 1 AND predicted = 1) / nullif(count(*) FILTER (predicted = 1), 0), 0) AS precision,
        coalesce(count(*) FILTER (actual = 1 AND predicted = 1) / nullif(count(*) FILTER (actual = 1), 0), 0) AS recall,
        coalesce(2 * count(*) FILTER (actual = 1 AND predicted = 1) / nullif(count(*) FILTER (predicted = 1) + count(*) FILTER (actual = 1), 0), 0) AS f1
        FROM {source}"""


def _report(matrix: str) -> str:
    per = f"""SELECT l.x AS label, sum(n) FILTER (actual = l.x AND predicted = l.x) AS hit, sum(n) FILTER (predicted = l.x) AS guessed,
        sum(n) FILTER (actual = l.x) AS support FROM (VALUES (0), (1)) l(x) CROSS JOIN ({matrix}) GROUP BY l.x"""
    scores = f"""SELECT label, support, coalesce(hit / nullif(guessed, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r,
        coalesce(2 * hit / nullif(guessed + support, 0), 0) AS f FROM ({per})"""
    acc = f"(SELECT sum(n) FILTER (actual = predicted) / sum(n) FROM ({matrix}))"
    return f"""SELECT label::varchar AS row, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support::bigint AS support FROM ({scores})
        UNION ALL SELECT 'accuracy', round({acc}, 4), round({acc}, 4), round({acc}, 4), sum(support)::bigint FROM ({scores})
        UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), sum(support)::bigint FROM ({scores})
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 4), round(sum(r * support) / sum(support), 4),
            round(sum(f * support) / sum(support), 4), sum(support)::bigint FROM ({scores})"""


CTES |= _model("f", "full_split", "SELECT id, label, text FROM full_split WHERE NOT is_test", "SELECT id, text FROM full_split WHERE is_test")
CTES |= {
    "clean_labelled": "SELECT c.id, l.quality AS label, c.clean_text AS text FROM cleaned_exact c JOIN labels l ON c.id = l.doc_id",
    "chat": """SELECT conv_id || '-' || turn || '-' || line_no AS key, text FROM (
        SELECT conv_id, turn, unnest(range(len(t))) AS line_no, unnest(t) AS text FROM (
            SELECT conv_id, turn, string_split(text, chr(10)) AS t FROM conversations))""",
    # Cleaning of the conversation lines with the vocabulary of the documents plus their own tokens.
    "chat_tok": f"""SELECT id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (
        SELECT key AS id, regexp_extract_all({clean_structure(collapse_ws(strip_markup('text')))}, '[a-z0-9_]+') AS t
        FROM chat WHERE NOT {is_blank('text')})""",
}


def _renamed(name: str) -> str:
    return f"chat_{name}"


def _chat_ctes() -> dict[str, str]:
    """The exact cleaning rules again, for the tokens of the conversation lines."""
    chain = ["looked", "residue", "rep_cands", "leet_cands", "cands", "cand_exact", "found_exact", "decided_exact",
             "norm_exact", "stems_exact", "kept_exact", "near_exact", "merged_exact"]
    result = {"chat_vocab": "SELECT token, count(*) AS n FROM chat_tok GROUP BY token"}
    for name in chain:
        sql = CTES[name].replace("FROM struct_exact", "FROM chat_tok").replace("FROM dfreq v", "FROM chat_vocab v")
        for other in chain:
            sql = re.sub(rf"\b(FROM|JOIN) {other}\b", rf"\1 {_renamed(other)}", sql)
        result[_renamed(name)] = sql
    result["chat_clean"] = f"""SELECT key AS id, coalesce(trim(t), '') AS text FROM chat LEFT JOIN (
        SELECT id, string_agg(word, ' ' ORDER BY pos) AS t FROM chat_merged_exact WHERE word IS NOT NULL GROUP BY id) m ON key = id
        WHERE NOT {is_blank('chat.text')}"""
    return result


CTES |= _chat_ctes()
CTES |= _model("b", "clean_labelled", "SELECT * FROM clean_labelled", "SELECT id, text FROM chat_clean")


_SOURCE = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_]+)\b")


def _sql(body: str) -> str:
    """``body`` with the shared tables it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_SOURCE.findall(text)):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed) + "\n" + body


def _digest(*columns: str) -> str:
    parts = [f"coalesce(length({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in columns]
    return "sha256(" + " || ".join(parts) + ")"


def _table_print(table: str, *columns: str) -> str:
    sums = " || '|' || ".join(
        f"sum(('0x' || substr(h, {8 * i + 1}, 8))::bigint)::hugeint::varchar" for i in range(8)
    )
    return f"SELECT 'documents' AS name, sha256(count(*)::varchar || '|' || {sums}) AS sha FROM (SELECT {_digest(*columns)} AS h FROM {table})"


def _tree_level(level: int, below: str, place: str) -> str:
    return f"SELECT {level} AS level, left({place}, {level}) AS path, sum(n)::bigint AS n, sha256(string_agg({place} || sha, '|' ORDER BY {place})) AS sha FROM {below} GROUP BY 2"


def _key_prints(key: str, table: str, *columns: str) -> str:
    """The key digests of a table with one row for each key."""
    words = " || '|' || ".join(f"(('0x' || substr(h, {8 * i + 1}, 8))::bigint)::varchar" for i in range(8))
    return f"""SELECT sha256({key}::varchar) AS place, {key}::varchar AS name, 1 AS n, sha256('1|' || {words}) AS sha
        FROM (SELECT {key}, {_digest(*columns)} AS h FROM {table})"""


def _per_text(expr, table: str, key: str, column: str) -> str:
    return f"SELECT {key}, {expr(column)} AS result FROM {table}"


def _length_stats(expr: str) -> str:
    return f"""SELECT min(x)::bigint AS min, max(x)::bigint AS max, round(avg(x), 6) AS mean, round(median(x), 6) AS median
        FROM (SELECT {expr} AS x FROM documents)"""


_EMOTICON_CASES = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in Q.EMOTICONS.items())
# What each symbol put into the texts becomes, by hand; ★ and ✓ are no emoji.
_EMOJI_TOKENS = {
    "👩‍💻": "woman_technologist", "👍🏽": "deskripsi_emoji", "❤️": "positif", "😍": "positif", "😡": "negatif", "🐱": "cat_face",
    "🚀": "deskripsi_emoji", "©": "deskripsi_emoji",
}


def _emoji_to_tokens(x: str) -> str:
    for emoji, token in _EMOJI_TOKENS.items():
        x = f"replace({x}, '{emoji}', ' {token} ')"
    return x


def _count_of(x: str, parts) -> str:
    return " + ".join(f"(length({x}) - length(replace({x}, {_quoted(p)}, ''))) // length({_quoted(p)})" for p in parts)


_BROKEN = "array_to_string(list_transform(string_split(t, ''), lambda c: {bytes}), '')"
# Emoticons by hand, longest first, as one alternation.
_EMOTICON_PATTERN = "|".join(re.escape(k) for k in sorted(Q.EMOTICONS, key=lambda k: (-len(k), k)))
_EMOJI_TEXT = with_emoji("text")
_CP = "".join(CP1252_BYTES.values())
# A character's UTF-8 bytes, each read as one Latin-1 character.
_BYTES = """CASE WHEN unicode(c) < 128 THEN c
    WHEN unicode(c) < 2048 THEN chr(192 + unicode(c) // 64) || chr(128 + unicode(c) % 64)
    WHEN unicode(c) < 65536 THEN chr(224 + unicode(c) // 4096) || chr(128 + unicode(c) // 64 % 64) || chr(128 + unicode(c) % 64)
    ELSE chr(240 + unicode(c) // 262144) || chr(128 + unicode(c) // 4096 % 64) || chr(128 + unicode(c) // 64 % 64) || chr(128 + unicode(c) % 64) END"""

_DESCRIBE_TEXT = """SELECT '{c}' AS "column", count({c})::bigint AS "count", count(DISTINCT {c})::bigint AS "unique",
    (SELECT {c} FROM reviews WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
    (SELECT count(*) FROM reviews WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq,
    NULL::double AS mean, NULL::double AS std, NULL::double AS min, NULL::double AS q25, NULL::double AS q50, NULL::double AS q75, NULL::double AS max FROM reviews"""
_DESCRIBE_NUMBER = """SELECT '{c}', count({c})::bigint, NULL::bigint, NULL::varchar, NULL::bigint, round(avg({c}), 6), round(stddev_samp({c}), 6),
    min({c})::double, round(quantile_cont({c}::double, 0.25), 6), round(quantile_cont({c}::double, 0.5), 6), round(quantile_cont({c}::double, 0.75), 6), max({c})::double FROM reviews"""
_NUMBERS = ("doc_id", "n_chars", "quality", "toxic")
_REVIEW_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"}

_BINS = CFG.histogram_bins
_CHECKS = f"""SELECT unnest([
    {{'check': 'null', 'column': 'text', 'n': count(*) FILTER (text IS NULL), 'severity': 'failure'}},
    {{'check': 'null', 'column': 'quality', 'n': count(*) FILTER (quality IS NULL), 'severity': 'failure'}},
    {{'check': 'blank', 'column': 'text', 'n': count(*) FILTER (text IS NOT NULL AND {is_blank('text')}), 'severity': 'failure'}},
    {{'check': 'blank', 'column': 'quality', 'n': 0, 'severity': 'failure'}},
    {{'check': 'duplicate_rows', 'column': '*', 'n': count(*) - count(DISTINCT (text, quality)), 'severity': 'warning'}}]) AS r
    FROM lines LEFT JOIN labels USING (doc_id)"""
_RAW_LABELS = "SELECT doc_id, coalesce(' ' || quality::varchar || chr(9), lang) AS label FROM reviews"
_LABEL_TRIM = f"regexp_replace(label, {_quoted(f'^[{WS}]+|[{WS}]+$')}, '', 'g')"

ORACLES: dict[str, str] = {
    "read_reviews": "SELECT text, coalesce(quality, -1)::varchar AS sentiment, lang FROM reviews",
    "union_datasets": "SELECT doc_id, lang, text FROM documents UNION ALL BY NAME SELECT conv_id, role, text FROM conversations",
    "write_predictions": f"SELECT doc_id, text, {display('quality::varchar')} AS sentimen, 'Berhasil' AS status FROM reviews",
    "save_model": "SELECT label, round(log_prior, 6) AS log_prior FROM m_priors",
    "load_model": "SELECT label, term, round(log_prob, 6) AS log_prob FROM m_theta",
    "fingerprint": "SELECT doc_id::varchar AS name, sha256(text) AS sha FROM documents",
    "table_fingerprint": _table_print("documents", "doc_id", "text", "lang"),
    "part_digests": f"""WITH k AS ({_key_prints('doc_id', 'documents', 'doc_id', 'text', 'lang')}),
        l2 AS ({_tree_level(2, 'k', 'place')}), l1 AS ({_tree_level(1, 'l2', 'path')}), l0 AS ({_tree_level(0, 'l1', 'path')})
        SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2""",
    "changed_keys": """SELECT doc_id::varchar AS name, CASE WHEN l.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS status
        FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labelled) l USING (doc_id) WHERE l.doc_id IS NULL OR d.doc_id % 7 = 0""",
    "compatibility_check": """SELECT name, s.sha AS stored, c.sha AS current, CASE WHEN s.sha IS NOT DISTINCT FROM c.sha THEN 'ok' ELSE 'retrain' END AS status
        FROM (SELECT doc_id::varchar AS name, sha256(text) AS sha FROM documents) s FULL JOIN (
            SELECT doc_id::varchar AS name, sha256(CASE WHEN lang = 'en' THEN text ELSE text || '!' END) AS sha FROM labelled) c USING (name)""",
    "model_metadata": f"""SELECT '1.0.0' AS model_version, (SELECT count(*) FROM labelled) AS data_count,
        (SELECT string_agg(quality || ':' || n, ',' ORDER BY quality) FROM (SELECT quality, count(*) AS n FROM labelled GROUP BY quality)) AS label_distribution,
        (SELECT 'documents:' || sha FROM ({_table_print('documents', 'doc_id', 'text', 'lang')})) AS checksums,
        round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        'tfidf,naive_bayes' AS pipeline_steps FROM ({_metrics('(SELECT quality AS actual, 1 - toxic AS predicted FROM labelled)')})""",
    "read_lexicons": f"""SELECT DISTINCT lower({_replace('text', f'^[{WS}]+|[{WS}]+$', '')}) AS word FROM lines
        WHERE NOT {is_blank('text')} AND NOT starts_with({_replace('text', f'^[{WS}]+|[{WS}]+$', '')}, '#')""",
    "build_dictionary": """SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS word FROM (
        SELECT text FROM documents UNION ALL SELECT text FROM conversations)""",
    "build_stopwords": f"""SELECT token AS word FROM dfreq EXCEPT SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) FROM benchmark
        EXCEPT SELECT unnest({list(Q.NEGATIONS)})""",
    "score_emojis": """SELECT unnest([e, replace(e, chr(65039), '')]) AS emoji, round(s, 6) AS score,
        CASE WHEN s >= 0.05 THEN 'positif' WHEN s <= -0.05 THEN 'negatif' ELSE 'netral' END AS token FROM (
        SELECT 'u' || user_id || '_' || event_type || chr(65039) AS e,
            (count(*) FILTER (value >= 60) - count(*) FILTER (value < 50)) / greatest(count(*), 1) AS s FROM events GROUP BY ALL)""",
    "drop_missing_required": f"SELECT doc_id, line_no, quality FROM lines JOIN labels USING (doc_id) WHERE NOT {is_blank('text')} AND quality IS NOT NULL",
    "normalize_labels": f"SELECT doc_id, {_LABEL_TRIM}::int AS label FROM ({_RAW_LABELS}) WHERE regexp_full_match({_LABEL_TRIM}, '[+-]?[0-9]+')",
    "label_violations": f"""SELECT 'not_integer' AS problem, label AS value, count(*) AS n FROM ({_RAW_LABELS})
        WHERE NOT regexp_full_match({_LABEL_TRIM}, '[+-]?[0-9]+') GROUP BY label""",
    "label_distribution_raw": "SELECT quality AS label, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY quality",
    "conflict_texts": "SELECT text, count(DISTINCT source) AS n_labels FROM documents GROUP BY text HAVING count(DISTINCT source) > 1",
    "conflict_audit": """SELECT text, string_agg(source || ':' || n, ',' ORDER BY source) AS counts,
        (CASE WHEN count(*) FILTER (n = top) = 1 THEN sum(n) - max(n) ELSE sum(n) END)::bigint AS removed,
        CASE WHEN count(*) FILTER (n = top) = 1 THEN 'drop_minority_keep_' || arg_max(source, n) ELSE 'drop_all_tie' END AS action
        FROM (SELECT text, source, count(*) AS n, max(count(*)) OVER (PARTITION BY text) AS top FROM documents GROUP BY text, source)
        GROUP BY text HAVING count(*) > 1""",
    "resolve_conflicts": """SELECT doc_id, source FROM documents d JOIN (
        SELECT text, count(*) AS labels, count(*) FILTER (n = top) AS modes, arg_max(source, n) AS best FROM (
            SELECT text, source, count(*) AS n, max(count(*)) OVER (PARTITION BY text) AS top FROM documents GROUP BY text, source)
        GROUP BY text) a USING (text) WHERE labels = 1 OR (modes = 1 AND source = best)""",
    "drop_exact_duplicates": """SELECT doc_id, source FROM (
        SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS r FROM documents) WHERE r = 1""",
    "file_report": """SELECT CASE lang WHEN 'en' THEN 'data1.csv' WHEN 'fr' THEN 'data2.csv' ELSE 'data3.csv' END AS file, count(*) AS n_rows,
        CASE min(lang) WHEN 'en' THEN 4 WHEN 'fr' THEN 3 ELSE 2 END::bigint AS n_columns, min(lang) IN ('en', 'fr') AS has_text, min(lang) <> 'fr' AS has_label,
        CASE WHEN min(lang) <> 'fr' THEN count(*) FILTER (quality IS NULL) END AS n_missing,
        CASE WHEN min(lang) <> 'fr' THEN count(*) FILTER (quality IS NULL) > 0 END AS has_missing,
        CASE min(lang) WHEN 'en' THEN '' WHEN 'fr' THEN 'missing column sentiment' ELSE 'missing column text' END AS issues,
        CASE min(lang) WHEN 'en' THEN 'valid' ELSE 'problem' END AS status FROM reviews GROUP BY 1""",
    "file_label_counts": "SELECT source AS file, quality AS label, count(*) AS n FROM reviews GROUP BY source, quality",
    "strict_validation": f'SELECT r."check" AS "check", r."column" AS "column", r.n AS n, r.severity AS severity FROM ({_CHECKS})',
    "column_unique_check": f"""SELECT CASE WHEN value = '' THEN 'blank' ELSE 'duplicate' END AS violation, value, count(*) AS n FROM (
        SELECT {_replace('text', f'^[{WS}]+|[{WS}]+$', '')} AS value FROM lines) GROUP BY value HAVING value = '' OR count(*) > 1""",
    "allowed_values_check": "SELECT lang AS value, count(*) AS n FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY lang",
    "not_constant_check": """SELECT 'lang' AS "column", count(*) > 0 AND bool_and(lang IS NOT DISTINCT FROM 'en') AS failed FROM documents
        UNION ALL SELECT 'kind', count(*) > 0 FROM conversations""",
    "non_empty_check": "SELECT doc_id AS file FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "required_columns_check": """SELECT * FROM (VALUES ('data2.csv', 'sentiment'), ('data3.csv', 'text'), ('data3.csv', 'lang')) v(file, missing_column)
        WHERE (SELECT count(DISTINCT CASE WHEN lang IN ('en', 'fr') THEN lang ELSE '' END) FROM documents) = 3""",
    "blank_entry_check": f"""SELECT doc_id AS row_id, count(*) AS n_entries, count(*) FILTER ({is_blank('s')}) AS n_blank, 'list' AS kind
        FROM (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), '.')) AS s FROM documents)
        GROUP BY doc_id HAVING count(*) FILTER ({is_blank('s')}) > 0
        UNION ALL SELECT doc_id, count(*), count(*) FILTER ({is_blank('v')}), 'map' AS kind
        FROM (SELECT doc_id, substr(text, strpos(text || ' ', ' ') + 1) AS v FROM lines)
        GROUP BY doc_id HAVING count(*) FILTER ({is_blank('v')}) > 0""",
    "text_marker_check": f"SELECT doc_id AS row_id, marker FROM documents, (SELECT unnest({list(Q.MARKERS)}) AS marker) WHERE contains(text, marker)",
    "display_label": f"""SELECT doc_id, {display('quality::double::varchar')} AS shown, {display('coalesce(quality::varchar, lang)')} AS own_text,
        {display('quality::varchar', "'Unknown'")} AS known FROM reviews""",
    "invalid_text_mask": f"SELECT doc_id, line_no, {is_blank('text')} AS invalid FROM lines",
    "strip_html": _per_text(strip_html, "pages", "page_id", "html"),
    "strip_urls": _per_text(strip_urls, "pages", "page_id", "html"),
    "strip_mentions": _per_text(strip_mentions, "documents", "doc_id", "text"),
    "unwrap_hashtags": _per_text(unwrap_hashtags, "pages", "page_id", "html"),
    "collapse_ws": _per_text(collapse_ws, "documents", "doc_id", "text"),
    "remove_web_noise": _per_text(lambda x: collapse_ws(strip_markup(x)), "pages", "page_id", "html"),
    "convert_emoticons": _per_text(lambda x: weave(x, _EMOTICON_PATTERN, f"CASE m {_EMOTICON_CASES} END"), "pages", "page_id", "html"),
    "emoji_description": _per_text(lambda x: f"CASE WHEN {safe_token(x)} = '' THEN 'deskripsi_emoji' ELSE {safe_token(x)} END", "documents", "doc_id", "text"),
    "clean_structure": _per_text(clean_structure, "pages", "page_id", "html"),
    "repair_mojibake": f"""SELECT doc_id, CASE WHEN {_count_of('t', _EMOJI_TOKENS)} > {_count_of('b', ('©', '®'))} THEN t ELSE b END AS result
        FROM (SELECT doc_id, t, {_BROKEN.format(bytes=_BYTES)} AS b FROM (SELECT doc_id, {_EMOJI_TEXT} AS t FROM documents))""",
    "convert_emojis": f"SELECT doc_id, {_emoji_to_tokens('t')} AS result FROM (SELECT doc_id, {_EMOJI_TEXT} AS t FROM documents)",
    "tokenize": "SELECT id, pos, token FROM tok",
    "emoji_emoticon_counts": f"""SELECT sum({_count_of('t', _EMOJI_TOKENS)})::bigint AS n_emoji,
        sum(len(regexp_extract_all(t, {_quoted(_EMOTICON_PATTERN)})))::bigint AS n_emoticon FROM (SELECT {with_emoji('html')} AS t FROM pages)""",
    "clean_text": "SELECT id, clean_text FROM cleaned_exact",
    "clean_text_fuzzy": "SELECT id, clean_text FROM cleaned",
    "protected_tokens": f"SELECT token, token AS normalized, 'protected' AS source FROM dfreq WHERE {PROTECTED}",
    "slang_lookup": "SELECT token, target AS normalized, 'slang' AS source FROM dfreq JOIN slang USING (token)",
    "dictionary_lookup": "SELECT token, token AS normalized, 'dictionary' AS source FROM dfreq SEMI JOIN dict ON token = word",
    "repeat_candidates": f"""SELECT DISTINCT token, unnest([token, {runs_to('token', 1)}, {runs_to('token', 2)}]) AS candidate
        FROM dfreq WHERE regexp_matches(token, {_quoted(HAS_RUN)})""",
    "leet_candidates": f"""SELECT DISTINCT token, candidate FROM (
        SELECT token, unnest([r, {runs_to('r', 1)}, {runs_to('r', 2)}]) AS candidate FROM (
            SELECT token, unnest({READINGS}) AS r FROM (
                SELECT token FROM dfreq UNION SELECT translate(token, '{Q.DISGUISE}', '011435678') FROM dfreq)
            WHERE regexp_matches(token, '[0-9]') AND regexp_matches(token, '[a-z]')))
        JOIN dict ON candidate = word""",
    "dictionary_block": f"""SELECT v.token, count(d.word) AS n_words FROM dfreq v LEFT JOIN dict d ON v.token[1] = d.word[1]
        AND abs(length(v.token) - length(d.word)) <= greatest(1, floor(length(v.token) * {CFG.typo_length_ratio})::int) GROUP BY v.token""",
    "fuzzy_score": f"SELECT token, word, round(score, 6) AS score FROM ({similar('dfreq', CFG.typo_length_ratio, CFG.typo_threshold, True)})",
    "best_dictionary_candidate": f"""SELECT token, word FROM ({_choices("""SELECT * FROM all_exact UNION ALL
        SELECT o.token, o.rule, o.candidate, s.word, round(s.score, 9) AS score FROM all_open o JOIN all_similar s ON o.candidate = s.token""")}) WHERE place = 1""",
    "typo_correction": f"""SELECT token, arg_min(word, place) AS word FROM (
        SELECT token, word, row_number() OVER (PARTITION BY token ORDER BY round(score, 9) DESC, length(word), word) AS place
        FROM ({similar("(SELECT token FROM dfreq WHERE regexp_full_match(token, '[a-z]{4,}') AND token NOT IN (SELECT word FROM dict))", CFG.typo_length_ratio, CFG.typo_threshold, False)}))
        WHERE place <= {CFG.typo_rank} AND abs(length(word) - length(token)) <= 1 GROUP BY token""",
    "normalize_vocab": "SELECT token, normalized, source FROM decided",
    "normalize_vocab_exact": "SELECT token, normalized, source FROM decided_exact",
    "filter_tokens": f"""SELECT id, pos, token FROM tok WHERE {excluded('token')} OR (length(token) >= 2 AND token NOT IN (SELECT word FROM stops))""",
    "combine_negations": f"""SELECT id, pos, word AS token FROM (
        SELECT id, pos, CASE WHEN {_joins('token', 'nxt')} THEN token || '_' || nxt WHEN {_joins('prv', 'token')} THEN NULL ELSE token END AS word
        FROM (SELECT *, lead(token) OVER w AS nxt, lag(token) OVER w AS prv FROM tok WINDOW w AS (PARTITION BY id ORDER BY pos))) WHERE word IS NOT NULL""",
    "stem_tokens": f"SELECT token, stem FROM ({_stems('dfreq')})",
    "stem_tokens_rules": f"SELECT token, stem FROM ({_rule_stems('dfreq')})",
    "remembered_decisions": """SELECT t.token, d.normalized, d.source, s.stem, t.token NOT IN (SELECT token FROM tok JOIN documents ON id = doc_id WHERE lang IS NOT DISTINCT FROM 'en') AS fresh
        FROM (SELECT DISTINCT token FROM tok JOIN documents ON id = doc_id WHERE lang IS DISTINCT FROM 'en') t
        JOIN decided_exact d ON t.token = d.token JOIN stems_exact s ON d.normalized = s.token""",
    "rebuild_text": "SELECT id, string_agg(token, ' ' ORDER BY pos) AS clean_text FROM tok GROUP BY id",
    "normalization_stats": """SELECT unnest(['tokens_checked', 'typo_fixed', 'typo_not_found', 'leet_fixed', 'repeated_fixed', 'slang_normalized', 'cache_hit', 'cache_miss']) AS stat,
        coalesce(unnest([sum(n), sum(n) FILTER (source = 'typo'), sum(n) FILTER (source = 'not_found'), sum(n) FILTER (source = 'leet'),
            sum(n) FILTER (source = 'repeated'), sum(n) FILTER (source = 'slang'), sum(n) - count(*), count(*)]), 0)::bigint AS n
        FROM dfreq JOIN decided USING (token)""",
    "count_tokens": f"SELECT count(*) AS total, count(DISTINCT t) AS \"unique\" FROM (SELECT unnest(regexp_extract_all(text, {_quoted(f'[^{WS}]+')})) AS t FROM documents)",
    "stratified_split": "SELECT doc_id, quality, is_test FROM split",
    "vectorizer_tokens": "SELECT id, unnest(range(len(w))) AS pos, unnest(w) AS token FROM s_score",
    "ngrams_1_2": f"SELECT id, term, tf AS n FROM ({_all_grams('s_score')})",
    "document_frequency": "SELECT term, df FROM m_vocab",
    "tf": "SELECT id, term, tf FROM m_raw",
    "idf_smooth": "SELECT term, df, round(idf, 6) AS idf FROM m_vocab",
    "tfidf_l2": "SELECT id, term, round(weight, 6) AS weight FROM m_weights",
    "nb_priors": "SELECT label, round(log_prior, 6) AS log_prior FROM m_priors",
    "nb_fit": "SELECT label, term, round(log_prob, 6) AS log_prob FROM m_theta",
    "nb_predict": "SELECT id, prediction FROM s_pred",
    "nb_predict_proba": "SELECT id, label, round(proba, 6) AS proba FROM s_proba",
    "confidence_level": "SELECT id, CASE WHEN confidence >= 0.85 THEN 'Sangat Yakin' WHEN confidence >= 0.65 THEN 'Cukup Yakin' ELSE 'Kurang Yakin' END AS level FROM s_pred",
    "batch_score": f"""SELECT key, text, {display('prediction::varchar')} AS sentimen, round(confidence, 6) AS tingkat_keyakinan,
        CASE WHEN {is_blank('text')} THEN 'Teks kosong, tidak diprediksi' ELSE 'Berhasil' END AS status FROM chat LEFT JOIN b_pred ON key = id""",
    "prediction_history": """SELECT event_type AS sentimen, count(*) AS n, min(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS first,
        max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS last FROM events GROUP BY event_type""",
    "prediction_counts": "SELECT event_type AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM events WHERE event_type IS NOT NULL), 6) AS share FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
    "binary_metrics": f"SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({_metrics('pairs')})",
    "confusion_matrix": "SELECT actual, predicted, n FROM matrix",
    "classification_report": _report("SELECT * FROM matrix"),
    "evaluate_model": f"""SELECT *, (SELECT count(*) FROM split WHERE NOT is_test) AS train_size, (SELECT count(*) FROM split WHERE is_test) AS test_size
        FROM ({_report('''SELECT a.x AS actual, p.x AS predicted, count(t.id) AS n FROM (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) p(x)
            LEFT JOIN (SELECT s.id, quality, prediction FROM s_pred s JOIN split ON s.id = split.doc_id WHERE is_test) t
            ON t.quality = a.x AND t.prediction = p.x GROUP BY a.x, p.x''')})""",
    "train_and_evaluate": "SELECT f.id, label, prediction, round(confidence, 6) AS confidence FROM f_pred f JOIN full_split USING (id)",
    "dataset_shape": "SELECT count(DISTINCT source) AS n_files, count(*) AS n_rows, 6::bigint AS n_columns FROM documents",
    "data_size": """SELECT round(b / 1024, 6) AS kb, round(b / 1024 / 1024, 6) AS mb FROM (
        SELECT sum(strlen(text) + strlen(lang) + strlen(source)) AS b FROM documents)""",
    "missing_values": "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n, round(count(*) FILTER ({c} IS NULL) * 100 / count(*), 2) AS pct FROM reviews" for c in _REVIEW_TYPES) + ")",
    "duplicate_rows": """SELECT count(*) - count(DISTINCT (text, lang, quality)) AS n,
        round((count(*) - count(DISTINCT (text, lang, quality))) * 100 / count(*), 2) AS pct FROM reviews""",
    "duplicate_examples": "SELECT doc_id, lang FROM (SELECT *, count(*) OVER (PARTITION BY text, lang) AS c FROM documents) WHERE c > 1 ORDER BY doc_id LIMIT 10",
    "char_length_stats": _length_stats("length(text)"),
    "word_count_stats": _length_stats(words("text")),
    "unique_texts": "SELECT count(DISTINCT text) AS n_unique, count(*) - count(DISTINCT text) AS n_duplicate FROM documents",
    "longest_reviews": "SELECT doc_id AS row_id, text, length(text) AS n_chars FROM documents ORDER BY length(text) DESC, doc_id LIMIT 3",
    "shortest_reviews": "SELECT doc_id AS row_id, text, length(text) AS n_chars FROM documents ORDER BY length(text), doc_id LIMIT 3",
    "label_balance": """SELECT a AS n_negative, b AS n_positive, round(a * 100 / (a + b), 6) AS pct_negative, round(b * 100 / (a + b), 6) AS pct_positive,
        round(greatest(a, b) / least(a, b), 6) AS imbalance, c AS n_labels, a = b AS balanced FROM (
        SELECT count(*) FILTER (quality = 0) AS a, count(*) FILTER (quality = 1) AS b, count(DISTINCT coalesce(quality, -1)) AS c FROM reviews)""",
    "dataset_sample": "SELECT doc_id, text, quality FROM reviews ORDER BY doc_id LIMIT 50",
    "describe_all": " UNION ALL ".join(
        [_DESCRIBE_TEXT.format(c=c) for c in ("text", "lang", "source")] + [_DESCRIBE_NUMBER.format(c=c) for c in _NUMBERS]),
    "dataset_info": "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, '{'categorical' if t == 'string' else 'numeric'}' AS kind, count({c}) AS non_null FROM reviews" for c, t in _REVIEW_TYPES.items()) + ")",
    "dataset_summary": """SELECT count(*) AS total, count(*) FILTER (quality = 1) AS positive, count(*) FILTER (quality = 0) AS negative,
        count(*) FILTER (quality IS NULL) AS missing, count(*) - count(DISTINCT (text, lang, source, quality)) AS duplicate,
        round(sum(strlen(text) + strlen(lang) + strlen(source) + coalesce(length(quality::varchar), 0)) / 1048576, 6) AS size_mb FROM reviews""",
    "chart_label_distribution": """SELECT 0::bigint AS place, 'Positif' AS label, count(*) FILTER (quality = 1) AS n FROM reviews
        UNION ALL SELECT 1, 'Negatif', count(*) FILTER (quality = 0) FROM reviews""",
    "chart_histogram": f"""SELECT b AS bin, round(lo + b * w, 6) AS lo, round(lo + (b + 1) * w, 6) AS hi, (
            SELECT count(*) FROM (SELECT {words('text')} AS x FROM documents) WHERE least({_BINS - 1}, (x - lo::bigint) * {_BINS} // (hi - lo)::bigint) = b) AS n
        FROM (SELECT unnest(range({_BINS})) AS b, lo, hi, (hi - lo) / {_BINS} AS w FROM (
            SELECT min({words('text')})::double AS lo, max({words('text')})::double AS hi FROM documents))""",
    "chart_boxplot": f"""SELECT q[1] AS q1, q[2] AS median, q[3] AS q3, min(x) FILTER (i) AS lo, max(x) FILTER (i) AS hi, count(*) FILTER (NOT i) AS n_outliers FROM (
        SELECT x, q, x >= q[1] - 1.5 * (q[3] - q[1]) AND x <= q[3] + 1.5 * (q[3] - q[1]) AS i FROM (SELECT {words('text')} AS x FROM documents),
            (SELECT quantile_cont({words('text')}::double, [0.25, 0.5, 0.75]) AS q FROM documents)) GROUP BY q""",
    "chart_top_words": f"""SELECT token AS word, count(*) AS n FROM tok WHERE {excluded('token')} OR (length(token) >= 2 AND token NOT IN (SELECT word FROM stops))
        GROUP BY token ORDER BY count(*) DESC, min(struct_pack(a := id, b := pos)) LIMIT {CFG.top_words}""",
    "chart_confusion": f"SELECT {display('actual::varchar')} AS actual, {display('predicted::varchar')} AS predicted, n FROM matrix",
    "chart_metrics": f"SELECT metric, round(value, 3) AS value FROM (UNPIVOT ({_metrics('pairs')}) ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)",
}
# the table forms give what the map forms give
ORACLES |= {f"{name}_table": ORACLES[name] for name in ("convert_emoticons", "convert_emojis", "emoji_emoticon_counts")}
ORACLES = {name: _sql(body) for name, body in ORACLES.items()}
