"""The same results in SQL, where SQL can express them over whole tables."""

from __future__ import annotations

_HOST = r"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"

_TERMS = (
    r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLES: dict[str, str] = {
    "op5_url_filter": f"""
        WITH parts AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
            END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN contains(host || path, 'casino') OR contains(host || path, 'free-bets') OR contains(host || path, 'cheap-pills') THEN 'block'
            ELSE 'allow'
        END AS verdict
        FROM ruled
    """,
    "op11_lexical_search": f"""
        WITH cut AS (
            SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("text")} AS words FROM documents
        ),
        held AS (SELECT r, doc_id, words, len(words) AS n FROM cut WHERE len(words) > 0),
        corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM held),
        tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM held) GROUP BY r, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, corpus GROUP BY term, docs
        ),
        asked AS (
            SELECT DISTINCT q, item_id, term
            FROM (SELECT row_number() OVER () AS q, item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark)
        ),
        scored AS (
            SELECT q, item_id, r, doc_id,
                CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN held USING (r), corpus
            GROUP BY q, item_id, r, doc_id
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place
            FROM scored WHERE score > 0
        )
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
    """,
}
