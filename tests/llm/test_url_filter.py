import fnmatch
import random
import re

import numpy as np
from check_oracles import compare, duck

from reviewmill.llm import url_filter
from reviewmill.llm.oracles import ORACLES
from reviewmill.llm.queries import QUERIES, URL_GLOBS, URL_RULES


def as_regex(glob):
    out = ""
    for part in re.findall(r"\*\*|\*|\?|[^*?]+", glob):
        out += {"**": "(?s:.*)", "*": "[^/]*", "?": "(?s:.)"}.get(part) or re.escape(part)
    return re.compile(out)


def test_automaton_against_regular_expressions():
    own = random.Random(1)
    patterns = ["".join(own.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(own.randrange(12))) for _ in range(80)]
    texts = ["".join(own.choice("ab/") for _ in range(own.randrange(14))) for _ in range(300)]
    automaton = url_filter.ShiftAnd(patterns)
    assert automaton.words > 1
    got = automaton.matches([t.encode() for t in texts])
    want = np.array([[bool(as_regex(p).fullmatch(t)) for p in patterns] for t in texts])
    assert (got == want).all()


def judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1])
    path = found[2]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    blocked = any(fnmatch.fnmatchcase(host + path, g.pattern.replace("**", "*")) for g in URL_GLOBS)
    return host, path, None, "block" if blocked else "allow"


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.COM", "http://a.com/", "http://com/", "http://notexample.com/en/", "x://example.com/en",
    "http://EXAMPLE.com/en/1", "http://www.example.com/en/1", "http://a.www.example.com/en/", "http://wwww.example.com/en/",
    "http://x.net/es/a?b#c", "http://net/fr/", "http://xnet/fr/", "http://x.org/y.example.com/en/", "http://casino.org", "http://é.org/casino",
    "http://a.org?x=http://b.com/", "a://b://c.com/", "http://x.org/\n/casino", "http://user:pw@a.com:80/p", "http://.com/", "http://É.COM/",
    "http://x.org/" + "a" * 5000 + "casino", "http://x.org/" + "b" * 5000,
]


def test_rules_globs_and_odd_urls(spark):
    pages = spark.createDataFrame(
        [(k, u, "h", "v") for k, u in enumerate(URLS)] + [(0, None, "h", "v")], "page_id int, url string, host string, verdict string"
    )
    found = url_filter.filter_urls(pages, "url", URL_RULES, URL_GLOBS).collect()
    assert len(found) == len(URLS) + 1
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == judge(r.url)
    assert url_filter.filter_urls(pages.limit(0), "url", URL_RULES, URL_GLOBS).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, "url", (), ()).collect()} == {"allow"}


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    verdict, detail = compare(QUERIES["op5_url_filter"](spark, folder), duck(folder), ORACLES["op5_url_filter"])
    assert verdict == "ok", detail
