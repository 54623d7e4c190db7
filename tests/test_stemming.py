"""Affix rules against a plain search over all derivations."""

import random

import pytest

from reviewmill.operators import stemming, vocabulary
from reviewmill.scale import materialize
from reviewmill.sources import lexicons

# (prefix, suffix, head, tail, least)
RULES = [
    ("", "nya", "", "", 3), ("", "kan", "", "", 3), ("", "an", "", "", 3), ("ke", "an", "", "", 3), ("per", "", "", "", 3),
    ("mem", "", "", "", 3), ("mem", "", "p", "", 3), ("men", "", "t", "", 3), ("meny", "", "s", "", 3), ("di", "", "", "", 3),
]
WORDS = ["main", "pukul", "tulis", "sapu", "adil", "rumah", "makan"]


def plain(token, rules, known):
    """(stem, steps) by trying everything, a level at a time."""
    level = [((), token)]
    while level:
        hits = [(path, form) for path, form in level if form in known]
        if hits:
            path, form = min(hits)
            return known[form], len(path)
        following = []
        for path, form in level:
            for place, (prefix, suffix, head, tail, least) in enumerate(rules):
                middle = form[len(prefix) : len(form) - len(suffix)]
                if form.startswith(prefix) and form.endswith(suffix) and len(form) - len(prefix) - len(suffix) >= least:
                    child = head + middle + tail
                    following.append(((*path, (place, child)), child))
        level = following
    return None


def run(spark, tokens, rules, known):
    table = spark.createDataFrame([(t,) for t in tokens], "token string")
    words = spark.createDataFrame(sorted(known.items()), "word string, stem string")
    found = stemming.stems_by_rules(table, stemming.affix_rules(spark, rules), words).collect()
    assert len({r.token for r in found}) == len(found)
    return {r.token: (r.stem, r.steps) for r in found}


def test_nested_recoded_and_joint_affixes(spark):
    known = {w: w for w in WORDS} | {"rumahan": "rumah"}
    found = run(spark, ["mempermainkannya", "memukul", "menulis", "menyapu", "keadilannya", "makan", "rumahannya", "qrs", None, ""], RULES, known)
    assert found == {
        "mempermainkannya": ("main", 4), "memukul": ("pukul", 1), "menulis": ("tulis", 1), "menyapu": ("sapu", 1),
        "keadilannya": ("adil", 2), "makan": ("makan", 0), "rumahannya": ("rumah", 1),
    }


def test_equals_a_search_over_all_derivations(spark):
    rng = random.Random(3)
    text = lambda low, high: "".join(rng.choice("ab") for _ in range(rng.randint(low, high)))
    rules = []
    while len(rules) < 14:
        prefix, suffix, head, tail = text(0, 2), text(0, 2), text(0, 1), text(0, 1)
        if len(head + tail) < len(prefix + suffix):
            rules.append((prefix, suffix, head, tail, rng.randint(1, 2)))
    known = {text(2, 4): text(1, 2) for _ in range(9)}
    tokens = {text(1, 9) for _ in range(250)}
    want = {t: p for t in tokens if (p := plain(t, rules, known))}
    assert run(spark, [*tokens, *tokens], rules, known) == want
    assert max(steps for _, steps in want.values()) > 2


def test_empty_tables_and_rules_that_do_not_shorten(spark):
    assert run(spark, [], RULES, {"a": "a"}) == {}
    assert run(spark, ["makan", "makannya"], [], {"makan": "makan"}) == {"makan": ("makan", 0)}
    assert run(spark, ["makannya"], RULES, {}) == {}
    with pytest.raises(ValueError, match="shorten"):
        stemming.affix_rules(spark, [("a", "", "b", "", 1)])


def test_rules_from_a_file_in_the_stemming_of_tokens(spark, tmp_path):
    (tmp_path / "rules.csv").write_text("place,prefix,suffix,head,tail,least\n0,,nya,,,3\n1,men,,t,,3\n2,di,,,,\n")
    rules = lexicons.read_affix_rules(spark, str(tmp_path / "rules.csv"))
    tokens = ["menulisnya", "ditulis", "tulis", "tidak_ditulis", "diam", "positif", "rumahnya"]
    vocab = spark.createDataFrame([(t,) for t in tokens], "token string")
    words = spark.createDataFrame([("tulis",)], "word string")
    roots = spark.createDataFrame([("rumah", "rumah"), ("tulis", "tidak")], "token string, root string")
    found = {r.token: r.stem for r in vocabulary.stem_tokens(vocab, roots, words, affixes=rules).collect()}
    assert found == {
        "menulisnya": "tidak", "ditulis": "tidak", "tulis": "tulis", "tidak_ditulis": "tidak_ditulis", "diam": "diam",
        "positif": "positif", "rumahnya": "rumah",
    }


def test_rules_meet_forms_by_equality(spark):
    forms = spark.createDataFrame([("makannya",)], "form string")
    plan = stemming.derive(forms, stemming.affix_rules(spark, RULES), [(0, 3), (2, 0)])._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_tokens_are_read_once_however_many_rounds_there_are(spark):
    tokens = spark.createDataFrame([("main",), ("mainan",)], "token string")
    words = spark.createDataFrame([("main", "main")], "word string, stem string")
    found = stemming.stems_by_rules(tokens, stemming.affix_rules(spark, RULES[2:3]), words)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert sorted((r.token, r.steps) for r in found.collect()) == [("main", 0), ("mainan", 1)]


def test_tables_of_tokens_are_not_broadcast(spark):
    tokens = materialize(spark.createDataFrame([(t,) for t in ("makannya", "makan", "zzz", "positif")], "token string"))
    words = materialize(spark.createDataFrame([("makan",)], "word string"))
    found = vocabulary.stem_tokens(tokens, None, words)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 2  # words are broadcast
    assert {r.token: r.stem for r in found.collect()} == {"makannya": "makan", "makan": "makan", "zzz": "zzz", "positif": "positif"}
