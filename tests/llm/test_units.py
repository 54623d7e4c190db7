import string

from reviewmill.llm import units


def plain(line):
    return " ".join(line.lower().translate(str.maketrans(dict.fromkeys(string.punctuation, " "))).split())


def brute(texts):
    first, out = {}, {}
    for i, text in sorted(texts, key=lambda x: x[0]):
        lines = (text or "").split("\n")
        kept = []
        for k, line in enumerate(lines):
            if plain(line) and first.setdefault(plain(line), (i, k)) != (i, k):
                continue
            kept.append(line + ("\n" if k < len(lines) - 1 else ""))
        out[i] = (sum(1 for x in lines if plain(x)), "".join(kept) if text is not None else None)
    return out


def test_lines_against_brute_force(spark, documents):
    texts = [
        (5, "One line.\nTwo lines!\none  LINE\n\n***\nlast"), (1, "two lines\nown"), (9, None), (7, ""),
        (8, "***\n***\n"), (2, "own\nOWN\nnew é\n"), (4, "last\n" * 3), (3, "x" * 50_000 + "\nlast"),
    ]
    found = units.remove_repeated_units(documents([(i, t, "s") for i, t in texts])).collect()
    assert {r.doc_id: (r.n_units, r.kept_text) for r in found} == brute(texts)
    by = {r.doc_id: r for r in found}
    text = dict(texts)
    for r in found:
        for span in r.removed:
            assert plain(text[r.doc_id][span.start : span.stop]) == plain(
                [u for u in text[span.first_key].split("\n") if u][span.first_unit]
            )
    assert by[9].n_removed == 0 and by[2].n_removed == 2


def test_paragraphs(spark, documents):
    docs = documents([(1, "a\nb\n\nc d", "s"), (2, "C  d.\n\nA\nB\n\ne", "s")])
    found = {r.doc_id: r for r in units.remove_repeated_units(docs, pattern=units.PARAGRAPH).collect()}
    assert found[1].n_removed == 0 and found[1].n_units == 2
    assert found[2].n_removed == 2 and found[2].kept_text.strip() == "e"


def test_repeated_rows_null_keys_and_empty_table(spark, documents):
    docs = documents([(1, "same line", "s"), (1, "same line", "s"), (None, "same line", "s")])
    found = sorted((r.doc_id or 0, r.n_removed) for r in units.remove_repeated_units(docs).collect())
    assert found == [(0, 1), (1, 0), (1, 0)]
    assert units.remove_repeated_units(documents([])).count() == 0


def brute_sentences(texts, least):
    """(n_removed, n_repeated, kept_text) by the rule: repeats in stretches of neighbours with enough words go."""
    cut = {i: [(m.span(), plain(m.group())) for m in units.SENTENCE.finditer(t or "") if plain(m.group())] for i, t in texts}
    first, count = {}, {}
    for i in sorted(cut):
        for k, (_, p) in enumerate(cut[i]):
            first.setdefault(p, (i, k))
            count[p] = count.get(p, 0) + 1

    def long_enough(flags, sentences):
        out, run = [False] * len(flags), []
        for k, flag in enumerate([*flags, False]):
            if flag:
                run.append(k)
            elif run:
                if sum(len(sentences[j][1].split()) for j in run) >= least:
                    for j in run:
                        out[j] = True
                run = []
        return out

    result = {}
    for i, text in texts:
        gone = long_enough([first[p] != (i, k) for k, (_, p) in enumerate(cut[i])], cut[i])
        again = long_enough([count[p] > 1 for _, p in cut[i]], cut[i])
        kept, at = "", 0
        for ((begin, end), _), g in zip(cut[i], gone, strict=True):
            if g:
                kept, at = kept + text[at:begin], end
                at += int((begin == 0 or text[begin - 1] == "\n") and text[end : end + 1] == "\n")
        words = sum(len(p.split()) for (_, p), a in zip(cut[i], again, strict=True) if a)
        result[i] = (sum(gone), words, text if text is None else kept + text[at:])
    return result


def test_passages_inside_lines(spark, documents, prose):
    own = __import__("random").Random(6)

    def sentences(n, seed):
        words = prose(n * 6, seed=seed).split()
        return " ".join(" ".join(words[6 * k : 6 * k + own.randrange(2, 7)]) + own.choice([".", "!", "?\n", ".\n"]) for k in range(n))

    passages = [sentences(9, 50 + k) for k in range(4)]
    stock = ["And so on.", "Thank you!", "All rights reserved."]
    texts = [(0, None), (1, ""), (2, "...!?")]
    for i in range(3, 60):
        parts = [sentences(own.randrange(1, 5), 900 + i), own.choice(stock), sentences(2, 1900 + i)]
        if own.random() < 0.4:
            parts.insert(1, "in the middle of " + own.choice(passages) + " and on")
        if own.random() < 0.1:
            parts = [passages[0] * 2]
        texts.append((i, " ".join(parts)))
    docs = documents([(i, t, "s") for i, t in texts])
    found = units.remove_repeated_units(docs, pattern=units.SENTENCE, least_words=20).collect()
    got = {r.doc_id: (r.n_removed, r.n_repeated, r.kept_text) for r in found}
    assert got == brute_sentences(texts, 20)
    planted = {i for i, t in texts if t and any(p[20:] in t for p in passages)}
    assert {i for i, r in got.items() if r[1]} == planted
    assert {i for i, r in got.items() if r[0]} < planted
