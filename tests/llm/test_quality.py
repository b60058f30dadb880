import re
from collections import Counter

import pyarrow as pa

from factloom.llm import quality


def brute(text, min_repeat):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    covered, longest = set(), 0
    for i in range(len(words)):
        for j in range(i):
            n = 0
            while i + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            if n >= min_repeat:
                covered |= {*range(i, i + n), *range(j, j + n)}
                longest = max(longest, n)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_covered": len(covered),
        "longest_repeat": longest,
    }


def texts(rng, make):
    out = [None, "", "  \n", "a", "a b", "a b a b a b", "x " * 40, "é # é\né # é\n\n  \n \n", "a\x1cb\x0bc d"]
    for _ in range(40):
        base = make(rng.randint(5, 60)).split(" ")
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            i, n = rng.randrange(len(base)), rng.randint(1, 20)
            at = rng.randrange(len(text) + 1)
            text[at:at] = base[i : i + n]
        out.append(" ".join(text))
    for n in (2, 3):
        out.append(" ".join(rng.choice("abcd"[:n]) for _ in range(90)))
    return out


def test_measures_against_brute_force(rng, make):
    data = texts(rng, make)
    for least in (3, 6):
        got = quality.measure(pa.array(data, pa.string()), least)
        for k, t in enumerate(data):
            assert {c: int(got[c][k]) for c in quality.COLUMNS} == brute(t, least), t


def test_rules_and_filter(spark, documents, rng, make):
    good = make(300)
    junk = "spam ham " * 100
    half = make(128) + " " + " ".join([make(12)] * 9)
    rows = [(0, good), (1, junk), (2, "short text"), (3, None), (None, good), (5, half), (6, good), (6, good)]
    docs = documents(rows, extra=True)
    got = [(r.doc_id, r.base_failed, r.kept) for r in quality.rules(docs).collect()]
    want = [(0, False, True), (1, True, False), (2, True, False), (3, True, False), (None, False, True), (5, False, False), (6, False, True), (6, False, True)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "6", "6", "None"]
    assert quality.rules(documents([])).count() == 0


def test_long_repetitive_text(spark, documents, make):
    got = {r.doc_id: r for r in quality.rules(documents([(1, "a " * 100_000), (2, "b c d " * 30_000), (3, make(30_000))])).collect()}
    assert (got[1].n_words, got[1].n_covered, got[1].longest_repeat) == (100_000, 100_000, 99_999)
    assert (got[2].longest_repeat, got[2].kept) == (89_997, False) and got[3].kept and not got[3].longest_failed
