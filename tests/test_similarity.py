"""Functions whose cost a row must stay small, against plain versions."""

import random

import numpy as np

from quern.functions import call, text


def _jaro(a, b):
    if not a and not b:
        return 1.0
    reach, taken, mine = max(max(len(a), len(b)) // 2 - 1, 0), [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    theirs, m = [c for c, t in zip(b, taken, strict=True) if t], len(mine)
    return (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2) / m) / 3 if m else 0.0


def _damerau(a, b):
    last, most = {}, len(a) + len(b)
    d = [[most] * (len(b) + 2)] + [[most, i, *[0] * len(b)] for i in range(len(a) + 1)]
    d[1] = [most, *range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        match = 0
        for j in range(1, len(b) + 1):
            k, l = last.get(b[j - 1], 0), match
            match = j if a[i - 1] == b[j - 1] else match
            d[i + 1][j + 1] = min(d[i][j] + (a[i - 1] != b[j - 1]), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][l] + i - k + j - l - 1)
        last[a[i - 1]] = i
    return d[-1][-1]


def test_pairs_of_texts_go_together(monkeypatch):
    rng = random.Random(5)
    word = lambda most: "".join(rng.choices("abcdé🤦\0", k=rng.randrange(most)))
    pairs = [(word(14), word(14)) for _ in range(1500)] + [("", ""), ("", "a"), ("a", ""), ("abc" * 50, "cab" * 40)]
    a, b = map(list, zip(*pairs, strict=True))
    assert text.jaro(a, b).tolist() == [_jaro(*p) for p in pairs]
    assert text.damerau(a, b).tolist() == [_damerau(*p) for p in pairs]
    monkeypatch.setattr(text, "PLACES", 2000)
    runs = text._slices(a, b)
    assert [i for s, e in runs for i in range(s, e)] == list(range(len(pairs))) and len(runs) > 50
    assert np.concatenate([text.damerau(a[s:e], b[s:e]) for s, e in runs]).tolist() == text.damerau(a, b).tolist()


def test_similarity_of_nulls(spark):
    rows = spark.createDataFrame([("ab", None), (None, "a"), ("ab", "ba"), (None, None)], "a string, b string")
    found = rows.select(*[call(n, "a", "b") for n in ("jaro_similarity", "jaro_winkler_similarity", "damerau_levenshtein")]).collect()
    assert [tuple(r) for r in found] == [(None,) * 3, (None,) * 3, (0.0, 0.0, 1), (None,) * 3]


def test_graphemes_of_ascii_are_cut_apart():
    rng = random.Random(3)
    for _ in range(3000):
        x = "".join(rng.choices(["a", "b", " ", "\r", "\n", "\0", "é", "e\u0301", "\u0301", "🤦🏼", "\u0600", "\u200d", "क्", "ष", "🇩", "🇪"], k=rng.randrange(12)))
        assert text.graphemes(x) == text.regex.findall(r"\X", x), ascii(x)
