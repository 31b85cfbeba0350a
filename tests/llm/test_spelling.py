import random
import re
import zlib
from collections import Counter

import pytest
from wardflow.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, min_length=7, ratio=10, every=31):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_length:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    links = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(links[w]), n.get(form[w])) for w in n}


def variants(rnd, words, n_docs, spread):
    """Documents of words and of their misspellings, some of them much rarer than others."""
    pool = []
    for w in words:
        times = rnd.choice([2, 5, 25, 130, 600])
        pool += [w] * times
        for _ in range(spread):
            i, c = rnd.randrange(len(w)), rnd.choice("abcdxyzéÿÀ×")
            v = rnd.choice([w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + c + w[i:]])
            pool += [v] * rnd.choice([1, 2, 3, max(2, times // 10), max(2, times // 11)])
    rnd.shuffle(pool)
    step = max(1, len(pool) // n_docs)
    return [(i, rnd.choice([" ", "-", "ą", "\n"]).join(pool[i * step : (i + 1) * step])) for i in range(n_docs + 1)]


def result(df, **kw):
    return {tuple(r) for r in spelling.spelling_variants(df, **kw).collect()}


@pytest.mark.parametrize("group_rows", [20_000, 3])
def test_against_all_pairs(docs_of, group_rows):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcÉé") for _ in range(rnd.randint(7, 11))) for _ in range(25)]
    words += ["aaaaaaaa", "aaaaaaaaa", "aaaaaaaab", "Abababab", "bababab"]
    rows = variants(rnd, words, 120, 6)
    rows += [(900, None), (901, ""), (None, "aaaaaaaa " * 3), (5, rows[4][1])]
    want = plain(rows)
    assert result(docs_of(rows), group_rows=group_rows) == want
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)


def test_dense_neighbourhood_is_cut_until_small(docs_of):
    """Hundreds of words of the same halves: a third of all rows share a key."""
    rnd = random.Random(9)
    words = [f"common{a}{b}" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    words += [w + "s" for w in words[:40]] + ["".join(rnd.choice("qwertz") for _ in range(8)) for _ in range(100)]
    rows = [(i, " ".join(words)) for i in range(2)]
    for group_rows in (1, 50, 20_000):
        assert result(docs_of(rows), every=0, group_rows=group_rows) == plain(rows, every=0)


def test_short_words_and_long_chains(docs_of):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000, "aaaabbbb": 20000, "ab": 3, "a": 4, "abc": 50}
    rows = [(i, f"{w} " * n) for i, (w, n) in enumerate(counts.items())]
    assert result(docs_of(rows), every=0) == plain(rows, every=0)
    assert result(docs_of(rows), every=0, min_length=2) == plain(rows, every=0, min_length=2)
    assert ("aaaaaaaa", "aaaaaaab", "aaaabbbb", 2, 1, 20) in result(docs_of(rows), every=0)
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs_of(rows), min_length=1)


def test_edges(docs_of):
    assert result(docs_of([])) == set()
    assert result(docs_of([(1, None), (2, "short one")])) == set()
    long = "x" * 30_000
    rows = [(1, f"{long} {long} {long}y {long}y")]
    assert result(docs_of(rows), every=0) == {(long, None, long, 2, 1, None), (long + "y", None, long + "y", 2, 1, None)}


def test_group_bound():
    """A group is cut unless its interval is one character wide; then the alphabet bounds it."""
    group = spelling.Group(3, 1, 2, {"abc": 5, "adc": 7, "aec": 7}, {"abdc": 2})
    assert sorted(group.near()) == [("abc", 2, 7, "adc"), ("abdc", 1, 7, "adc"), ("adc", 3, 7, "aec"), ("aec", 2, 7, "adc")]
