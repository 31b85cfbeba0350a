import random

import numpy as np
import pytest
from wardflow.llm import suffix_dedup as S


def brute(rows, depth):
    """Removed bytes per (id, text) by the definition."""
    first, out = {}, []
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in sorted((r for r in data if r[0] is not None), key=lambda r: r[0]):
        for p in range(len(b) - depth + 1):
            first.setdefault(b[p : p + depth], i)
    for i, b in data:
        hit = [i is not None and first[b[p : p + depth]] < i for p in range(len(b) - depth + 1)]
        gone = [any(hit[max(0, q - depth + 1) : q + 1]) for q in range(len(b))]
        spans, q = [], 0
        while q < len(b):
            e = q
            while e < len(b) and gone[e]:
                e += 1
            if e > q:
                spans.append((q, e))
            q = max(e, q + 1)
        out.append((i, tuple(spans), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def operator(df, depth):
    rows = S.remove_repeats(df, min_bytes=depth).select("doc_id", "spans", "kept").collect()
    return sorted(((r[0], tuple((s[0], s[1]) for s in r[1]), bytes(r[2])) for r in rows), key=repr)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 5)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(30) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [text(rnd.randint(0, 40)) for _ in range(rnd.randint(1, 4))]
        if rnd.random() < 0.7:
            p = rnd.choice(passages)
            parts.insert(rnd.randint(0, len(parts)), p[rnd.randint(0, 30) : len(p) - rnd.randint(0, 30)])
        rows.append((i * 7 % 1009, " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed,depth", [(1, 20), (2, 50), (3, 7)])
def test_against_brute_force(docs_of, seed, depth):
    rows = corpus(seed)
    rows += [(2000, rows[3][1]), (2001, rows[3][1]), (2002, "ab" * 300), (2003, "xx" + "ab" * 100)]
    assert operator(docs_of(rows), depth) == brute(rows, depth)


def plain_starts(strings, docs, depth):
    least = {}
    for s, d in zip(strings, docs, strict=True):
        for p in range(len(s) - depth + 1):
            least[s[p : p + depth]] = min(d, least.get(s[p : p + depth], d))
    return [[p for p in range(len(s) - depth + 1) if least[s[p : p + depth]] < d] for s, d in zip(strings, docs, strict=True)]


@pytest.mark.parametrize("block", [50, 400, 4000])
def test_large_groups_are_parted_by_content(monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rnd = random.Random(block)
    phrase = b"all rights reserved by the owner"
    side = lambda k: bytes(rnd.choice(b"abc ") for _ in range(k))
    strings = [side(rnd.randint(0, 25)) + phrase + side(rnd.randint(0, 25)) for _ in range(150)]
    strings += [rnd.choice(strings)[rnd.randint(0, 4) :] for _ in range(80)] + [b"", b"short", "é".encode() * 40]
    docs = np.array([rnd.randint(0, 60) for _ in strings])
    for depth in (20, 40, 50):
        got = [x.tolist() for x in S.bounded_starts(strings, docs, depth)]
        assert got == plain_starts(strings, docs, depth)


def test_hot_phrase_in_bounded_memory():
    """One phrase in 60,000 stretches, each with other words around it, sorted in small blocks."""
    rnd = random.Random(3)
    sizes = []
    real = S.sorted_suffixes

    def counted(text, depth):
        sizes.append(len(text))
        return real(text, depth)

    letters = b"abcdefghijklmnopqrstuvwxyz "
    side = lambda: bytes(rnd.choices(letters, k=24))
    strings = [side() + b"this text is under a free licence" + side() for _ in range(60_000)]
    strings += strings[:500]
    docs = np.arange(len(strings))
    S.sorted_suffixes = counted
    try:
        got = S.bounded_starts(strings, docs, 50)
    finally:
        S.sorted_suffixes = real
    assert max(sizes) <= 3 * S.BLOCK and sum(map(len, strings)) > 8 * S.BLOCK
    want = plain_starts(strings, docs, 50)
    assert [x.tolist() for x in got] == want and all(want[-500:])


def test_edges(docs_of):
    long = "the quick brown fox jumps over the lazy dog and runs on and on into the dark woods"
    rows = [(5, long), (5, long), (5, long + "!"), (6, None), (7, ""), (None, long), (8, "x" + long), (9, long[:49]), (-1, long[:60])]
    assert operator(docs_of(rows), 50) == brute(rows, 50)
    assert operator(docs_of([]), 50) == []


def test_many_holders_and_long_text(docs_of):
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(200))
    rows = [(i, f"{i:05d}" + passage + "".join(rnd.choice("abcd") for _ in range(30))) for i in range(300)]
    rows.append((900, "".join(rnd.choice("abcdefgh") for _ in range(60_000)) + passage))
    assert operator(docs_of(rows), 50) == brute(rows, 50)


def test_whole_characters(docs_of):
    a, b = "é" * 40, "z" + "é" * 40 + "ü"
    rows = S.remove_repeats(docs_of([(1, "q" + a), (2, b)]), min_bytes=21, whole_characters=True).collect()
    for r in rows:
        bytes(r["kept"]).decode()


def test_interval_expansion_equals_sorted_prefixes():
    rnd = random.Random(4)
    for depth in (3, 8, 12):
        text = np.array([rnd.randint(1, 3) for _ in range(400)] + [0], np.uint8)
        order = S.sorted_suffixes(text, depth)
        raw = [bytes(text[i : i + depth]) for i in order]
        assert raw == sorted(raw)
        want = [True] + [x != y for x, y in zip(raw, raw[1:], strict=False)]
        assert S.boundaries(text, order, depth).tolist() == want


def test_minimizers_depend_on_content():
    rnd = random.Random(8)
    shared = bytes(rnd.choice(b"ab") for _ in range(70))
    seen = []
    for pad in (b"", b"x" * 13, b"ab" * 20):
        hashes, first, last = S.minimizers(pad + shared + pad, 50)
        of = {}
        for h, a, z in zip(hashes, first, last, strict=True):
            for p in range(a, z + 1):
                of[(pad + shared + pad)[p : p + 50]] = h
        seen.append([of[shared[p : p + 50]] for p in range(21)])
    assert seen[0] == seen[1] == seen[2]
