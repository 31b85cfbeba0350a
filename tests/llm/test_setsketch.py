import random

import numpy as np
import pytest
from wardflow.llm import setsketch as S
from wardflow.llm.components import connected_components


def brute(rows, words, percent=80):
    sets = {i: S.shingle_set(S.words_of(t or ""), words) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def corpus(seed, groups=12, size=12):
    """Groups of copies that differ in a growing number of words: many pairs near the threshold."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6)))
    rows, i = [], 0
    for _ in range(groups):
        base = [word() for _ in range(rnd.choice([3, 10, 40, 120]))]
        for k in range(size):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 8))):
                text[rnd.randrange(len(text))] = word()
            rows.append((i * 31 % 997, rnd.choice([" ", "\n", "\t "]).join(text)))
            i += 1
    return rows


@pytest.mark.parametrize("seed,words", [(1, 2), (2, 5)])
def test_against_all_pairs(docs_of, seed, words):
    rows = corpus(seed) + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "one two")]
    got = sorted(map(tuple, S.near_duplicates(docs_of(rows), words=words).collect()))
    assert got == brute(rows, words)


def test_chunks_of_large_groups(docs_of, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_CHUNK", 16)
    monkeypatch.setattr(S, "GROUP_CHUNK", 8)
    rows = corpus(3, groups=2, size=70)
    got = sorted(map(tuple, S.near_duplicates(docs_of(rows), words=2).collect()))
    assert got == brute(rows, 2)


def test_buckets_of_equal_sums_are_told_apart(spark, docs_of):
    ids = spark.range(6000).selectExpr("id", "shiftright(xxhash64(id), 24) as h").orderBy("id").collect()
    h = np.array([r["h"] for r in ids])
    i, j = np.triu_indices(len(h), 1)
    sums = h[i] + h[j]
    order = np.argsort(sums, kind="stable")
    same = np.flatnonzero(np.diff(sums[order]) == 0)
    pairs = [[(int(i[k]), int(j[k])) for k in (order[a], order[a + 1])] for a in same.tolist()]
    two = next(p for p in pairs if len({*p[0], *p[1]}) == 4)
    rows = []
    for n, (a, b) in enumerate(two):
        words = [f"w{n}x{k}" for k in range(400)]
        rows += [(a, " ".join(words)), (b, " ".join([*words, "end"]))]
    got = sorted(map(tuple, S.near_duplicates(docs_of(rows)).collect()))
    assert got == brute(rows, 5)


def test_edges(docs_of):
    assert S.near_duplicates(docs_of([])).count() == 0
    text = "a b c d e f g h"
    rows = [(3, text), (3, text), (None, text), (9, text), (5, None), (None, None), (7, "x " * 50_000)]
    got = sorted(map(tuple, S.near_duplicates(docs_of(rows)).collect()), key=repr)
    assert got == sorted(
        [(3, 4, 3, True)] * 2 + [(None, 4, 3, False), (9, 4, 3, False), (5, 0, 5, True), (None, 0, None, True), (7, 1, 7, True)],
        key=repr,
    )


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2600], rnd.integers(0, 1 << 63, 400, dtype=np.uint64)])
    one, two = S.Sketcher.registers(a), S.Sketcher.registers(b)
    both = S.Sketcher.registers(np.union1d(a, b))
    assert (S.merged(one, two) == both).all()
    true = 2600 / 3400
    assert S.reaches(one, 3000.0, two[None], np.array([3000.0]), true - 0.12).all()
    assert not S.reaches(one, 3000.0, two[None], np.array([3000.0]), true + 0.12).any()


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(90)]
    edges += [(5, 5), (None, 3), (7, None)] + [(400, 500 + i) for i in range(50)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = sorted((v, find(v)) for v in parent)
    assert sorted(map(tuple, connected_components(df).collect())) == want
    assert connected_components(df.limit(0)).count() == 0


def test_members_outside_the_main_class_of_a_large_group(docs_of, monkeypatch):
    """One class of close copies, stragglers that reach no copy or only each other, and a chain."""
    monkeypatch.setattr(S, "BUCKET_CHUNK", 16)
    monkeypatch.setattr(S, "GROUP_CHUNK", 8)
    base = [f"w{i}" for i in range(200)]
    rows = [(i * 7 % 101, " ".join([*base, f"end{i}"])) for i in range(60)]
    for k in range(20):  # shares 70 to 85 % of the shingles with the copies
        changed = 20 + 2 * k
        rows.append((200 + k, " ".join(base[changed:] + [f"s{k % 7}x{i}" for i in range(changed)])))
    for k in range(12):  # each links with the next, the first with the copies
        rows.append((300 - k, " ".join(base[8 * k :] + [f"c{i}" for i in range(8 * k)])))
    got = sorted(map(tuple, S.near_duplicates(docs_of(rows), words=2).collect()))
    assert got == brute(rows, 2)
    assert len({r[2] for r in got}) > 2


def test_texts_of_a_large_group_move_a_bounded_number_of_times(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_CHUNK", 10)
    rows = [(1, i, 1000, 40, i < 1000) for i in range(1040)]
    met = S._met_in_chunks(spark.createDataFrame(rows, "component long, rep long, n_main long, n_rest long, main boolean"))
    copies = {r["main"]: r["count"] for r in met.groupBy("main").count().collect()}
    assert copies == {True: 1000 * 4, False: 40 * (100 + 4 - 1)}
    pairs = {(r["low"], r["high"]) for r in met.select("low", "high").collect()}
    assert pairs == {(i, j) for i in range(104) for j in range(100, 104) if i < j}


def test_a_group_of_one_class_is_settled_by_the_first_look(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "GROUP_CHUNK", 10)
    members = spark.createDataFrame([(5, i, 30) for i in range(30)], "component long, rep long, n long")
    star = spark.createDataFrame([(0, i) for i in range(1, 30)], "a long, b long")
    assert S._open_members(members, star).count() == 0
    left = S._open_members(members, star.filter("b < 20"))
    assert {tuple(r) for r in left.select("n_main", "n_rest").collect()} == {(20, 10)}
    assert left.filter("main").count() == 20
    none = S._open_members(members, star.limit(0))
    assert {tuple(r) for r in none.select("n_main", "n_rest", "main").collect()} == {(0, 30, False)}
