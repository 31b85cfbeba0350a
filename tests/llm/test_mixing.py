import numpy as np
import pytest
from pyspark.sql import functions as F
from wardflow.llm import mixing as M


def words():
    return F.coalesce(F.regexp_count("body", F.lit(r"\S+")), F.lit(0))


@pytest.fixture
def frame(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, source string, body string")
        return df.selectExpr("*", "1 as SOURCE", "2 as row", "3 as block", "4 as uses")

    return make


def corpus():
    rows, i = [], 0
    for s, n in (("big", 600), ("mid", 120), ("low", 40), (None, 25)):
        for k in range(n):
            rows.append((i, s, "w " * (1 + k * 7 % 13)))
            i += 1
    return rows


def test_power_by_bisection():
    tokens = np.array([600.0, 120.0, 40.0, 0.0])
    power = M.find_power(tokens, None, 0.9, None)
    assert abs(M.entropy(M.tempered(tokens / tokens.sum(), power)) - 0.9 * np.log(3)) < 1e-9
    power = M.find_power(tokens, None, None, 2.0)
    budget = M.budgets_for(M.tempered(tokens / tokens.sum(), power), tokens, None)
    assert abs((budget[:3] / tokens[:3]).max() - 2.0) < 1e-6 and abs((budget[:3] / tokens[:3]).min() - 1.0) < 1e-9
    assert M.find_power(tokens, None, None, 1.0) == pytest.approx(1.0)
    assert M.find_power(tokens, None, None, None) == pytest.approx(1.0)


@pytest.mark.parametrize("total,limit", [(None, 1.7), (2000, 1.2), (9000, None)])
def test_budgets_and_whole_passes(frame, total, limit):
    rows = corpus()
    df = frame(rows)
    got = M.mix_sources(df, words(), total_tokens=total, max_repeats=limit).collect()
    assert got[0].__fields__[: len(df.columns)] == df.columns
    size = {r[0]: len(r[2].split()) for r in rows}
    have, used = {}, {}
    for i, s, _ in rows:
        have[s] = have.get(s, 0) + size[i]
    seen = {}
    for r in got:
        used[r[1]] = used.get(r[1], 0) + size[r[0]]
        seen.setdefault(r["mix_epoch"], []).append(r[0])
    tokens = np.array([float(have[s]) for s in sorted(have, key=lambda s: (s is None, s or ""))])
    power = M.find_power(tokens, total, None, limit)
    budget = M.budgets_for(M.tempered(tokens / tokens.sum(), power), tokens, total)
    for s, b in zip(sorted(have, key=lambda s: (s is None, s or "")), budget, strict=True):
        assert b - 1 <= used[s] <= b + 14, (s, b, used[s])
    for epoch, ids in seen.items():
        assert len(ids) == len(set(ids))
        if epoch and total is None:
            assert set(ids) <= set(seen[epoch - 1])
    if total is None:
        assert set(seen[0]) == set(size)


def plain_uses(spark, rows, budgets, seed=17):
    """Uses of each row by the definition: blocks, parts and documents in their permuted orders."""
    def unit(*parts):
        return F.xxhash64(*parts)

    ids = spark.createDataFrame([(i, s, len(t.split())) for i, s, t in rows], "id long, s string, n long")
    draw = ids.select(
        "*",
        F.pmod(unit(F.lit(seed), "id"), F.lit(M.BLOCKS)).cast("int").alias("b"),
        F.pmod(unit(F.lit(seed), F.lit("part"), "id"), F.lit(M.PARTS)).cast("int").alias("q"),
        unit(F.lit(seed), F.lit("row"), "id").alias("r"),
    )
    draw = draw.select(
        "*", unit(F.lit(seed), F.lit("blocks"), "b").alias("bo"), unit(F.lit(seed), F.lit("parts"), "q").alias("qo")
    ).collect()
    uses = {}
    for source, budget in budgets.items():
        own = [d for d in draw if d["s"] == source]
        have = sum(d["n"] for d in own)
        passes, rest = divmod(int(round(budget)), have)
        blocks = {}
        for d in own:
            blocks.setdefault((d["bo"], d["b"]), []).append(d)
        total = 0
        for key in sorted(blocks):
            size = sum(d["n"] for d in blocks[key])
            if total >= rest or total + size <= rest:
                taken = {d["id"] for d in blocks[key]} if total < rest else set()
            else:
                taken, before, parts = set(), total, {}
                for d in blocks[key]:
                    parts.setdefault((d["qo"], d["q"]), []).append(d)
                for part in sorted(parts):
                    inner = sum(d["n"] for d in parts[part])
                    if before < rest and before + inner > rest:
                        at = before
                        for d in sorted(parts[part], key=lambda d: (d["r"], d["id"], d["n"])):
                            if at < rest:
                                taken.add(d["id"])
                            at += d["n"]
                    elif before < rest:
                        taken |= {d["id"] for d in parts[part]}
                    before += inner
            for d in blocks[key]:
                uses[d["id"]] = passes + (d["id"] in taken)
            total += size
    return uses


@pytest.mark.parametrize("blocks,parts,limit,few", [(256, 4096, 1.7, 200_000), (4, 8, 2.3, 0), (1, 3, 1.4, 200_000)])
def test_uses_equal_a_plain_version(spark, frame, monkeypatch, blocks, parts, limit, few):
    monkeypatch.setattr(M, "BLOCKS", blocks)
    monkeypatch.setattr(M, "BROADCAST_ROWS", few)
    monkeypatch.setattr(M, "PARTS", parts)
    rows = corpus()
    have = {}
    for _, s, t in rows:
        have[s] = have.get(s, 0) + len(t.split())
    names = sorted(have, key=lambda s: (s is None, s or ""))
    tokens = np.array([float(have[s]) for s in names])
    power = M.find_power(tokens, None, None, limit)
    budgets = dict(zip(names, M.budgets_for(M.tempered(tokens / tokens.sum(), power), tokens, None), strict=True))
    got = {}
    for r in M.mix_sources(frame(rows), words(), max_repeats=limit).collect():
        got[r[0]] = max(got.get(r[0], 0), r["mix_epoch"] + 1)
    want = {i: n for i, n in plain_uses(spark, rows, budgets).items() if n}
    assert got == want


def test_any_stretch_has_the_weights(frame):
    rows = [(i, "big" if i < 3000 else "low", "w " * 10) for i in range(4000)]
    got = M.mix_sources(frame(rows), words(), max_repeats=2.5).orderBy("mix_order", "doc_id").collect()
    low = [r[1] == "low" for r in got]
    share = sum(low) / len(low)
    assert max(r["mix_epoch"] for r in got) >= 2 - 1 and share > 0.3
    for at in range(0, len(low) - 500, 250):
        assert abs(sum(low[at : at + 500]) / 500 - share) < 0.12


def test_clashing_result_columns(spark):
    df = spark.createDataFrame([(1, "a", 5, "x", "y"), (2, "b", 3, "x", "y")], "doc_id long, source string, n long, mix_epoch string, Mix_Order string")
    got = M.mix_sources(df, F.col("n"), max_repeats=2.0)
    assert got.columns == ["doc_id", "source", "n", "mix_epoch", "mix_order"]
    assert {r["doc_id"] for r in got.collect()} == {1, 2}


def test_edges(frame):
    assert M.mix_sources(frame([]), words()).count() == 0
    rows = [(None, "a", "x y"), (1, None, None), (2, "z", ""), (3, "a", "long " * 20_000), (3, "a", "x")]
    got = M.mix_sources(frame(rows), words(), max_repeats=2.0).collect()
    assert {(r[0], r[1]) for r in got} == {(None, "a"), (1, None), (2, "z"), (3, "a")}
    again = M.mix_sources(frame(rows), words(), max_repeats=2.0).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    empty = M.mix_sources(frame([(1, "a", None), (2, "b", "")]), words()).collect()
    assert sorted(r[0] for r in empty) == [1, 2]
