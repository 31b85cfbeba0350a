import random

import corpus_pipeline as C
import numpy as np
import pytest
from wardflow.llm import packing, setsketch
from wardflow.session import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage of one run: (name, input rows, output frame)."""
    docs, out = C.table(spark, SF, "documents"), []
    # Documents of words of good ones in a new order, with one passage in common.
    good = docs.join(C.table(spark, SF, "labels").filter("quality = 1"), "doc_id", "left_semi")
    texts = [r["text"] for r in good.filter("lang = 'en'").orderBy("doc_id").collect()]
    words = " ".join(texts).split()
    rnd = random.Random(1)
    passage = " ".join(rnd.sample(words, 60))
    extra = [(10_000 + i, " ".join(rnd.sample(words, 81)) + " " + passage, "en", "src1", 0) for i in range(3)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for name, stage in C.STAGES:
        before = docs.collect()
        docs = materialise(stage(spark, docs, SF), "test")
        out.append((name, before, docs))
    return out


def test_columns_and_order(stages):
    assert [n for n, _, _ in stages] == [n for n, _ in C.STAGES]
    for _, _, df in stages[:-1]:
        assert df.columns == list(C.COLUMNS)


def test_quality_keeps_labelled_good(spark, stages):
    kept = {r["doc_id"] for r in stages[0][2].collect()}
    labels = {r["doc_id"]: r["quality"] for r in C.table(spark, SF, "labels").collect()}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert np.mean(right) > 0.95


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    sets = {r["doc_id"]: setsketch.shingle_set(setsketch.words_of(r["text"] or ""), 5) for r in before}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in after.collect()} == {i for i in ids if find(i) == i}


def test_repeated_passages_go(stages):
    _, before, after = stages[2]
    first, want = {}, {}
    n = C.REPEAT_BYTES
    for r in sorted(before, key=lambda r: r["doc_id"]):
        b = r["text"].encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if first.setdefault(b[p : p + n], r["doc_id"]) < r["doc_id"]:
                gone[p : p + n] = True
        want[r["doc_id"]] = (b, gone)
    got = {r["doc_id"]: r["text"] for r in after.collect()}
    assert len(got[10_000].split()) == 141 and len(got[10_002].split()) <= 83
    for i, (b, gone) in want.items():
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        # Characters cut in two are kept whole, so at most three bytes differ at each end of a run.
        if not gone.any():
            assert got[i] == b.decode()
        elif kept:
            assert 0 <= len(got[i].encode()) - len(kept) <= 6 * (np.diff(gone.astype(int)) == 1).sum() + 6


def test_mixing_uses_every_document(stages):
    _, before, after = stages[3]
    uses = {}
    for r in after.collect():
        uses[r["doc_id"]] = uses.get(r["doc_id"], 0) + 1
    assert set(uses) == {r["doc_id"] for r in before} and max(uses.values()) <= 2


def test_mixture_is_permuted(spark):
    # One source after the other, of as many tokens.
    rows = [(i, f"a b c {i} " * 20, "en", "a", 0) for i in range(300)]
    rows += [(1000 + i, *rows[i][1:3], "b", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    mixed = materialise(C.mix(spark, docs, SF), "test-mix")
    sources = [[r["source"] for r in part] for part in mixed.rdd.glom().collect() if len(part) >= 40]
    assert sources
    for part in sources:
        assert sum(a != b for a, b in zip(part, part[1:], strict=False)) > len(part) / 5
    # A text without spaces counts as its tokens too.
    rows = [(1, "\u6c49\u5b57" * 50, "zh", "b", 0), (2, None, "zh", "b", 0)]
    docs = spark.createDataFrame(rows, docs.schema)
    encoder = packing.Encoder(f"{C.TOKENIZERS}/byte_bpe_50k.json")
    got = {r["doc_id"]: r["n_tokens"] for r in C._with_tokens(docs).collect()}
    assert got == {r[0]: len(encoder.encode(r[1] or "")) // 4 + 1 for r in rows}


def test_packing_holds_every_token(stages):
    _, before, after = stages[4]
    encoder = packing.Encoder(f"{C.TOKENIZERS}/byte_bpe_50k.json")
    want = sum(len(encoder.encode(r["text"])) // 4 + 1 for r in before)
    assert after.agg({"length": "sum"}).first()[0] == want


def test_run(spark, stages):
    assert C.run(spark, SF).count() > 0
    assert C.ORACLE_SQL is None


def test_nulls_and_clashes(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (1, "", None, None, None), (2, "x y z " * 40, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as TEXT", "2 as Source", "3 as mix_epoch")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == list(C.COLUMNS)
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    packed = C.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {None, 1, 2} and sum(r["length"] for r in packed) > 4
