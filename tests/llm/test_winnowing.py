import hashlib
import random

import numpy as np
from wardflow.llm import winnowing
from wardflow.llm.winnowing import Winnower


def plain(text, k, window):
    """Fingerprints by the definition, on the hashes of the operator."""
    w = Winnower(k, window)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(points):
        return []
    hashes = [int(w._hashes(points[i : i + min(k, len(points))], min(k, len(points)))[0]) for i in range(max(1, len(points) - k + 1))]
    width, chosen = min(window, len(hashes)), []
    for i in range(len(hashes) - width + 1):
        part = hashes[i : i + width]
        at = i + max(j for j in range(width) if part[j] == min(part))
        if not chosen or chosen[-1] != at:
            chosen.append(at)
    return [(hashes[i], i) for i in chosen]


def test_selection_and_guarantee():
    rnd = random.Random(5)
    for text in ["", "a", "abc", "aaaaaaaaaaaaaaaaaaaaaaaa", "".join(rnd.choice("abé😀") for _ in range(300))]:
        h, p = Winnower(4, 5).select(text)
        assert list(zip(h.tolist(), p.tolist(), strict=True)) == plain(text, 4, 5)
    for _ in range(50):
        shared = "".join(rnd.choice("abcdef") for _ in range(8))
        a, b = ("".join(rnd.choice("abcdef") for _ in range(30)) for _ in range(2))
        one, two = Winnower(4, 5).select(a + shared + b), Winnower(4, 5).select(b + shared + a)
        assert set(one[0].tolist()) & set(two[0].tolist())


def test_compare_with_successor(spark, docs_of):
    rnd = random.Random(1)
    rows = [(i * 3, "".join(rnd.choice("abc d") for _ in range(rnd.randint(0, 400)))) for i in range(60)]
    rows += [(1000, None), (1001, "x" * 30_000), (1002, rows[5][1])]
    rnd.shuffle(rows)
    got = {r["doc_id"]: r for r in winnowing.compare_with_successor(docs_of(rows)).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        w, r = Winnower(), got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == winnowing.as_hex(w.select(text))
        assert r["edited_fingerprint"] == winnowing.as_hex(w.select(edited))
        assert r["near_next"] == winnowing.likeness(w.select(text)[0], w.select(after)[0])


def test_edges(docs_of):
    assert winnowing.compare_with_successor(docs_of([])).count() == 0
    one = winnowing.compare_with_successor(docs_of([(4, "abc")])).collect()[0]
    assert one["near_next"] == 1.0 and one["fingerprint"] == winnowing.as_hex(Winnower().select("abc"))
    same = winnowing.compare_with_successor(docs_of([(4, "b"), (4, "a"), (None, "c"), (None, None)])).collect()
    assert sorted(repr(r["doc_id"]) for r in same) == ["4", "4", "None", "None"]
    plain_rows = winnowing.fingerprints(docs_of([(1, None), (1, "ab")])).collect()
    assert sorted(len(r["hashes"]) for r in plain_rows) == [0, 1]
