import hashlib
import random
import re

from wardflow.llm import fill_middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc, text):
    """The contract, step by step."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n, x = len(units), hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def restored(form, output):
    if form == "plain":
        return output
    parts = re.split("(<P>|<S>|<M>)", output)
    by_mark = dict(zip(parts[1::2], parts[2::2], strict=True))
    return by_mark["<P>"] + by_mark["<M>"] + by_mark["<S>"]


def check(df, rows, chunk):
    want = []
    for doc, text in rows:
        n, form, p, m, output = plain(doc, text or "")
        assert restored(form, output) == (text or "")
        want.append((doc, n, form, p, m, sha(output), sha(text or "")))
    got = [tuple(r) for r in fill_middle.fill_in_middle(df, chunk=chunk).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


def test_against_the_contract(docs_of):
    rnd = random.Random(2)
    bits = ["word", " ", "é", "😀", "<", "<P", "S>", ">", "\n", "\x00", "A", "9", "  "]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60)))) for i in range(200)]
    rows += [(300 + i, f"a {m} b") for i, m in enumerate(("<P>", "<S>", "<M>"))]
    rows += [(400, None), (401, ""), (402, "x" * 100_000), (403, "ab c" * 50_000), (-5, "negative id")]
    for chunk in (1, 7, 4096):
        want = check(docs_of(rows), rows, chunk)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_repeated_rows_and_nulls(docs_of):
    rows = [(1, "same text here")] * 5 + [(1, "other text")] * 2 + [(None, "no id"), (None, "no id"), (None, None), (2, None), (2, "")]
    check(docs_of(rows), rows, 2)
    assert fill_middle.fill_in_middle(docs_of([])).count() == 0


def test_one_shuffle_and_a_sort_for_restoration(docs_of, plan_of):
    plan = plan_of(fill_middle.fill_in_middle(docs_of([(1, "a b")])))
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 2


def test_whole_outputs(docs_of):
    rows = [(i, f"doc {i} <x> text, more é") for i in range(50)] + [(None, None)]
    got = {(r["doc_id"], r["form"], r["output"]) for r in fill_middle.fill_in_middle_texts(docs_of(rows)).collect()}
    assert got == {(d, plain(d, t or "")[1], plain(d, t or "")[4]) for d, t in rows}
