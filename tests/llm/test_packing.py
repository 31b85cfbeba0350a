import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from wardflow.llm import packing
from wardflow.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_both_libraries_split_plain_characters_alike():
    encoder, tokenizer = packing.Encoder(PATH), library()
    for point in range(packing.PLAIN_BELOW):
        c = chr(point)
        for text in (f"a{c}b {c} {c}{c} 1{c}2{c}{c}. {c}x'{c}s  {c}", c, c + " ", " " + c):
            ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
            assert ids == tokenizer.encode(text, add_special_tokens=False).ids, (point, text)


@pytest.mark.parametrize("text", ["", " ", "日本語 x", "<|endoftext|> a", "a b", "x" * 5000])
def test_encoder(text):
    ids = np.frombuffer(packing.Encoder(PATH).encode(text), "<u4").tolist()
    assert ids == library().encode(text, add_special_tokens=False).ids


def test_special_strings_are_the_library_s():
    ids = np.frombuffer(packing.Encoder(PATH).encode("a <|endoftext|> b"), "<u4").tolist()
    assert ids == [64, 220, 50256, 275]


@given(st.lists(st.integers(1, 16), max_size=40), st.integers(0, 10))
@settings(max_examples=60, deadline=None)
def test_assign_never_overfills(lengths, n):
    where = packing.assign(np.array(lengths, np.int64), n, 16, 1.0, 0.1)
    for k in range(n):
        assert sum(x for x, at in zip(lengths, where, strict=True) if at == k) <= 16


def test_pieces(docs_of):
    rows = [(i, "some words here and there " * (i % 23)) for i in range(80)]
    rows += [(200, None), (None, "null id"), (201, "long text " * 4000), (3, rows[3][1])]
    got = packing.pack_documents(docs_of(rows), PATH, seq_len=256, block_tokens=4096, include_ids=True).toPandas()
    tokenizer, seen = library(), {}
    for i, text in rows:
        key = -1 if i is None else i
        seen.setdefault(key, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    assert got["length"].sum() == sum(len(x) for group in seen.values() for x in group)
    got["doc_id"] = got["doc_id"].fillna(-1).astype(int)
    for key, group in got.groupby("doc_id"):
        ids = seen[key][0]
        assert set(group["doc_tokens"]) == {len(ids)}
        covered = np.zeros(len(ids), int)
        for r in group.itertuples():
            piece = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(piece) == r.ids_crc32 and piece == r.input_ids
            covered[r.start : r.start + r.length] += 1
        assert (covered == len(seen[key])).all()
    for _, group in got.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *group["length"].cumsum()[:-1]]
        n = int(group["length"].sum())
        assert n <= 256 and n & (n - 1) == 0  # full, or a power of two: no padding at all


def test_empty_and_wrong_size(docs_of):
    assert packing.pack_documents(docs_of([]), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs_of([]), PATH, seq_len=1000)
