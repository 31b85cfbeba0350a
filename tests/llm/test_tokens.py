import random

import pytest
from wardflow.llm.queries import TOKENIZERS
from wardflow.llm.tokens import UnigramCounter, count_tokens, load_pieces

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"


def library(pieces, byte_fallback=True):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace()
    return t


TEXTS = ["", " ", "  ", "a  b", " x", "\n\n", "日本語 テスト 😀😀 x😀y", "<s> <0x41>", "▁a▁", "qq\x00\x01z"]


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_equal_the_library(fallback):
    rnd, pieces = random.Random(3), load_pieces(PATH)
    made = ["".join(rnd.choice("abc é😀\n▁日the ing") for _ in range(rnd.randint(1, 40))) for _ in range(500)]
    counter, tokenizer = UnigramCounter(pieces, fallback), library(pieces, fallback)
    for text in TEXTS + made:
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_ties_go_to_the_longest_last_piece():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("▁a", -2.0)]
    counter, tokenizer = UnigramCounter(pieces, False), library(pieces, False)
    for n in range(1, 9):
        assert counter.count("a" * n) == len(tokenizer.encode("a" * n, add_special_tokens=False).ids)


def test_rows(docs_of, spark):
    rows = [(1, None), (None, "the"), (2, ""), (3, "word " * 20_000), (3, "word " * 20_000)]
    got = sorted(map(tuple, count_tokens(docs_of(rows), PATH).collect()), key=repr)
    counter = UnigramCounter(load_pieces(PATH))
    assert got == sorted([(i, len(t or ""), counter.count(t or "")) for i, t in rows], key=repr)
    assert count_tokens(docs_of([]), PATH).count() == 0
