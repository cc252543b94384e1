import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm.bpe import codec, round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(texts):
    own = codec(PATH)
    for text, ids in zip(texts, own.encode_many(texts)):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.written(ids) == ",".join(map(str, want))
        assert own.decode(ids).decode("utf-8", "replace") == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), max_size=30), max_size=5))
def test_any_text(texts):
    check(texts)


def test_pieces_in_any_order():
    rng = random.Random(1)
    pieces = ["a", "aa", "aaa", "  ", " ", "\n", "the", "ing", "'s", "'re", "12", "é", "漢", "😀", "\t", "\x1c", "\x85", "\xa0", "<|endoftext|>", "½", "zz", "=="]
    check(["".join(rng.choices(pieces, k=rng.randrange(20))) for _ in range(2000)])


def test_long_words():
    check(["a" * 20_000, "ab" * 10_000, "x" + " " * 5000 + "y", "thethe" * 2000])


def test_query_on_odd_rows(odd, empty):
    got = round_trip(odd, PATH, outputs=True).collect()
    assert sorted((r.decoded for r in got)) == sorted((r.text or "" for r in odd.collect()))
    for r in got:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    assert round_trip(empty, PATH).count() == 0


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "<|endoftext|><|endoftext|> x"])
def test_special_tokens(text):
    check([text])
