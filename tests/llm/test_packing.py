import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tillroll.llm.packing import Packer, WordEncoder, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", "Hello,  world's\n\tend", "ΑΣ ΟΔΟΣ", "İstanbul é é", "a\x1cb\x85c\xa0d", "<|endoftext|> x", "12½ ___ !!'s", "don'T we'Re"]


def whole(rows, ids_of):
    """Each id in exactly one piece, sequences without gaps; returns the lengths of sequences."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset, *_ in rows:
        sequences[sequence].append((offset, length))
        documents[doc].append((start, length, crc, tokens))
    for doc, pieces in documents.items():
        at, ids = 0, ids_of[doc]
        for start, length, crc, tokens in sorted(pieces):
            assert start == at and length > 0 and tokens == len(ids)
            assert crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    assert set(documents) == set(ids_of)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    return [sum(n for _, n in p) for p in sequences.values()]


def test_words_encode_as_the_whole():
    for text, ids in zip(TEXTS, WordEncoder(PATH)(TEXTS)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_words_go_to_the_tokenizer_many_at_a_time():
    rng = np.random.default_rng(3)
    letters = list("abcdefgÉñß漢İǅ'’-.,7½") + ["'re", "\u1e9e"]
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(400)) for _ in range(12)] + ["o\u0308 not normal"]
    encoder = WordEncoder(PATH)
    of_words, calls = encoder.of_words, []
    assert of_words is not encoder.tokenizer

    class Counting:
        def encode_batch_fast(self, some, **how):
            calls.append(sum(text.count(encoder.between) + 1 for text in some))
            return of_words.encode_batch_fast(some, **how)

    encoder.of_words = Counting()
    for text, ids in zip(texts, encoder(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert sum(calls) > 200 and len(calls) <= 1 + sum(calls) // 2048


def test_packer_fills_windows():
    rng = np.random.default_rng(5)
    packer, rows, ids_of = Packer(7 << 40, waiting=200), [], {}
    for doc in range(3000):
        ids_of[doc] = rng.integers(0, 49_000, int(rng.pareto(1.2) * 150) + 1).tolist()
        rows += packer.add(doc, np.array(ids_of[doc], "<u4").tobytes())
    rows += packer.finish()
    sizes = whole(rows, ids_of)
    assert sum(n not in (256, 512, 1024, 2048) for n in sizes) <= 1
    steps = defaultdict(int)
    for _, _, length, _, _, _, _, tier, group in rows:
        steps[tier, group] += length
    for tier in (256, 512, 1024, 2048):
        full = [n for (t, _), n in sorted(steps.items()) if t == tier][:-1]
        assert all(abs(n - 64 * 2048) <= 2048 for n in full)


def test_query_on_odd_rows(spark, odd, empty):
    rows = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    ids_of = {r.doc_id: [*LIBRARY.encode(r.text or "", add_special_tokens=False).ids, 1] for r in rows.collect()}
    whole([tuple(r) for r in pack(rows, PATH).collect()], ids_of)
    every = pack(odd, PATH).collect()
    assert sum(r.length for r in every) == sum(len(LIBRARY.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert pack(empty, PATH).count() == 0
