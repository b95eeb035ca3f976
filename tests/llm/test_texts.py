"""Words, shingles, pre-tokens and merges against plain loops and the tokenizer library."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from topicwake.llm.encode import Encoder
from topicwake.llm.simple8b import decode, encode
from topicwake.llm.text import PUNCT, Words, blocks, distinct, shingles
from topicwake.llm.token_counts import Counter

PIECES = [
    "'s", "'re", "don't", "  ", "\n\n", "\t ", " ", "!'s", "''t", "'LL", "12", "3a", "é", "É", "ß", "İ", "x", "…", "—", "\xa0", "日本",
    "<|endoftext|>", "a" * 40, " 'tis", "'ve'll", "", "$$$", "&&", "\r\n", "²", "ª", "�", "\x1c", "'d'm", " '", "'", "'r", "'re",
]


def odd_texts(n: int, seed: int = 1) -> list:
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", None, "word " * 30_000]


def test_words_and_shingles():
    texts = ["A b\tc  d e", "", None, "one two", "ONE two three four", " \n ", "a b c d e"]
    (lo, hi, data, offsets), = blocks(pa.array(texts))
    words = Words(data, offsets)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert (lo, hi) == (0, len(texts)) and words.counts.tolist() == [len(p) for p in plain]
    text, hashes = distinct(*shingles(words, 4))
    sets = [set(hashes[text == i].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [2, 0, 0, 1, 1, 0, 2] and sets[0] == sets[6]


def test_blocks_hold_whole_texts():
    texts = pa.array(["x" * n for n in (10, 0, 50, 5, 5, 200, 1)]).slice(1)
    seen = [(hi - lo, len(data)) for lo, hi, data, _ in blocks(texts, 60)]
    assert sum(n for n, _ in seen) == 6 and sum(b for _, b in seen) == 261 and max(seen) == (4, 60)


@pytest.mark.parametrize("name,words_only", [("byte_bpe_50k", False), ("word_bpe_49k", True)])
def test_ids_equal_the_library(name, words_only):
    own, texts = Encoder(public_tokenizers.path(f"{name}.json"), words_only), odd_texts(800)
    wanted = [x.ids for x in own.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    found = []
    for _, ids, offsets in own.blocks(pa.array(texts)):
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert found == wanted


def test_counts_equal_the_library():
    own, texts = Counter(public_tokenizers.path("byte_bpe_50k.json")), odd_texts(800, 2)
    library = Encoder(public_tokenizers.path("byte_bpe_50k.json"), False).library
    sizes, tokens = own.counts(pa.array(texts))
    assert tokens.tolist() == [len(x.ids) for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert sizes.tolist() == [len((t or "").encode()) for t in texts]


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 20_000])
def test_simple8b_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (2, 100, 49_408, 1 << 32, (1 << 64) - 1):
        values = rng.integers(0, top, n, dtype=np.uint64)
        assert (decode(*encode(values), n) == values).all()
    mixed = (2 ** (rng.random(n) * 63.9)).astype(np.uint64)
    assert (decode(*encode(mixed), n) == mixed).all()


def test_punctuation_is_no_word():
    (_, _, data, offsets), = blocks(pa.array(["!!", "a-b", "é.É"]))
    assert Words(data, offsets, PUNCT).counts.tolist() == [0, 2, 2]
