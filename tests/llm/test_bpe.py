import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm import bpe, lexicon
from brindle.llm.queries import tokenizer_path
from tests.llm.helpers import awkward, frame

PATH = tokenizer_path("word_bpe_49k.json")
LETTERS = "aAbéÉèñÑß ẞΣσς\x00\x1c\x1d\x85\xa0 \t\n'stdmlre0129½²!?.,#$ İıſ你好한글́ͅ𝔸😀|<>endoftext"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(30))) for _ in range(2000)]
    return [*made, "<|endoftext|> a<|startoftext|>B <|x|> it's <|ENDOFTEXT|>", *awkward()]


def reference(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    return [(i, tokenizer.decode(i, skip_special_tokens=False)) for i in ids]


def test_same_as_the_public_library(spark, texts):
    got = {r.doc_id: r for r in bpe.encode(frame(spark, texts).repartition(3), PATH).collect()}
    for i, (ids, decoded) in enumerate(reference(texts)):
        assert (got[i].ids, got[i].n_tokens, got[i].decoded) == (ids, len(ids), decoded)


def test_digests_and_any_lexicon(spark, vocabulary):
    body = awkward()
    words = sorted({"word", "façade", "one"}, key=str.encode)
    made = lexicon.build((w.encode(), bpe.merge(vocabulary, bpe.byte_letters(), w)) for w in words)
    for given in (None, made, lexicon.build([])):
        encoded = bpe.encode(frame(spark, body).repartition(3), PATH, lexicon=given)
        got = {r.doc_id: r for r in encoded.withColumn("ids_sha256", bpe.ids_sha256(F.col("ids"))).collect()}
        for i, (ids, decoded) in enumerate(reference(body)):
            assert (got[i].ids, got[i].decoded) == (ids, decoded)
            assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode(frame(spark, []), PATH).collect() == []


def test_every_code_point_between_letters(vocabulary):
    """Classes and lower case are the library's for all of Unicode, not this Python's."""
    tokenizer, encoder = Tokenizer.from_file(PATH), bpe.Encoder(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for lo in range(0, 0x110000, 1 << 14):
        texts = [f"a{chr(c)}b" for c in range(lo, lo + (1 << 14)) if not 0xD800 <= c <= 0xDFFF]
        want = [t.ids for t in tokenizer.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(ids, "<u4").tolist() for ids, _ in encoder(texts)]
        assert [t for t, x, y in zip(texts, got, want) if x != y] == []


def test_merging_many_is_merging_each(vocabulary):
    draw = random.Random(4)
    words = ["".join(draw.choice("aabcdeéñ!#1") for _ in range(draw.randrange(1, 25))) for _ in range(3000)] + ["a" * 50]
    got = bpe.Merger(vocabulary)([w.encode() for w in words])
    assert all(tuple(g.tolist()) == bpe.merge(vocabulary, bpe.byte_letters(), w) for w, g in zip(words, got))


def test_lexicon_holds_its_words_and_no_others(tmp_path):
    draw = random.Random(5)
    words = sorted({bytes(draw.choice(b"abc\xc3") for _ in range(draw.randrange(1, 9))) for _ in range(800)})
    held = {w: tuple(draw.randrange(10**6) for _ in range(draw.randrange(1, 4))) for w in words[::2]}
    file = tmp_path / "lexicon"
    file.write_bytes(lexicon.build(held.items()))
    got = lexicon.Lexicon(str(file)).get_many([*words, b"", b"zz"])
    assert [None if g is None else tuple(g.tolist()) for g in got] == [held.get(w) for w in words] + [None, None]


def test_suffixes_are_shared():
    few = len(lexicon.build([(b"ation", (1,))]))
    ends = [(p + b"ation", (1,)) for p in (b"a", b"b", b"c", b"d")]
    assert len(lexicon.build(ends)) < 3 * few


def test_counts_cover_all_texts(spark):
    rows = bpe.word_counts(frame(spark, ["The the café", "CAFÉ the", None]).coalesce(1)).collect()
    assert {r.word: r.n for r in rows} == {"the": 3, "café": 2}


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Vocabulary.load(tokenizer_path("byte_bpe_50k.json"))


def test_texts_of_low_code_points_are_split_alike():
    vocabulary = bpe.Vocabulary.load(PATH)
    encoder = bpe.Encoder(vocabulary)
    assert encoder._find_low != encoder._find and bpe._low_pattern(r"\w+") is None and bpe._low_pattern("[a-z]") is None
    for c in map(chr, range(0xD800)):
        assert bool(bpe._HIGH.search(c)) == (ord(c) >= bpe.LOW or ord(c) in (0x23A, 0x23E))
        if not bpe._HIGH.search(c):
            assert not bpe._ODD.search(c) and ord(max(c.lower())) < bpe.LOW
            for body in (f"a{c}b", f"1{c}{c} ", f".{c}'s", c):
                assert encoder._find_low(body) == encoder._find(body)
    draw = random.Random(8)
    for _ in range(300):
        body = "".join(draw.choices([chr(c) for c in range(0x20, bpe.LOW)] + list("   '''stm\n"), k=200))
        assert encoder._find_low(body) == encoder._find(body)
