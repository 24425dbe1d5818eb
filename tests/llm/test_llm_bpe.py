import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.bpe import PairIndexEncoder, decode, encode_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "aAbB'sS tTdDveVE0129,.!?-\x1c\x85 \u200b\u3000éÉßΣσİıe\u0301ñ漢字かなا٣²½ǅﬁ🙂👩\u200d👧\x00\t\n\x0b<|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_and_texts_equal_the_librarys(library):
    rng, own = random.Random(1), PairIndexEncoder(PATH)
    texts = ["", None, " \t", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "x" * 5000, "don't we'll I'VE"]
    texts += ["".join(rng.choices(SIGNS, k=rng.randrange(40))) for _ in range(5000)]
    # Few letters make pairs that overlap and pairs whose ranks are out of order.
    texts += ["".join(rng.choices("aehinorst", k=rng.randrange(60))) for _ in range(5000)]
    texts += ["a" * n for n in range(50)] + ["haha" * n for n in range(50)]
    want = ids_of(library, texts)
    assert own.encode_batch(texts) == want
    flat, ends = np.array([i for ids in want for i in ids]), np.cumsum([0, *map(len, want)]).tolist()
    assert own.decode_batch(flat, ends) == library.decode_batch(want, skip_special_tokens=False)


def test_every_code_point(library):
    own = PairIndexEncoder(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for form in ("{}", "1{}a"):
        texts = [" ".join(form.format(c) for c in points[k:k + 512]) for k in range(0, len(points), 512)]
        assert own.encode_batch(texts) == ids_of(library, texts)


def test_a_rank_that_a_merge_lowers_is_taken_first():
    own = PairIndexEncoder(PATH)
    own.ids = {s: i for i, s in enumerate(["a", "b", "c", "ab", "abc", "bab"])}
    own.word_end, own.width = "", 6
    own.inner = own.final = np.array([own.ids.get(chr(c), -1) for c in range(1024)])
    # Merging "a b" (rank 1) makes "ab c" (rank 0), which goes before the next "a b" of that piece.
    own.merge = [(3, 2, 4), (0, 1, 3), (4, 3, 5)]
    own.rank = {a * 6 + b: r for r, (a, b, _) in enumerate(own.merge)}
    own.index_ranks()
    assert own.merged(["abcab", "abab", "cab", "z", "azb"]) == [(5,), (3, 3), (2, 3), (), (3,)]


def test_caches_change_nothing(library, monkeypatch, prose):
    monkeypatch.setattr("feedloom.llm.bpe.CACHED_RUNS", 3)
    monkeypatch.setattr("feedloom.llm.bpe.CACHED_LENGTH", 2)
    own, texts = PairIndexEncoder(PATH), [prose(seed, 300, 20) for seed in range(3)]
    for _ in range(2):
        assert [own.encode_batch([t])[0] for t in texts] == ids_of(library, texts)


def test_operator_on_odd_rows(docs, odd_rows, library, monkeypatch):
    monkeypatch.setattr("feedloom.llm.bpe.TOGETHER", 10)
    rows = encode_documents(docs(odd_rows), PATH).collect()
    assert len(rows) == len(odd_rows)
    for r, want in zip(rows, ids_of(library, [r.text for r in rows])):
        assert (r.ids, r.n_tokens) == (want, len(want))
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert encode_documents(docs([]), PATH).count() == 0


def test_decoding_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(None,), ([],), ([1, 10**6, -1, 2],)], "ids array<int>")
    assert [r[0] for r in rows.select(decode(F.col("ids"), PATH)).collect()] == [None, "", '" #']
