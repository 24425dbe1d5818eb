import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm.tokens import MergeCounter, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_librarys(reference):
    counter, rng = MergeCounter(PATH), random.Random(1)
    signs = "aAbB'sS tTdDveVE0129,.!?-\x1c\x85 \u200b\u3000éÉßΣσİıe\u0301ñ漢字かなا٣²½ǅﬁ🙂👩\u200d👧\x00\t\n\x0b<|>"
    texts = ["", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "x" * 5000, "don't we'll I'VE"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert [counter.count(t) for t in texts] == [reference(t) for t in texts]


def test_every_code_point_counts_as_the_library_counts_it():
    tokenizer, counter, rng = Tokenizer.from_file(PATH), MergeCounter(PATH), random.Random(2)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # One text holds a line of code points in each surrounding; a wrong line is looked up singly.
    for form in ("a{}1", "{}A"):
        for k in range(0, len(points), 4096):
            text = " ".join(form.format(c) for c in points[k:k + 4096])
            assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)
        counter.known.clear()
    texts = ["".join(rng.choices(points, k=8)) for _ in range(5_000)]
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == want


def test_a_small_word_cache_changes_nothing(reference, monkeypatch, prose):
    monkeypatch.setattr("feedloom.llm.tokens.CACHED_WORDS", 3)
    text = prose(2, 300, 20)
    assert MergeCounter(PATH).count(text) == reference(text)


def test_operator_on_odd_rows(docs, odd_rows, reference):
    rows = count_tokens(docs(odd_rows), PATH, 2048).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.n_tokens == reference(r.text)
        assert r.n_bytes == len((r.text or "").encode())
        assert r.over_limit == (r.n_tokens > 2048)
    assert count_tokens(docs([]), PATH, 2048).count() == 0
