import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import collocations
from feedloom.llm.collocations import CHUNK, Spread, counted, frequent, merge_salts, mine, tile_rows, tiled, untiled

SHORT = "doc_id bigint, text string, lang string, rank string, n string, row int, ids string"


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", piece) if w] for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered)]


def plain_mine(rows, least, longest=4, covered=80, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in plain_words(text):
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        kept = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        cover = Counter()
        for g, a in kept.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    cover[g[i:i + k]] = max(cover[g[i:i + k]], a)
        found = []
        for g, a in kept.items():
            if 100 * cover[g] >= covered * a:
                continue
            score, m = min((2_000_000 * a // (f[g[:m]] + f[g[m:]]), m) for m in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), a, f[g[:m]], f[g[m:]], score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, totals[lang], score))
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    """Zipf-like words with stock phrases, stops and odd characters, in four languages and none."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "the", "THE", "of", "x\x1cy", "a\x00b", "漢字", "n b", "'"]
    stock = ["as a matter of fact", "In The Beginning", "tata tata tata tata tata", "of the the of"]
    rows = []
    for k in range(300):
        parts = []
        for _ in range(rng.randrange(60)):
            parts.append(rng.choice(stock) if rng.random() < 0.1 else words[int(len(words) * rng.random() ** 4)])
            parts.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " ;", "\x0c"]))
        rows.append(("".join(parts), rng.choice(["en", "en", "en", "de", "und", None, ""])))
    return rows + [(None, "en"), ("", None), (" \t\n.", "xx"), rows[0], rows[0], ("w1 w2 " * 20_000, "de")]


def run(spark, rows, **parameters):
    df = spark.createDataFrame(
        [(i, t, g, "x", "y", 1, "z") for i, (t, g) in enumerate(rows)], SHORT).repartition(5)
    return sorted(tuple(r) for r in mine(df, **parameters).collect())


def test_equal_to_plain_counts(spark, corpus):
    got = run(spark, corpus, least=5)
    assert got == plain_mine(corpus, 5)
    assert {len(r[2].split(" ")) for r in got} == {2, 3, 4}


@pytest.mark.parametrize("limit", [0, 900])
def test_words_and_pairs_beyond_the_broadcast_are_joined(spark, corpus, monkeypatch, limit):
    monkeypatch.setattr(collocations, "BROADCAST_BYTES", limit)
    assert run(spark, corpus, least=5) == plain_mine(corpus, 5)


def test_other_lengths_shares_and_tops(spark, corpus):
    assert run(spark, corpus, least=12, longest=3, covered=50, top=7) == plain_mine(corpus, 12, 3, 50, 7)


def test_tables_without_phrases(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("one two", "en")], least=2) == []


def test_codes_sort_by_tile_and_come_back():
    rng = np.random.default_rng(1)
    left, right = (rng.integers(0, 2**31, 1000) >> rng.integers(0, 31, 1000) for _ in range(2))
    a, b = untiled(tiled(left, right))
    assert (a == left).all() and (b == right).all()


def counts_of(codes):
    return dict(sorted(Counter(codes.tolist()).items()))


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(2)
    hot = tiled(rng.integers(0, 400, 200_000), rng.integers(0, 600, 200_000))
    cold = tiled(rng.integers(0, 2**31 - 1, 5000), rng.integers(0, 50, 5000))
    codes = rng.permutation(np.concatenate([hot, cold]))
    found, n = counted(codes, None)
    assert dict(zip(found.tolist(), n.tolist())) == counts_of(codes) and (np.diff(found) > 0).all()
    # Weights beyond what a float holds exactly.
    again, total = counted(np.concatenate([found, found]), np.concatenate([n, n + (1 << 60)]))
    assert (again == found).all() and (total == 2 * n + (1 << 60)).all()
    empty = counted(np.array([], dtype=np.int64), None)
    assert len(empty[0]) == len(empty[1]) == 0


def test_rows_of_tiles_merge_across_batches():
    rng = np.random.default_rng(3)
    parts = [tiled(rng.integers(0, 30_000, 20_000) ** 2 // 30_000, rng.integers(0, 9000, 20_000) ** 2 // 20_000)
             for _ in range(3)]
    rows = []
    for k, codes in enumerate(parts):
        batch = tile_rows("en", *counted(codes, None), Spread(4, 3, k))
        assert max(map(len, batch["codes"].to_pylist())) <= CHUNK
        assert set(batch["part"].to_pylist()) <= set(range(16 * 16 + 3)) and max(batch["salt"].to_pylist()) < 4
        rows += batch.to_pylist()
    # All rows of a code are in one group of tiles.
    group = {}
    for r in rows:
        assert r["least"] == r["codes"][0] and r["codes"] == sorted(r["codes"])
        for code in r["codes"]:
            assert group.setdefault(code, r["part"]) == r["part"]
    rows.sort(key=lambda r: r["least"])
    cut = [pa.RecordBatch.from_pylist(rows[i:i + 37], batch.schema) for i in range(0, len(rows), 37)]
    merged = sorted((r for b in merge_salts(3)(iter(cut)) for r in b.to_pylist()), key=lambda r: r["least"])
    out = {}
    for found in frequent(4)(iter([pa.RecordBatch.from_pylist(merged, batch.schema)])):
        for row in found.to_pylist():
            code = int(tiled(np.array([row["a"]]), np.array([row["b"]]))[0])
            assert code not in out
            out[code] = row["f"]
    assert out == {k: v for k, v in counts_of(np.concatenate(parts)).items() if v >= 4} and out
