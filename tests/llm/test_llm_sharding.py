from collections import Counter

import numpy as np
import pytest

from feedloom.llm.sharding import communication_matrix, even_sizes, hypergeometric, permuted, shuffle_into_shards


def test_draws_follow_the_hypergeometric_law():
    rng = np.random.default_rng(0)
    mine = np.array([hypergeometric(rng, 30, 70, 20) for _ in range(20_000)])
    theirs = rng.hypergeometric(30, 70, 20, 20_000)
    assert abs(mine.mean() - theirs.mean()) < 0.06 and abs(mine.var() - theirs.var()) < 0.2
    huge = [hypergeometric(rng, 10**13, 5 * 10**13, 10**9) for _ in range(200)]
    assert abs(np.mean(huge) / 10**9 - 1 / 6) < 1e-4


def test_matrix_has_exact_margins():
    matrix = communication_matrix([5, 0, 7, 100], even_sizes(112, 24), 1)
    assert matrix.sum(axis=1).tolist() == [5, 0, 7, 100]
    assert matrix.sum(axis=0).tolist() == even_sizes(112, 24)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_second_permutation_is_one(size):
    out = permuted(np.arange(size), np.full(size, size), np.full(size, 12_345))
    assert sorted(out) == list(range(size))


def placed(df):
    return [(r.doc_id, r.text, r.shard, r.slot) for r in df.collect()]


@pytest.mark.parametrize("buckets", [None, 1, 50])
def test_sizes_differ_by_one_and_slots_have_no_gap(docs, odd_rows, buckets):
    df = docs(odd_rows + [(100 + i, "copy", "hot") for i in range(500)])
    rows = placed(shuffle_into_shards(df, 24, 5, buckets))
    assert sorted(map(repr, ((i, t) for i, t, _, _ in rows))) == sorted(
        map(repr, ((r.doc_id, r.text) for r in df.collect())))
    counts = Counter(s for _, _, s, _ in rows)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(slot for _, _, shard, slot in rows if shard == s) == list(range(n))


def test_reruns_agree_and_seeds_differ(docs):
    df = docs([(i, f"text {i}", "a") for i in range(300)])
    first = sorted(placed(shuffle_into_shards(df, 7, 1)))
    assert first == sorted(placed(shuffle_into_shards(df.repartition(13), 7, 1)))
    assert first != sorted(placed(shuffle_into_shards(df, 7, 2)))


def test_columns_and_small_tables(docs):
    df = docs([(1, "a", "x")])
    out = shuffle_into_shards(df, 24)
    assert out.columns == [c for c in df.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert [(r.shard, r.slot, r["key"]) for r in out.collect()] == [(0, 0, "x")]
    assert shuffle_into_shards(docs([]), 24).count() == 0


def test_places_are_uniform(docs):
    df = docs([(i, str(i), "a") for i in range(2400)])
    rows = placed(shuffle_into_shards(df, 24, 9))
    ids = np.array([i for i, *_ in rows], float)
    places = np.array([s * 100 + slot for *_, s, slot in rows], float)
    assert abs(np.corrcoef(ids, places)[0, 1]) < 0.06
