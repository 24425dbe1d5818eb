import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.llm import mixing
from feedloom.llm.mixing import mix, mixed_rows, pivot, targets


def weight(place):
    return (5, 2, 1)[place % 3]


def plain_targets(sizes, share, cap):
    """The rule step by step: share out, cut at the cap, share the excess, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    out, free, left = {}, list(order), share * sum(sizes.values())
    while free:
        total = sum(weight(order.index(s)) for s in free)
        offer = {s: left * weight(order.index(s)) / total for s in free}
        above = [s for s in free if offer[s] > cap * sizes[s]]
        if not above:
            return out | offer
        for s in above:
            out[s] = cap * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def test_targets_equal_the_rule():
    rng = random.Random(2)
    for _ in range(200):
        sizes = {s: rng.choice([0, 3, 50, 1000, 9000]) for s in ["b", "a", "é", None, "z", "c"][:rng.randrange(1, 7)]}
        got, want = targets(sizes, weight, 1.5, 2), plain_targets(sizes, 1.5, 2)
        assert got == pytest.approx(want)
        assert all(got[s] <= 2 * sizes[s] + 1e-6 for s in sizes)
        assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_a_node_keeps_the_words_and_each_chance():
    rng = random.Random(4)
    chance, words = [rng.random() * 0.98 + 0.01 for _ in range(9)], [rng.randrange(1, 90) for _ in range(9)]
    want, ones, n = sum(c * w for c, w in zip(chance, words)), Counter(), 20_000
    for _ in range(n):
        decided, left, p = pivot(chance, words, [rng.random() for _ in chance])
        assert [d is None for d in decided].count(True) == (left >= 0)
        total = sum(w for d, w in zip(decided, words) if d) + (p * words[left] if left >= 0 else 0)
        assert total == pytest.approx(want)
        ones.update(i for i, d in enumerate(decided) if d)
        if left >= 0 and rng.random() < p:
            ones[left] += 1
    for i, c in enumerate(chance):
        assert abs(ones[i] / n - c) < 0.02


@pytest.mark.parametrize("leaf, fan_in", [(4096, 256), (4, 3)])
def test_sources_meet_their_targets(docs, prose, monkeypatch, leaf, fan_in):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    rows = [(i, prose(i, 1 + i * 7 % 40), "hot" if i % 3 else f"s{i % 7}") for i in range(400)]
    df = docs(rows)
    got = mix(df, weight, 1.5, 2, seed=3).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len(t.split())
    goal = plain_targets(sizes, 1.5, 2)
    for r in got:
        assert r.size == len(r.text.split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source]) and 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 40
    again = mix(df.repartition(5), weight, 1.5, 2, seed=3).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_odd_and_repeated_rows(docs, odd_rows):
    rows = odd_rows + [(9, "the same row again and again", "d")] * 40
    df = docs(rows)
    out = mix(df, weight, 1.5, 2)
    got = out.collect()
    assert len(got) == len(rows)
    assert out.columns == [c for c in df.columns if c not in ("size", "target", "copies")] + [
        "size", "source_size", "target", "copies"]
    same = [r.copies for r in got if r.doc_id == 9]
    assert max(same) - min(same) <= 1
    repeated = mixed_rows(df, weight, share=1.5, cap=2)
    assert repeated.columns == df.columns
    times = Counter(map(str, repeated.collect()))
    there = Counter(map(str, df.collect()))
    assert set(times) <= set(there) and all(times[r] <= 2 * there[r] for r in times)
    same = str(df.where("doc_id = 9").head())
    words = sum(len((t or "").split()) for _, t, s in rows if s == "d")
    goal = {r.source: r.target for r in got}["d"]
    assert abs(times[same] * 6 - goal) <= 6 and words == 240
    assert mix(docs([]), weight, 1.5).count() == 0


def test_a_large_group_of_repeated_rows_keeps_the_target(docs, prose):
    df = docs([(9, "ten words that stand in this row for a test", "d")] * 1001
              + [(100 + i, prose(i, 10), "d") for i in range(3000)])
    for seed in range(4):
        got = mix(df, lambda place: 1, 0.7, 2, seed=seed).agg(
            F.sum(F.col("copies") * F.col("size")), F.first("target")).head()
        assert abs(got[0] - got[1]) < 10 + 1e-6
