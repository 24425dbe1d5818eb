import random
import re

import numpy as np
import pytest
import xxhash

from feedloom.llm import simhash
from feedloom.llm.common import ship


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    value = sum(1 << b for b in range(64) if counts[b] * 2 > len(runs))
    return value - (1 << 64) if value >> 63 else value


def plain_groups(prints):
    """The least member of the component of each fingerprint, by all pairs."""
    v = np.array(prints, np.int64).view(np.uint64)
    root = list(range(len(v)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 3) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {prints[i]: prints[find(i)] for i in range(len(v))}


def test_embedding_bounds_the_bit_distance():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    distance = np.bitwise_count(simhash.embed(a) ^ simhash.embed(b))
    assert (distance <= np.bitwise_count(a ^ b)).all()
    counts = lambda x: np.array([np.bitwise_count(x >> np.uint64(2 * s) & np.uint64(3)) for s in range(32)], int)
    assert (distance == np.abs(counts(a) - counts(b)).sum(axis=0)).all()


@pytest.mark.parametrize("cell, batch", [(4096, 10_000), (7, 10_000), (4096, 13), (5, 17)])
def test_all_links_are_found(spark, monkeypatch, cell, batch):
    """Chains and dense balls, with cells split into parts and over batches."""
    ship(spark)
    monkeypatch.setattr(simhash, "CELL", cell)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rng = random.Random(1)
    prints = {0} | {rng.randrange(-2**63, 2**63) for _ in range(200)}
    for base in sorted(prints)[:40]:
        x = base % 2**64
        for k in range(12):
            y = x
            for _ in range(rng.randrange(1, 4)):
                y ^= 1 << rng.randrange(64)
            prints.add(y - 2**64 if y >> 63 else y)
            x = y if k % 3 == 0 else x
    want = plain_groups(sorted(prints))
    df = spark.createDataFrame([(p,) for p in want], "fingerprint bigint")
    try:
        got = {r.fingerprint: r.root for r in simhash.with_roots(df, 3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def brute(rows):
    prints = [plain_simhash(t) for _, t, _ in rows]
    roots = plain_groups(sorted(set(prints)))
    ids = {}
    for (i, _, _), p in zip(rows, prints):
        if i is not None:
            ids[roots[p]] = min(i, ids.get(roots[p], i))
    return sorted((str(i), p, ids.get(roots[p])) for (i, _, _), p in zip(rows, prints))


def near_rows(prose):
    base = prose(5, 400)
    words = base.split()
    rows = [(100, base, "a")]
    for i in range(60):
        copy = list(words)
        copy[i * 6] = "changed"
        rows.append((101 + i, " ".join(copy), "a"))
    return rows + [(200 + i, prose(50 + i, 80), "b") for i in range(30)]


def test_operator_equals_brute_force(docs, odd_rows, prose):
    rows = odd_rows + near_rows(prose)
    got = simhash.near_duplicates(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == brute(rows)
    assert simhash.near_duplicates(docs([])).count() == 0


def test_one_row_of_each_group_stays(docs, odd_rows, prose):
    rows = odd_rows + near_rows(prose)
    df = docs(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    roots = plain_groups(sorted({plain_simhash(t) for _, t, _ in rows}))
    groups = {(roots[p], c) for _, p, c in brute(rows)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(c) for _, c in groups)
    assert simhash.keep_one(docs([])).count() == 0
