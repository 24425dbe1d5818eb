import hashlib
import random

import pytest
from pyspark.sql import functions as F

from feedloom.llm import merkle
from feedloom.llm.common import placed

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def plain_tree(hashes):
    """The top and, per leaf, the siblings to its left and right on each level."""
    paths, level = [[] for _ in hashes], list(hashes)
    places = list(range(len(hashes)))
    while len(level) > 1:
        for path, i in zip(paths, places):
            run = level[i // 8 * 8:i // 8 * 8 + 8]
            path.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        places = [i // 8 for i in places]
        level = [digest(*level[i:i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def plain_manifest(rows):
    """(group, id, leaf, subroot, root, path) per row, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r), r["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for _, _, leaf, _ in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above):
        for (_, _, leaf, i), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            out.append((g, i, leaf, trees[g][0], root, path + up))
    return sorted(out, key=str)


def check(df, tampered=None):
    rows = df.collect()
    got = merkle.manifest(df, "lang", "doc_id", FIELDS, tampered).collect()
    found = [(r.grp, r.id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in got]
    assert sorted(found, key=str) == plain_manifest([r.asDict() for r in rows])
    for r in got:
        assert r.proof_sha256 == digest(*[left + right for left, right in r.path])
    return got


@pytest.fixture(scope="module")
def make(spark):
    def build(rows):
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, g string, tile int")
    return build


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 8, "de": 9}, {None: 1, "en": 65, "": 64, "é": 2}, {"en": 513, "de": 512, None: 7}])
def test_sizes_of_groups(make, sizes):
    rows = [(k * 10_000 + i, f"Text {i}", g, "s", i, "x", "y", 1)
            for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert all(r.verified and r.folded_root == r.root for r in check(make(rows)))


def test_three_rounds_and_many_groups(make):
    rows = [(i, "t", "big" if i < 4700 else f"g{i % 70}", None, None, "x", "y", 1) for i in range(5000)]
    check(make(rows).repartition(7))


def test_only_tampered_rows_fail(make):
    df = make([(i, "ABC" if i % 2 else "abc", f"g{i % 3}", "s", 3, "x", "y", 1) for i in range(100)])
    lowered = merkle.leaf(*map(F.col, FIELDS[:-1]), F.lower("text"))
    got = check(df, F.when(F.col("doc_id") % 5 == 0, lowered))
    assert {r.id for r in got if not r.verified} == {i for i in range(100) if i % 10 == 5}


def test_odd_rows_and_clashing_names(docs, odd_rows):
    check(docs(odd_rows))
    empty = merkle.manifest(docs([]), "lang", "doc_id", FIELDS)
    assert empty.count() == 0
    alone = check(docs(odd_rows[:1]))[0]
    assert (alone.path, alone.root, alone.proof_sha256) == ([], alone.leaf, digest())


def test_repeated_rows_and_nulls_in_every_column(make):
    rows = [(None,) * 8] * 40 + [(1, "", "en", None, 0, "x", "y", 1)] * 30 + [(None, "a", None, "b", 1, "x", "y", 1)]
    check(make(rows))


def test_places_of_a_group_over_all_partitions(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(50)}", rng.randrange(40)) for _ in range(5000)]
    found = placed(spark.createDataFrame(rows, "g string, v int").repartition(9), "g", "v").collect()
    by = {}
    for r in found:
        by.setdefault(r.g, []).append((r.place, r.v, r.members))
    assert len(found) == 5000
    for members in by.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members)))
        assert [m[1] for m in members] == sorted(m[1] for m in members)
        assert {m[2] for m in members} == {len(members)}
