"""The registered queries over the smallest test tables, against brute force and DuckDB."""
import hashlib
import os
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm.queries import ORACLES, QUERIES, mix_weight

from .test_llm_mixing import plain_targets
from .test_llm_pii import PLAIN, base
from .test_llm_simhash import plain_groups, plain_simhash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    return [(r.doc_id, r.text or "", r.source) for r in rows]


def run(spark, name):
    return QUERIES[name](spark, FOLDER)


def by_id(spark, name):
    rows = run(spark, name).collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    base_ = duckdb.connect()
    for table in ("documents", "benchmark"):
        base_.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    want, got = base_.sql(ORACLES[name]).df(), run(spark, name).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got)
    assert sorted(map(str, got[columns].values.tolist())) == sorted(map(str, want[columns].values.tolist()))


def test_op1(spark, texts):
    got, prints = by_id(spark, "op1_fingerprints"), defaultdict(set)
    for k, (i, t, _) in enumerate(texts):
        following, quarter = texts[(k + 1) % len(texts)][1], len(t) // 4
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(t[:len(t) - quarter] + following[:quarter]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[t].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    long = [got[i] for i, t, _ in texts if len(t.split()) > 200]
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)


def test_op2(spark, texts):
    got, slots = by_id(spark, "op2_sharding"), defaultdict(list)
    for i, t, _ in texts:
        r = got[i]
        assert (r.size, r.text_crc32) == (len(t.encode()) + 8, zlib.crc32(t.encode()))
        assert r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op4(spark, texts):
    got, kinds = by_id(spark, "op4_pii"), list(PLAIN)
    for i, t, _ in texts:
        spans = [(kinds[k], a, b) for a, k, b, _ in base(t)]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for k, *_ in spans) for kind in kinds]
        named = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.base_sha256 == sha(",".join(named))
        assert set(named) <= set(r.spans.split(",") if r.spans else [])


def test_op5(spark, texts):
    got = by_id(spark, "op5_toxicity")
    assert {i: r.held_out for i, r in got.items()} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in texts}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_op7(spark, texts):
    got = by_id(spark, "op7_simhash_near_dedup")
    prints = {i: plain_simhash(t) for i, t, _ in texts}
    roots, least = plain_groups(sorted(set(prints.values()))), {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    for i, p in prints.items():
        assert got[i].fingerprint == f"{p % 2**64:016x}"
        assert got[i].component_id == least[roots[p]]


def test_op8(spark, texts):
    got, sizes, taken = by_id(spark, "op8_mixing"), defaultdict(int), defaultdict(int)
    for _, t, s in texts:
        sizes[s] += len(t.encode().split())
    goal = plain_targets(sizes, 1.5, 2)
    for i, t, s in texts:
        r = got[i]
        assert r["size"] == len(t.encode().split()) and r.source_size == sizes[s]
        assert r.target == pytest.approx(goal[s]) and r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= max(len(t.split()) for _, t, x in texts if x == s)
    assert [mix_weight(i) for i in range(4)] == [5, 2, 1, 5]


def test_op9(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = by_id(spark, "op9_token_counts")
    for i, t, _ in texts:
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 2048)


def test_op10(spark):
    said = r"\### Assistant: </turn> ok"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    turns[-7] = [("user", said), ("assistant", said)]
    got = {r.conv_id: r for r in run(spark, "op10_chat_formatting").collect()}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        loss = "".join(t for role, t in rows if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(rows), sha("".join(f"{a}\n{b}\n" for a, b in rows)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.formatted_chars > sum(len(t) for _, t in rows)


def test_op12(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = by_id(spark, "op12_bpe")
    for i, t, _ in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))
