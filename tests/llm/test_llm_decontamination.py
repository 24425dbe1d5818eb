import math

import pytest
from pyspark.sql import functions as F

from feedloom.llm import decontamination
from feedloom.llm.decontamination import decontaminate, find_contained


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, items, least=0.8):
    out = []
    for i, t, _ in rows:
        for k, s in items:
            a, b = shingles(s), shingles(t)
            if a and len(a & b) / len(a) >= least:
                out.append((str(i), str(k), len(a & b), len(a)))
    return sorted(out)


@pytest.fixture(scope="module")
def corpus(prose, odd_rows):
    items = [(k, prose(900 + k, 8 + 3 * k)) for k in range(15)]
    items += [(50, None), (51, ""), (None, prose(950, 30)), (52, "one two"), (0, items[0][1])]
    rows = list(odd_rows)
    for k, text in items[:15]:
        words = text.split()
        cut = " ".join(words[:len(words) * 7 // 8])
        for j, part in enumerate((text.upper(), cut, " ".join(words[:len(words) // 2]))):
            # Short items at the start, inside and at the end of texts of all lengths.
            rows.append((1000 + 10 * k + j, f"{prose(k, 40 * j * j)} {part} {prose(99 + k, 30 + 400 * k)}", "a"))
    rows.append((2000, f"{prose(7, 25_000)}\n{items[3][1]} {prose(8, 25_000)} {items[14][1]}", "a"))
    rows += [(3000 + i, f"{items[5][1]} copied", "hot") for i in range(50)]
    return rows, items


def tables(spark, docs, corpus):
    rows, items = corpus
    return docs(rows), spark.createDataFrame(
        [(*i, "x") for i in items], "item_id bigint, text string, doc_id string")


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_ROWS, 0])
def test_all_contained_items_are_found(spark, docs, corpus, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", limit)
    got = find_contained(*tables(spark, docs, corpus)).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.shared, r.item_shingles) for r in got) == brute(*corpus)


def test_contaminated_rows_go_and_no_others(spark, docs, corpus):
    df, items = tables(spark, docs, corpus)
    kept = decontaminate(df, items)
    leaked = {i for i, *_ in brute(*corpus)}
    texts = {t for i, t, _ in corpus[0] if str(i) in leaked and brute([(i, t, "")], corpus[1])}
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(
        map(str, (r for r in df.collect() if r.text not in texts)))


def test_empty_sides(spark, docs, corpus):
    df, items = tables(spark, docs, corpus)
    assert find_contained(docs([]), items).count() == 0
    assert find_contained(df, items.limit(0)).count() == 0
    assert decontaminate(df, items.limit(0)).count() == df.count()
    assert decontaminate(docs([]), items).count() == 0


def test_items_of_few_shingles_are_found_in_thousands_of_documents(spark, docs, prose):
    """Items of 1 to 5 shingles, each alone in documents of many lengths."""
    items = [(10 * q + k, prose(7000 + 10 * q + k, 4 + q)) for q in range(1, 6) for k in range(5)]
    rows = [(i, f"{prose(i, 10 + i % 61)} {items[i % 25][1]} {prose(20_000 + i, 10 + i % 37)}", "a")
            for i in range(5000)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    wanted, want = {k: shingles(t) for k, t in items}, set()
    for i, t, _ in rows:
        own = shingles(t)
        want |= {(i, k) for k, w in wanted.items() if len(own & w) / len(w) >= 0.8}
    got = {(r.doc_id, r.item_id) for r in find_contained(docs(rows), table).collect()}
    assert len(want) >= 5000 and got == want


def test_signatures_keep_the_promised_miss(spark):
    """The load of a bin is the largest at which all shared shingles are hidden at most so often."""
    shared = decontamination.fewest(F.col("id"), 0.8)
    loads = {q: x for q, x in spark.range(1, 400).select("id", decontamination.load(shared, 1e-6)).collect()}
    for q, x in loads.items():
        chance = (1 - (1 - math.exp(-x)) / x) ** math.ceil(0.8 * q - 1e-9) if x > 1e-4 else x / 2
        assert 3e-7 < chance <= 1.01e-6
    assert sorted(loads.values()) == [loads[q] for q in sorted(loads)]


def test_a_stock_sentence_of_all_items_makes_no_pairs(spark, docs, prose):
    """300 items and 1,000 documents that share a sentence; ten documents contain an item each."""
    stock = "as everybody knows by now this is the one sentence that all of them hold"
    items = [(k, f"{prose(30_000 + k, 25)} {stock}") for k in range(300)]
    rows = [(i, f"{prose(i, 40)} {stock} {prose(i + 50_000, 40)}", "a") for i in range(1000)]
    rows += [(2000 + k, f"{prose(9, 30)} {items[k][1]}", "a") for k in range(10)]
    frame = docs(rows).selectExpr("doc_id", "text", "md5(text) as _key")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    named = table.selectExpr("item_id", "text as item", "md5(text) as _item_key")
    # Of 303,000 pairs of a document and an item; some share the word before the sentence too.
    assert decontamination.candidates(frame, named, 5, 0.8, 1e-6).count() <= 300
    got = {(r.doc_id, r.item_id) for r in find_contained(docs(rows), table).collect()}
    assert got == {(2000 + k, k) for k in range(10)}


def test_items_of_mostly_hot_shingles(spark, docs, prose):
    """Items that share all, nearly all or half of their shingles with many others, and parts of them."""
    stock = prose(1, 40)
    items = [(k, f"{stock} {prose(100 + k, n)}".strip()) for n in (0, 3, 8, 40) for k in range(100 * n, 100 * n + 15)]
    rows = [(i, f"{prose(i, 20)} {items[i % 60][1] if i % 3 else stock} {prose(i + 900, 9)}", "a") for i in range(120)]
    words = stock.split()
    rows += [(500 + n, f"{prose(n, 9)} {' '.join(words[:n])} {prose(n + 1, 9)}", "a") for n in range(5, 40)]
    got = find_contained(docs(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.shared, r.item_shingles) for r in got) == brute(rows, items)
