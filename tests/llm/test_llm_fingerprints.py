import hashlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import fingerprints as fp


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def sketched(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return fp.with_sketch(df, F.col("text"), "sketch")


def pairs(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, F.col("a"), "x"), F.col("b"), "y")
    x, y = F.col("x"), F.col("y")
    return df.select(fp.containment(x, y), fp.containment(y, x), fp.resemblance(x, y)).head()


def test_short_texts_are_exact(spark, prose):
    text = prose(1, 20)
    words = text.split()
    for other in (text, " ".join(words[:10]), " ".join(words[5:] + ["new"]), "nothing in common with it at all", ""):
        a, b = shingles(text), shingles(other)
        got = pairs(spark, text, other)
        want = (len(a & b) / len(a), len(a & b) / len(b) if b else 0, len(a & b) / len(a | b))
        assert tuple(got) == pytest.approx(want)
    assert tuple(pairs(spark, None, "")) == (1.0, 1.0, 1.0)


def test_short_texts_in_long_ones_are_lost_with_the_documented_chance(spark, prose):
    """Texts of 10 shingles, each wholly in another of 600: (7/8)^10, 26 %, have no common hash."""
    rows = []
    for i in range(1000):
        long = prose(30_000 + i, 604, 10**6)
        rows.append((" ".join(long.split()[100:114]), long))
    df = spark.createDataFrame(rows, "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, F.col("a"), "x"), F.col("b"), "y")
    got = [r[0] for r in df.select(fp.containment(F.col("x"), F.col("y"))).collect()]
    assert set(got) == {0.0, 1.0}
    assert abs(got.count(0.0) / len(got) - (1 - 1 / fp.SCALE) ** 10) < 0.05


def test_containment_between_unequal_texts(spark, prose):
    passage, rest = prose(2, 600, 10**6), prose(3, 20_000, 10**6)
    inside, over, _ = pairs(spark, passage, f"{rest} {passage} {rest[:5000]}")
    assert inside > 0.95 and over < 0.1


def test_merged_sketches_equal_the_sketch_of_the_union(spark, prose):
    texts = [prose(i, 700, 10**6) for i in range(4)]
    parts = sketched(spark, texts).withColumn("group", F.lit("g"))
    whole = fp.merged_by(parts, ["group"], "sketch").head().sketch
    lowest = min(r.sketch.threshold for r in parts.collect())
    assert whole.threshold == lowest
    assert whole.hashes == sorted({h for r in parts.collect() for h in r.sketch.hashes if h <= lowest})
    a, b = (r.sketch for r in sketched(spark, texts[:2]).orderBy("i").collect())
    both = spark.createDataFrame([(a, b)], parts.select(
        F.col("sketch").alias("a"), F.col("sketch").alias("b")).schema)
    assert both.select(fp.merged(F.col("a"), F.col("b")).alias("m")).head().m.hashes == sorted(
        {h for h in a.hashes + b.hashes if h <= min(a.threshold, b.threshold)})


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (i, t, _) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        quarter = len(t) // 4
        out.append((i, len(t), t[:len(t) - quarter] + following[:quarter]))
    return out


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_edits_with_the_next_document(spark, docs, odd_rows, prose, partitions):
    rows = odd_rows + [(20 + 3 * i, prose(i, i % 50), "a") for i in range(120)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fp.fingerprint_documents(docs(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    mine = sorted((str(r.doc_id), r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in got)
    assert mine == sorted((str(i), n, hashlib.sha256(e.encode()).hexdigest()) for i, n, e in brute_edits(rows))


def test_single_rows_and_empty_tables(docs):
    row, = fp.fingerprint_documents(docs([(5, "a b c d e f g h", "x")])).collect()
    assert row.next_sketch == row.sketch and row.edited == "a b c d e f a b"
    assert fp.fingerprint_documents(docs([])).count() == 0


def test_estimates_are_close(spark, docs, prose):
    rows = [(i, prose(i, 300 + 40 * i, 10**6), "a") for i in range(40)]
    df = fp.fingerprint_documents(docs(rows))
    share = fp.containment(F.col("sketch"), F.col("edited_sketch")).alias("near")
    errors = []
    for r, (i, n, edited) in zip(df.select("doc_id", share).orderBy("doc_id").collect(), brute_edits(rows)):
        own = shingles(rows[i][1])
        errors.append(abs(r.near - len(own & shingles(edited)) / len(own)))
    assert sum(errors) / len(errors) < 0.06 and max(errors) < 0.25
