import math
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.llm import toxicity
from feedloom.llm.toxicity import Settings, held_out, score_documents


def auc(score, label):
    score, label = np.array(score), np.array(label)
    return np.mean(score[label == 1][:, None] > score[label == 0]) + 0.5 * np.mean(
        score[label == 1][:, None] == score[label == 0])


def trained_by(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


@pytest.fixture(scope="module")
def labelled(prose):
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, prose(i, 30) + (f" you {['idiot', 'morons', 'stupidly'][i % 7 % 3]} {prose(i, 5)}" if bad else ""),
                     "a", int(bad)))
    return rows


def labels(spark, rows):
    return spark.createDataFrame([(i, y, "x") for i, _, _, y in rows], "doc_id bigint, toxic int, score string")


def test_held_out_rows_are_told_apart(spark, docs, labelled):
    out = score_documents(docs([r[:3] for r in labelled]), labels(spark, labelled))
    got = {r.doc_id: r for r in out.withColumn("kept_out", held_out("doc_id")).collect()}
    assert {i: r.kept_out for i, r in got.items()} == {i: not trained_by(i) for i, *_ in labelled}
    test = [(got[i].score, y) for i, _, _, y in labelled if not trained_by(i)]
    assert auc(*zip(*test)) > 0.99
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_do_not_matter(spark, docs, labelled):
    df = docs([r[:3] for r in labelled])
    turned = [(i, t, s, y if trained_by(i) else 1 - y) for i, t, s, y in labelled]
    a = score_documents(df, labels(spark, labelled)).select("doc_id", "score").collect()
    b = score_documents(df, labels(spark, turned)).select("doc_id", "score").collect()
    assert sorted(a) == sorted(b)


def test_naming_a_group_does_not_move_the_score(spark, docs, prose):
    """Toxic rows name one group far more often; the penalty takes that away from the score."""
    rows = []
    for i in range(800):
        bad = i % 2 == 0
        group = "muslims" if (i % 10 < 8) == bad else "christians"
        rows.append((i, f"{prose(i, 15)} {group} {'pathetic' if bad and i % 3 else ''}", "a", int(bad)))
    probe = docs([(1, "the muslims met today", "a"), (2, "the christians met today", "a")])
    df, gap = docs([r[:3] for r in rows]), {}
    for strength in (0.0, 5.0):
        model = toxicity.fit(
            df.select("doc_id", "text"), labels(spark, rows).selectExpr("doc_id", "toxic as label"),
            ~held_out("doc_id"), Settings(counterfactual=strength))
        score = toxicity.scorer(model)
        gap[strength] = abs(score("the muslims met today") - score("the christians met today"))
        assert score("pathetic") > score("today")
    assert gap[0.0] > 0.3 and gap[5.0] < 0.1 and probe.count() == 2


def test_swaps_stay_within_their_kind():
    assert toxicity.swapped(["the", "muslims", "and", "women"], 1) == ["the", "christians", "and", "men"]
    assert toxicity.swapped(["no", "group"], 1) is None


def test_each_other_term_of_a_kind_makes_one_variant():
    def all_of(text):
        return [" ".join(v) for v in toxicity.variants(text.split())]

    assert all_of("the women met") == ["the men met"]
    assert sorted(all_of("a muslim said")) == sorted(
        f"a {t} said" for t in ("christian", "jewish", "hindu", "buddhist", "atheist"))
    assert all_of("old women") == ["young men", "elderly women"]
    assert all_of("women and men") == [] and all_of("no group") == []


def test_every_row_of_the_penalty_is_another_text(prose):
    texts = ["the women met", "a muslim said", "no group"]
    names = [f for t in texts for w in t.split() for f in toxicity.features(w)] + ["=men"]
    batch = pd.DataFrame({"text": texts, "label": [0, 1, 0]})
    rows = pd.concat(toxicity.training_rows(names)(iter([batch])))
    pairs = rows[rows["label"].isna()]
    assert len(pairs) == 1 + 5 and all(len(ids) for ids in pairs["ids"])


def test_odd_rows_and_missing_labels(spark, docs, odd_rows, labelled):
    none = labels(spark, [])
    df = docs(odd_rows)
    out = score_documents(df, none)
    assert out.count() == len(odd_rows) and out.where("predicted = 1").count() == 0
    assert set(out.columns) == set(df.columns)
    doubled = labels(spark, [*labelled, (None, "", "", 1), (4, "", "", None), (10**9, "", "", 1), *labelled[:5]])
    rows = score_documents(docs(odd_rows + [r[:3] for r in labelled]), doubled).collect()
    assert len(rows) == len(odd_rows) + len(labelled)
    assert all(0 <= r.score <= 1 for r in rows)
    assert score_documents(docs([]), doubled).count() == 0
    one_class = labels(spark, [r for r in labelled if r[3] == 0])
    assert score_documents(df, one_class).where("predicted = 1").count() == 0


def test_the_sample_is_bounded_whatever_repeats(spark, docs):
    """100 ids of 500 rows each, two thirds of them equal."""
    rows = [(k % 100, f"text {k}" if k % 3 == 0 else f"text {k % 100}", "a") for k in range(50_000)]
    ids = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, label int")
    sample = toxicity.labelled_sample(docs(rows).select("doc_id", "text"), ids, F.lit(True), 50).collect()
    assert len(sample) == 50
    few = toxicity.labelled_sample(docs(rows[:300]).select("doc_id", "text"), ids, F.lit(True), 5000)
    assert few.count() == len({r[:2] for r in rows[:300]})


def test_mentions_are_put_into_texts_without_a_group():
    names = ["=today", "^wom", "^mus", "^blac"]
    batch = pd.DataFrame({"text": ["we met today", "", None, "the women met"], "label": [0, 1, 0, 1]})
    rows = pd.concat(toxicity.training_rows(names, 3)(iter([batch])))
    pairs = rows[rows["label"].isna()]
    # Of the terms, women, woman, muslim(s), musulman(e)s and black have a feature.
    assert len(pairs) == 3 * 3 + 1
    assert all(set(ids) <= {1, 2, 3} and set(np.sign(x)) <= {1.0, -1.0} for ids, x in zip(pairs["ids"], pairs["values"]))
    nothing = pd.concat(toxicity.training_rows(["=today"], 3)(iter([batch])))
    assert nothing["label"].notna().all()


def test_mentions_keep_the_beginnings_of_words_from_leaking(spark, docs, prose):
    """Toxic rows hold a word that begins as some terms do; naming those groups must not count."""
    rows = [(i, f"{prose(i, 20)} {'musch pathetic' if i % 2 else 'fine'}", "a", i % 2) for i in range(600)]
    df, found = docs([r[:3] for r in rows]), {}
    for strength in (0.0, 5.0):
        model = toxicity.fit(
            df.select("doc_id", "text"), labels(spark, rows).selectExpr("doc_id", "toxic as label"),
            ~held_out("doc_id"), Settings(counterfactual=strength))
        score = toxicity.scorer(model)
        assert model.pairs > 500 and score("musch pathetic") > 0.9 and score("fine") < 0.1
        found[strength] = score("the muslims met") - score("the met")
    assert found[0.0] > 0.2 and abs(found[5.0]) < 0.05


def plainly_trained(names, rows, bias, settings):
    """The training loss and its gradient by loops over rows, and the same steps."""
    n, w = len(names), [0.0] * len(names) + [bias]
    mean, square = [0.0] * (n + 1), [0.0] * (n + 1)
    texts = [(y, dict(zip(i, v))) for y, i, v in rows if y is not None]
    pairs = [dict(zip(i, v)) for y, i, v in rows if y is None]
    for step in range(1, settings.steps + 1):
        grad = [settings.l2 * x for x in w[:n]] + [0.0]
        for y, x in texts:
            error = (1 / (1 + math.exp(-(w[n] + sum(w[i] * v for i, v in x.items())))) - y) / len(texts)
            for i, v in x.items():
                grad[i] += error * v
            grad[n] += error
        for x in pairs:
            moved = sum(w[i] * v for i, v in x.items())
            for i, v in x.items():
                grad[i] += 2 * settings.counterfactual / len(pairs) * moved * v
        for i, g in enumerate(grad):
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            w[i] -= settings.rate * (mean[i] / (1 - 0.9 ** step)) / (math.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-9)
    return w


def test_training_equals_plain_loops():
    rng, names = np.random.default_rng(4), [f"f{i}" for i in range(12)]
    rows = []
    for k in range(60):
        ids = sorted(rng.choice(12, rng.integers(0, 6), replace=False).tolist())
        rows.append((float(k % 2) if k < 40 else None, ids, rng.normal(size=len(ids)).tolist()))
    settings = Settings(steps=40, counterfactual=3.0)
    model = toxicity.trained(names, pd.DataFrame(rows, columns=["label", "ids", "values"]), -0.3, settings)
    want = plainly_trained(names, rows, -0.3, settings)
    assert [model.weights.get(f, 0.0) for f in names] + [model.bias] == pytest.approx(want, abs=1e-7)
    assert model.pairs == 20
