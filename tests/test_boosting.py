"""The trees grown on binned rows against MLlib's, and what is stored on the way."""
import threading
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.ml import classification
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from feedloom.contracts import FEATURE_COLUMNS
from feedloom.functions import boosting as passes
from feedloom.operators import boosting
from feedloom.operators.frames import conform
from feedloom.plans import training
from feedloom.sources import bootstrap

COLUMNS = dict(labelCol="_label", featuresCol="_features", weightCol="_weight")
SHAPE = dict(maxIter=6, maxDepth=3, stepSize=0.1, seed=-3, checkpointInterval=2)


def assembled(rows, features=FEATURE_COLUMNS):
    return VectorAssembler(inputCols=features, outputCol="_features").transform(rows)


@pytest.fixture(scope="module")
def rows(spark):
    """Three partitions of rows of which some come twice, and one without any."""
    some = bootstrap.bootstrap(spark, 6000).withColumn("_label", F.col("is_click").cast("double"))
    some = conform(some, FEATURE_COLUMNS, keep=["_label"]).withColumn("_weight", F.expr("if(_label = 1, 2.7D, 1D)"))
    some = some.unionAll(some.where("hour_of_day = 3")).coalesce(1).repartition(3, "session_velocity")
    return some.unionAll(some.where("false").coalesce(1)).checkpoint()


def outline(node):
    if node.subtreeDepth() == 0:
        return pytest.approx(node.prediction(), abs=1e-9)
    return (node.split().featureIndex(), node.split().threshold(), outline(node.leftChild()), outline(node.rightChild()))


def outlines(model):
    return [outline(tree._java_obj.rootNode()) for tree in model.trees]


def flat(shape):
    return [x for part in shape for x in (flat(part) if isinstance(part, (tuple, list)) else [part])]


@pytest.mark.parametrize("more", [
    {}, {"featureSubsetStrategy": "0.8"}, {"featureSubsetStrategy": "0.3", "weightCol": "_weight"}])
def test_mllibs_trees(spark, rows, more):
    """Splits, values and importances, with all features of a node and with some, with weights and without."""
    settings = {**COLUMNS, **SHAPE, "featureSubsetStrategy": "all", **more}
    if "weightCol" not in more:
        del settings["weightCol"]
    ours = boosting.GBTClassifier(**settings).fit(assembled(rows))
    theirs = classification.GBTClassifier(**settings).fit(assembled(rows))
    got, wanted = (flat(outlines(m)) for m in (ours, theirs))
    assert len(got) == len(wanted) > 100
    for a, b in zip(got, wanted):
        assert (a.expected if hasattr(a, "expected") else a) == b
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert ours.treeWeights == theirs.treeWeights and ours.totalNumNodes == theirs.totalNumNodes
    score = vector_to_array("probability")[1]
    for model in (ours, theirs):
        rows = model.transform(assembled(rows) if "_features" not in rows.columns else rows).withColumn(
            f"p{'qr'[model is ours]}", score).drop("probability", "rawPrediction", "prediction")
    assert rows.where("abs(pr - pq) > 1e-9 or pr is null").count() == 0


def test_rows_that_cannot_be_split(spark, rows):
    """Constant features give trees of one leaf, as do rows whose label a split tells at once."""
    constant = boosting.GBTClassifier(**COLUMNS, **SHAPE).fit(assembled(rows, ["is_product"]))
    assert [tree.numNodes for tree in constant.trees] == [1] * 6
    told = assembled(rows.withColumn("is_product", F.col("_label").cast("int")), ["is_product"])
    ours, theirs = (kind(**COLUMNS, **SHAPE).fit(told) for kind in (boosting.GBTClassifier, classification.GBTClassifier))
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees] == [3] * 6


def test_labels_are_checked(spark, rows):
    with pytest.raises(Exception, match="(?i)label"):
        boosting.GBTClassifier(**COLUMNS, **SHAPE).fit(assembled(rows.withColumn("_label", F.lit(2.0))))


def test_what_is_not_known_is_left_to_mllib(spark, rows):
    settings = {**COLUMNS, **SHAPE, "minInstancesPerNode": 300}
    ours, theirs = (kind(**settings).fit(assembled(rows)) for kind in (boosting.GBTClassifier, classification.GBTClassifier))
    assert outlines(ours)[0][0] == outlines(theirs)[0][0] and ours.totalNumNodes == theirs.totalNumNodes


def test_many_partitions_meet_before_the_driver(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "COLLECTED", 2)
    some = {**COLUMNS, **SHAPE, "maxIter": 1, "maxDepth": 2}
    ours, theirs = (kind(**some).fit(assembled(rows)) for kind in (boosting.GBTClassifier, classification.GBTClassifier))
    assert [f for f in ours.featureImportances.indices] == [f for f in theirs.featureImportances.indices]


def test_chunks_hold_all_rows(monkeypatch, spark, rows):
    """Small chunks: the same trees, and as many rows in their roots."""
    monkeypatch.setattr(passes, "CHUNK", 100)
    model = boosting.GBTClassifier(**COLUMNS, **SHAPE).fit(assembled(rows))
    assert {tree._java_obj.rootNode().impurityStats().rawCount() for tree in model.trees} == {rows.count()}


def test_training_stores_compact_rows_and_leaves_nothing(spark, monkeypatch):
    """No stored table of rows takes 100 bytes a row (MLlib's took 200 and more), and none is left,
    nor a file of the scores."""
    monkeypatch.setattr(training, "FEW_ROWS", 0, raising=False)
    n, most, done = 20_000, {}, threading.Event()
    data = bootstrap.bootstrap(spark, n).checkpoint()
    kept = {info.id() for info in spark._jsc.sc().getRDDStorageInfo()}
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = {p.name for p in folder.glob("rdd-*")}

    def watch():
        while not done.is_set():
            for info in spark._jsc.sc().getRDDStorageInfo():
                if info.id() not in kept:
                    most[info.id()] = max(most.get(info.id(), 0), info.memSize() + info.diskSize())
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        training.fit(replace(training.COMMERCE, max_iter=12), data, "is_purchase")
    finally:
        done.set()
        watcher.join()
    assert most and max(most.values()) < 100 * 0.8 * n
    until = time.time() + 10
    while {i.id() for i in spark._jsc.sc().getRDDStorageInfo()} - kept and time.time() < until:
        time.sleep(0.1)
    assert {i.id() for i in spark._jsc.sc().getRDDStorageInfo()} <= kept
    assert len({p.name for p in folder.glob("rdd-*")} - before) <= 1  # test_cuts' and others' own


def test_few_rows_are_left_to_mllib(spark, monkeypatch):
    """Up to a number of rows per core; beyond, the same model comes from the passes over chunks."""
    data, seen, grow = bootstrap.bootstrap(spark, 4000).checkpoint(), [], boosting.GBTClassifier._grow
    monkeypatch.setattr(boosting.GBTClassifier, "_grow", lambda *given: seen.append(1) or grow(*given))
    task = replace(training.COMMERCE, max_iter=3, max_depth=3)
    few = training.fit(task, data, "is_purchase")[0].stages[-1]
    assert not seen
    monkeypatch.setattr(training, "FEW_ROWS", 0)
    many = training.fit(task, data, "is_purchase")[0].stages[-1]
    assert seen and many.totalNumNodes == few.totalNumNodes
    assert many.featureImportances.toArray() == pytest.approx(few.featureImportances.toArray(), abs=0.05)
