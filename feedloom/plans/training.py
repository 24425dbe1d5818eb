"""Training of the engagement and the commerce classifier with Spark MLlib."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.contracts import CORE_FEATURES, FEATURE_COLUMNS
from feedloom.operators.boosting import GBTClassifier
from feedloom.operators.evaluation import auc
from feedloom.operators.frames import conform
from feedloom.operators.split import train_test_split
from feedloom.operators.summary import MIN_EXAMPLES, choose_target, target, target_candidates
from feedloom.sources.datasets import load_with_fallback
from feedloom.sources.files import set_checkpoint_dir


@dataclass(frozen=True)
class Task:
    """What to train. Depth 5 bounds a tree to 32 leaves."""

    name: str
    target: str | None
    step_size: float
    feature_fraction: float
    reweight: bool
    max_iter: int = 100
    max_depth: int = 5
    seed: int = 42


#: Rows per core up to which models train side by side, and rows that a task writes or reads at most.
ROWS_PER_TASK = 500_000
#: Rows that a task of a boosting pass takes in at most, chunk by chunk.
ROWS_PER_PASS = 4_000_000
#: Rows per core up to which MLlib's own passes are quicker: theirs start sooner, and its objects fit in memory.
FEW_ROWS = 100_000
#: So often the driver's garbage is collected during training.
RELEASE_SECONDS = 20

# Learning rates and feature fractions. Commerce picks its target from the data.
ENGAGEMENT = Task("engagement", "is_click", 0.05, 0.9, False)
COMMERCE = Task("commerce", None, 0.03, 0.8, True)


def usable_target(task: Task):
    """A check for ``load_with_fallback``: the usable target's name and class counts, or None."""
    def check(df: DataFrame) -> dict | None:
        names = [task.target] if task.target else None
        candidates = target_candidates(df, names) if names else target_candidates(df)
        chosen = choose_target(candidates, MIN_EXAMPLES).head()
        return chosen.asDict() if chosen["target"] else None

    return check


def row_id(df: DataFrame) -> str:
    return "impression_id" if "impression_id" in df.columns else "sample_id"


def spread_evenly(df: DataFrame, rows: int, most: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in partitions of about equal size, at least one per core and one per ``most`` of its
    ``rows``. Boosting keeps the partitions it is given through its thousand passes, and those of
    files follow row groups, of which many splits hold none. Rows are dealt by all their values, so
    keys may be null or repeat, and a lost task gets the same rows again."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, math.ceil(rows / most / cores)), *df.columns)


def fit(task: Task, df: DataFrame, name: str) -> tuple[PipelineModel, DataFrame]:
    """A model trained on 80 % of the rows, and the scored other 20 %.

    With ``reweight`` positives weigh as much in total as negatives. The assembler keeps the
    feature names, so a model knows its own inputs.
    """
    key = row_id(df)
    labelled = df.withColumn("_label", target(df, name).cast("double"))
    frame = conform(labelled, FEATURE_COLUMNS, keep=[key, "_label"])
    train, test = train_test_split(frame, "_label", key, seed=task.seed)
    classifier = GBTClassifier(
        labelCol="_label", maxIter=task.max_iter, maxDepth=task.max_depth,
        stepSize=task.step_size, featureSubsetStrategy=str(task.feature_fraction), seed=task.seed,
        cacheNodeIds=False, checkpointInterval=10,
    )
    counts = train.agg(
        F.count_if(F.col("_label") == 1).alias("p"), F.count_if(F.col("_label") == 0).alias("n"),
        F.count("*").alias("rows")).head()
    if task.reweight:
        weight = F.when(F.col("_label") == 1, counts["n"] / max(counts["p"], 1)).otherwise(1.0)
        train = train.withColumn("_weight", weight)
        classifier.setWeightCol("_weight")
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="_features")
    classifier.setFeaturesCol("_features")
    cores = df.sparkSession.sparkContext.defaultParallelism
    classifier.few, classifier.points_from = counts["rows"] <= FEW_ROWS * cores, assembler.transform(train)
    boosted = classifier.fit(assembler.transform(spread_evenly(train, counts["rows"], ROWS_PER_PASS)))
    model = PipelineModel([assembler, boosted])
    return model, probability(model, test, "score")


def model_features(model: PipelineModel) -> list[str]:
    """The contract features a model was trained on; the core ones if it names none."""
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            known = [c for c in stage.getInputCols() if c in FEATURE_COLUMNS]
            return known or list(CORE_FEATURES)
    return list(CORE_FEATURES)


def probability(model: PipelineModel, df: DataFrame, column: str) -> DataFrame:
    """Add the model's probability of class 1. Row by row; trees travel with the task."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(column))


def feature_importance(model: PipelineModel) -> DataFrame:
    """Feature and importance, largest first. Importances are normalised gains and sum to 1."""
    names, gains = model_features(model), model.stages[-1].featureImportances.toArray()
    pairs = [(name, float(gain)) for name, gain in zip(names, gains)]
    spark = SparkSession.getActiveSession()
    frame = spark.createDataFrame(pairs, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


def side_by_side(spark: SparkSession, functions: list[Callable[[], object]], rows: int = 0) -> list:
    """The functions' results, all run at once from threads of the driver, each in a scheduler pool of
    its own. Many small jobs one after the other, as boosting is, leave executors idle that another
    model can use; under spark.scheduler.mode=FAIR the pools share them evenly. With more than
    ROWS_PER_TASK ``rows`` per core one model alone keeps them busy and two would push each other's
    stored rows to disk, so they run one after the other. The first failure is raised when all have
    ended.

    Boosting runs a job per level of a tree, and Spark takes buffers of 4 MB in the driver for each of
    a job's broadcasts, whatever the rows. Its heap grows by them up to the limit unless it is collected
    now and then, which also lets Spark's cleaner drop the broadcasts and shuffles of ended jobs."""
    few = rows <= ROWS_PER_TASK * spark.sparkContext.defaultParallelism

    def in_pool(i: int, function: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"side-{i}")
        return function()

    with ThreadPoolExecutor(len(functions) if few else 1) as threads:
        target = inheritable_thread_target(spark)(in_pool)
        running = [threads.submit(target, i, f) for i, f in enumerate(functions)]
        spark._jvm.System.gc()
        while wait(running, RELEASE_SECONDS).not_done:
            spark._jvm.System.gc()
        return [r.result() for r in running]


def train(
    spark: SparkSession, task: Task, paths: list[str], model_path: str
) -> tuple[PipelineModel, dict]:
    """Train on the first usable dataset of ``paths`` and save the model.

    Returns the model and the metadata row the ledger keeps.
    """
    set_checkpoint_dir(spark)
    df, path, used_fallback, found = load_with_fallback(spark, paths, usable_target(task))
    model, scored = fit(task, df, found["target"])
    # Stored once, so that the two passes of the metric do not score the rows twice.
    quality = auc(scored.select("_label", "score").checkpoint(), "_label", ["score"]).head()
    model.write().overwrite().save(model_path)
    # The names of the metadata's fields.
    return model, {
        "task": task.name,
        "dataset_path": path,
        "used_fallback_dataset": used_fallback,
        "target": found["target"],
        "auc_roc": quality["auc"] if quality else None,
        "row_count": found["rows"],
        "positive_count": found["positives"],
        "negative_count": found["negatives"],
        "model_path": model_path,
    }
