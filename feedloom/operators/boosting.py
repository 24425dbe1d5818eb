"""Gradient boosted trees for many rows: MLlib's trees, grown on binned rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import classification
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import boosting
from feedloom.sources.files import delete_folder

# Sent along with the passes, as Python workers may lack the package.
cloudpickle.register_pickle_by_value(boosting)

#: Deepest trees that are grown here; a level's sums grow with its nodes.
DEEPEST = 8
#: A bin is a byte.
MOST_BINS = 256
#: Sums of more partitions meet on the executors before they come to the driver.
COLLECTED = 64


def scala_object(spark: SparkSession, name: str):
    return spark._jvm.java.lang.Class.forName(f"org.apache.spark.{name}$").getField("MODULE$").get(None)


class GBTClassifier(classification.GBTClassifier):
    """MLlib's classifier, which finds the same trees by cheaper passes.

    MLlib keeps rows as objects of some 200 bytes, which come back from disk one by one in each of a
    thousand passes once they outgrow the executors' storage. Here they are chunks of arrays: a byte
    per feature that can be split on, and ten for label, weight and score. A pass takes in a chunk at a
    time and returns the sums of a level. Split points, drawn features, gains and leaves are those of
    MLlib, up to the order of sums. What this does not know (sampling of rows, categories, bounds on
    leaves) is left to MLlib."""

    #: The same rows as the dataset's, where reading them twice for the split points is cheaper.
    points_from: DataFrame | None = None
    #: Whether the rows are so few that MLlib is to grow the trees itself.
    few = False

    def _fit(self, dataset: DataFrame) -> classification.GBTClassificationModel:
        if self.few:
            return super()._fit(dataset)
        self._transfer_params_to_java()
        spark = dataset.sparkSession
        schema = dataset._jdf.schema().apply(self.getFeaturesCol())
        categories = scala_object(spark, "ml.util.MetadataUtils").getCategoricalFeatures(schema)
        plain = (
            categories.isEmpty() and 1 <= self.getMaxDepth() <= DEEPEST and self.getMaxBins() <= MOST_BINS
            and self.getSubsamplingRate() == 1 and self.getMinInstancesPerNode() == 1
            and self.getMinInfoGain() == 0 and self.getMinWeightFractionPerNode() == 0
            and not self.isDefined(self.validationIndicatorCol))
        if not plain:
            return super()._fit(dataset)
        points, per_node = self._split_points(
            dataset if self.points_from is None else self.points_from, categories)
        trees = self._grow(spark, self._chunks(dataset, points), points, per_node)
        return self._copyValues(self._create_model(self._java_model(spark, trees, points)))

    def _split_points(self, dataset: DataFrame, categories) -> tuple[list[np.ndarray], int]:
        """MLlib's split points of each feature, and how many features a node draws. It also refuses
        labels other than 0 and 1, negative weights, and features that are not numbers."""
        spark = dataset.sparkSession
        rows = scala_object(spark, "ml.util.DatasetUtils").extractInstances(
            self._java_obj, dataset._jdf, spark._jvm.scala.Option.apply(2))
        kind = scala_object(spark, "mllib.tree.configuration.Algo").Classification()
        strategy = self._java_obj.getOldBoostingStrategy(categories, kind).treeStrategy()
        strategy.setAlgo("Regression")
        facts = scala_object(spark, "ml.tree.impl.DecisionTreeMetadata").buildMetadata(
            rows, strategy, 1, self.getFeatureSubsetStrategy())
        found = scala_object(spark, "ml.tree.impl.RandomForest").findSplits(rows, facts, self.getSeed())
        return [np.array([split.threshold() for split in of]) for of in found], facts.numFeaturesPerNode()

    def _chunks(self, dataset: DataFrame, points: list[np.ndarray]) -> RDD:
        columns = [vector_to_array(self.getFeaturesCol()).alias("features"),
                   F.col(self.getLabelCol()).cast("double").alias("label")]
        if self.isDefined(self.weightCol) and self.getWeightCol():
            columns.append(F.col(self.getWeightCol()).cast("double").alias("weight"))
        able = {feature: of for feature, of in enumerate(points) if of.size}
        to_chunks, load = boosting.to_chunks, boosting.pickle.loads
        chunks = dataset.select(*columns).mapInArrow(lambda batches: to_chunks(batches, able), "chunk binary")
        return chunks.rdd.map(lambda row: load(row[0])).persist(StorageLevel.MEMORY_AND_DISK)

    def _grow(self, spark: SparkSession, state: RDD, points: list[np.ndarray], per_node: int) -> list[boosting.Tree]:
        """All trees. After each, the rows are stored anew with its values added to their scores, now and
        then in the checkpoint folder, so that a lost executor does not lead back to the first tree."""
        able = {feature: row for row, feature in enumerate(f for f, of in enumerate(points) if of.size)}
        slots = boosting.share_cells([points[feature].size + 1 for feature in able])
        every = self.getCheckpointInterval()
        before, file, trees = None, None, []
        try:
            for number in range(self.getMaxIter()):
                tree = boosting.Tree(self.getMaxDepth(), boosting.drawn_features(
                    len(points), per_node, self.getSeed() + number))
                more = True
                while more:
                    path, full = rows_of(tree.path, able), len(tree.path) + 1 == tree.depth
                    flat = total(state.mapPartitions(summing(slots, path, not number, full)))
                    if before is not None:
                        # The first pass has stored the rows of now.
                        before.unpersist()
                        before = None
                        if state.is_checkpointed:
                            old, file = file, state.getCheckpointFile()
                            remove(spark, old)
                    sums, totals = boosting.taken_apart(flat, slots, len(path), full)
                    more = tree.split({feature: sums[row] for feature, row in able.items()}, totals)
                trees.append(tree)
                if number + 1 < self.getMaxIter():
                    values = tree.leaves() * (self.getStepSize() if number else 1.0)
                    before, state = state, state.mapPartitions(adding(rows_of(tree.path, able), values)).persist(
                        StorageLevel.MEMORY_AND_DISK)
                    if every > 0 and (number + 1) % every == 0 and state.context.getCheckpointDir():
                        state.checkpoint()
        finally:
            for rows in (before, state):
                if rows is not None:
                    rows.unpersist()
            remove(spark, file)
        return trees

    def _java_model(self, spark: SparkSession, trees: list[boosting.Tree], points: list[np.ndarray]):
        """MLlib's model of the trees. Two leaves that say the same become one, as in MLlib."""
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        parts, calculator = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

        def build(tree: boosting.Tree, level: int, k: int) -> tuple:
            split, (weight, total, squares, n) = tree.nodes[level, k]
            value = float(total / weight) if weight else 0.0
            children = [build(tree, level + 1, 2 * k + side) for side in (0, 1)] if split else []
            stats = gateway.new_array(jvm.double, 3)
            stats[0], stats[1], stats[2] = float(weight), float(total), float(squares)
            common = float(boosting.impurity(weight, total, squares)), calculator(stats, int(n))
            if not split or children[0][1] is not None and children[0][1] == children[1][1]:
                return parts.LeafNode(value, *common), value
            at = parts.ContinuousSplit(split[1], float(points[split[1]][split[2]]))
            return parts.InternalNode(
                value, common[0], split[0], children[0][0], children[1][0], at, common[1]), None

        kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        models, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
        for i, tree in enumerate(trees):
            models[i] = kind(f"dtr_{self.uid}_{i}", build(tree, 0, 0)[0], len(points))
            weights[i] = self.getStepSize() if i else 1.0
        return jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, models, weights, len(points), 2)


def rows_of(path: list[dict], able: dict[int, int]) -> list[dict]:
    """A path by the rows of the chunks' bins, which only features with more than one have."""
    return [{k: (able[feature], place) for k, (feature, place) in splits.items()} for splits in path]


def summing(slots: list[boosting.Slot], path: list[dict], first: bool, full: bool) -> Callable:
    level_sums = boosting.level_sums
    return lambda chunks: level_sums(chunks, slots, path, first, full)


def adding(path: list[dict], values: np.ndarray) -> Callable:
    add_tree = boosting.add_tree
    return lambda chunks: add_tree(chunks, path, values)


def total(sums: RDD) -> np.ndarray:
    """The sum of the partitions' arrays."""
    if sums.getNumPartitions() > COLLECTED:
        return sums.treeReduce(np.add)
    return sum(sums.collect())


def remove(spark: SparkSession, file: str | None) -> None:
    if file:
        delete_folder(spark, file)
