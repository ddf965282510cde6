"""Models and scoring (M10-M14, O2) with Spark ML.

Training is distributed by Spark ML (tree statistics and L-BFGS gradients are
aggregated across partitions); only model parameters reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile import defaults as D
from turnstile.functions.expressions import name_lookup
from turnstile.operators import forest as H
from turnstile.operators.network import Network

# Trees grown in one fit.
TREES_PER_FIT = 250
# Rows from which the trees are grown from histograms in numpy.
HISTOGRAM_ROWS = 250_000


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Horizontal concatenation of numeric columns into one vector (P12)."""
    return VectorAssembler(inputCols=list(features), outputCol=output,
                           handleInvalid="error").transform(df)


def fit_forest(df: DataFrame, features: Sequence[str], label: str,
               features_col: str = "_forest_features", **params):
    """Random forest on raw (unscaled, label-coded) feature columns.

    ``label`` must hold class indices 0..k-1 (double).  Parameters default to
    the reference's: 1000 trees, depth 4, 2 rows per leaf, √p features, seed 0.

    Spark's fitting keeps a count per row and tree in the cache, so the trees are
    grown in batches of TREES_PER_FIT with seeds of their own.  From HISTOGRAM_ROWS
    rows on, ``forest.fit_histogram_forest`` grows as many trees of the same kind,
    which keeps nothing by row and tree and takes a fraction of the time; the two
    draw other random numbers.
    """
    feats = name_lookup(df, features)
    (lab,) = name_lookup(df, [label])
    settings = {**D.FOREST_PARAMS, **params}
    trees, seed = settings.pop("numTrees"), settings.pop("seed")
    n_rows, classes = _countable(df, feats, lab, settings)
    if n_rows >= HISTOGRAM_ROWS:
        return Forest([H.fit_histogram_forest(df, feats, lab, classes, n_rows, trees, settings["maxDepth"],
                                              settings["minInstancesPerNode"], seed)])
    rows = assemble(df.select(*feats, lab), feats, features_col)
    sizes = [min(TREES_PER_FIT, trees - k) for k in range(0, trees, TREES_PER_FIT)]
    return Forest([RandomForestClassifier(featuresCol=features_col, labelCol=lab, numTrees=n,
                                          seed=seed + k, **settings).fit(rows)
                   for k, n in enumerate(sizes)])


def _countable(df: DataFrame, feats: Sequence[str], lab: str, settings: dict) -> tuple[int, int]:
    """(rows, classes) if histograms can be made of the table, else (0, 0)."""
    known = {**D.FOREST_PARAMS, **{k: settings.get(k) for k in ("maxDepth", "minInstancesPerNode")}}
    known = {k: v for k, v in known.items() if k not in ("numTrees", "seed")}
    if settings != known or not 0 < len(feats) <= H.MAX_COLUMNS or settings["maxDepth"] > H.MAX_DEPTH:
        return 0, 0
    y = F.col(lab).cast("double")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(y).alias("most"),
                 F.count_if(F.coalesce((y < 0) | (y != F.floor(y)), F.lit(True))).alias("bad")).first()
    if not row["n"] or row["bad"] or not 1 <= row["most"] < H.MAX_CLASSES:
        return 0, 0
    return row["n"], int(row["most"]) + 1


@dataclass
class Forest:
    """Random forests that count as one."""
    parts: list

    @property
    def numTrees(self) -> int:
        return sum(m.getNumTrees for m in self.parts)

    @property
    def featureImportances(self) -> np.ndarray:
        """Mean over the parts by their number of trees, normalised to 1."""
        total = sum(m.getNumTrees * (m.featureImportances if isinstance(m, H.HistogramForest)
                                     else m.featureImportances.toArray()) for m in self.parts)
        return total / total.sum() if total.sum() else total


def feature_importance(spark, model, names: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` with importance = 100 · round(x, 3) (half to
    even), sorted by importance descending then name."""
    values = np.asarray(model.featureImportances).tolist()
    frame = spark.createDataFrame(list(zip(names, [float(v) for v in values])),
                                  "feature string, raw double")
    return (frame.select("feature", (F.lit(100.0) * F.bround("raw", 3)).alias("importance"))
            .orderBy(F.desc("importance"), F.asc("feature")))


def fit_mlp(df: DataFrame, features_col: str, label: str, n_inputs: int,
            hidden: Sequence[int] = D.MLP_HIDDEN, n_outputs: int = 2,
            max_iter: int = D.MLP_MAX_ITER, block_size: int = D.MLP_BLOCK_SIZE,
            seed: int = 0):
    """Feed-forward network ``[n_inputs, *hidden, n_outputs]`` with sigmoid hidden
    units and a softmax output, trained by L-BFGS: the alternative to
    ``network.fit_relu``."""
    (lab,) = name_lookup(df, [label])
    mlp = MultilayerPerceptronClassifier(
        featuresCol=features_col, labelCol=lab,
        layers=[n_inputs, *hidden, n_outputs], maxIter=max_iter,
        blockSize=block_size, seed=seed)
    return mlp.fit(df)


def scored(model, df: DataFrame, features_col: str = "features") -> DataFrame:
    """``df`` with ``probability`` (an array by class) and ``prediction``.  A network,
    Spark's own too, scores in column expressions."""
    if isinstance(model, MultilayerPerceptronClassificationModel):
        features_col, model = model.getFeaturesCol(), Network.from_spark_ml(model)
    if isinstance(model, Network):
        return model.transform(df, features_col)
    return model.transform(df).withColumn("probability", vector_to_array("probability"))


def turnover_report(model, df: DataFrame, id_col: str) -> DataFrame:
    """``(emp_identifier, turnover_percent)`` for every row: 100 · P(class 0),
    class 0 being 'No' (has left)."""
    (i,) = name_lookup(df, [id_col])
    return scored(model, df).select(F.col(i).alias("emp_identifier"),
                                    (F.lit(100.0) * F.col("probability")[0]).alias("turnover_percent"))


def evaluate_accuracy(model, df: DataFrame, label: str) -> DataFrame:
    """One row: accuracy in percent (4 decimals) and the row count."""
    (lab,) = name_lookup(df, [label])
    return scored(model, df).agg(
        F.round(F.lit(100.0) * F.avg((F.col("prediction") == F.col(lab)).cast("double")), 4)
        .alias("accuracy_percent"),
        F.count(F.lit(1)).alias("n_rows"))
