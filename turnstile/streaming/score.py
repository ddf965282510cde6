"""Structured Streaming: score arriving employee records with a model fitted
in batch.

Every fitted step is stateless per row — cleaning rules, the dropped-column
list, group modes (a small stream-static join), label codes (map literals or
a stream-static join), the replayed imputation equations, scaler statistics,
one-hot levels and the network — so the whole chain is a projection over each
micro-batch and needs no streaming state.  Fitting (profiles, dictionaries,
moments, training) needs a bounded table and stays in batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.expressions import name_lookup
from turnstile.operators.clean import clean, drop_columns
from turnstile.operators.encode import FeatureModel, LabelDictionary, apply_dictionary
from turnstile.operators.impute import ImputerModel, apply_group_modes
from turnstile.operators.model import turnover_report
from turnstile.plans.pipeline import Columns, Settings, prepare_table, train_and_score
from turnstile.session import checkpoint_dir


@dataclass
class ScoringModel:
    cols: Columns
    settings: Settings
    dropped: list[str]
    modes: DataFrame | None
    dictionary: LabelDictionary
    imputer: ImputerModel
    features: FeatureModel
    network: object

    def transform(self, df: DataFrame) -> DataFrame:
        """Raw records (batch or streaming) → (emp_identifier, turnover_percent)."""
        c, s = self.cols, self.settings
        out = drop_columns(clean(df, c.exempt, c.dates), self.dropped)
        if self.modes is not None:
            # A group the fit never saw has no mode: leave the cell null (the
            # label encoder then gives it the missing code, as in the fit)
            # rather than failing the running stream.
            out = apply_group_modes(out, self.modes, c.group, c.group_value,
                                    s.null_group, "null")
        (id_name,) = name_lookup(out, [c.id])
        out = out.withColumn("_orig_id", F.col(id_name))
        out = apply_dictionary(out, self.dictionary)
        out = self.imputer.transform(out)
        out = self.features.transform(out, keep=["_orig_id"])
        return turnover_report(self.network, out, "_orig_id")


def fit_scoring_model(df: DataFrame, cols: Columns = Columns(),
                      settings: Settings | None = None) -> ScoringModel:
    """Batch fit of everything the stream needs (no forest: scoring uses the network)."""
    s = settings or Settings(fit_forest=False)
    prep = prepare_table(df, cols, s)
    trained = train_and_score(prep["imputed"], cols, s)
    if not trained.get("trained"):
        raise ValueError("training table still has missing cells")
    return ScoringModel(cols, s, prep["dropped"], prep["modes"], prep["label_dictionary"],
                        prep["imputer"], trained["feature_model"], trained["mlp"])


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                fmt: str = "parquet", max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """File-source stream with an explicit schema (no inference on streams)."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_to_table(stream: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Drain a stream once (``availableNow``) into a parquet table under the
    shared checkpoint folder (with its own streaming checkpoint, so a restarted
    run resumes instead of repeating) and return it as a batch frame."""
    spark = stream.sparkSession
    root = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    query = (stream.writeStream.format("parquet").outputMode(output_mode)
             .option("checkpointLocation", f"{root}/_checkpoint")
             .option("path", f"{root}/data")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")
