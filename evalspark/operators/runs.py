"""E5: a run over several models, saved after each one and resumed where it broke off.

``results/`` holds one folder of result rows per model, ``manifest/`` one record per finished
model. A model's rows are written first and its record last, so a record says that the rows are
whole; rows without a record (the run broke while writing) are replaced by the next attempt.
A model whose evaluation raises is finished too, with an error row, and the run goes on. Both
folders are read and written through Spark, so they lie wherever the cluster's tables do.

Only one run may write to a folder at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULTS = "model string, task string, metric string, sub_metric string, score double, status string, error string"
MANIFEST = "model string, status string, n_rows long, error string, spec string, at timestamp"


def _folder(model: str) -> str:
    """A folder name for any model name (names may hold slashes, or differ in case only)."""
    plain = "".join(c if c.isascii() and (c.isalnum() or c in "._-") else "_" for c in model)[:60]
    return f"key={plain}-{hashlib.sha256(model.encode()).hexdigest()[:12]}"


class ResultStore:
    """The saved results of one run. ``spec`` describes what is evaluated (tasks, metrics); a
    folder that holds results of another spec is refused."""

    def __init__(self, spark: SparkSession, path: str, spec: str):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), hashlib.sha256(spec.encode()).hexdigest()
        others = self.manifest().where(F.col("spec") != self.spec).limit(1).collect()
        if others:
            raise ValueError(f"{path} holds the results of another run: {others[0]['model']} was evaluated by other tasks or metrics")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").select(*[c.split()[0] for c in schema.split(", ")])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def manifest(self) -> DataFrame:
        """One row per finished model."""
        return self._read("manifest", MANIFEST)

    def finished(self) -> dict[str, str]:
        """Status of each finished model (as many rows as models)."""
        return {r["model"]: r["status"] for r in self.manifest().select("model", "status").collect()}

    def save(self, model: str, rows: DataFrame, status: str = "ok", error: str | None = None) -> None:
        """Write the rows of a model, then its record."""
        columns = [F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in RESULTS.split(", "))]
        out = f"{self.path}/results/{_folder(model)}"
        rows.select(*columns).write.mode("overwrite").parquet(out)
        n = self.spark.read.schema(RESULTS).parquet(out).count()
        record = self.spark.createDataFrame([(model, status, n, error, self.spec)], "model string, status string, n_rows long, error string, spec string")
        record.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{_folder(model)}")

    def save_error(self, model: str, error: str) -> None:
        """An error record in place of results."""
        row = self.spark.createDataFrame([(model, "error", error)], "model string, status string, error string")
        self.save(model, row, "error", error)

    def results(self) -> DataFrame:
        """The rows of all finished models; rows of a model without a record do not count."""
        done = self.manifest().select(F.col("model").alias("_done"))
        return self._read("results", RESULTS).join(done, F.col("model") == F.col("_done"), "left_semi")


def run_models(spark: SparkSession, models: Sequence[str], evaluate: Callable[[str], DataFrame], path: str, spec: str, retry_errors: bool = False) -> DataFrame:
    """Evaluate the models one after the other, save each, skip those that are finished.

    ``evaluate(model)`` returns the model's result rows (its own ``model`` column), for instance
    from ``recipes.run_tasks``. A model that raises gets an error row and is not tried again unless
    ``retry_errors``; whatever else ends the program leaves the models so far, and the next call
    goes on from there. Returns the results of all finished models of ``path``."""
    store = ResultStore(spark, path, spec)
    finished = store.finished()
    for model in models:
        if finished.get(model) == "ok" or (model in finished and not retry_errors):
            continue
        try:
            rows = evaluate(model)
            store.save(model, rows)
        except Exception as e:  # noqa: BLE001 - a failing model must not stop the others
            store.save_error(model, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}".rstrip(": "))
    return store.results()
