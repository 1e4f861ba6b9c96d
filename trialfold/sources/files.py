"""File sources and sinks of the tabular pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The four methods a run configuration may route to.
METHODS = ["xgboost", "random_forest", "knn", "lr"]
SPLITS = ["x_train", "x_test", "y_train", "y_test"]


def load_csvs(spark: SparkSession, paths: dict[str, str], schemas: dict[str, StructType] | None = None) -> dict[str, DataFrame]:
    """The four split files, header row, explicit schema when given
    (no inference pass over the data)."""
    out = {}
    for k, p in paths.items():
        r = spark.read.option("header", True)
        if schemas and k in schemas:
            r = r.schema(schemas[k])
        out[k] = r.csv(p)
    return out


def store_csvs(frames: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write each frame as header CSV (no index column)."""
    paths = {}
    for k, df in frames.items():
        p = f"{root}/{k}"
        df.write.mode("overwrite").option("header", True).csv(p)
        paths[k] = p
    return paths


def read_run_config(spark: SparkSession, path: str, one_a_line: bool = False) -> DataFrame:
    """JSON of per-method objects (one array a document, or an object a
    line, which splits over tasks) -> (method, key, value), and the ``run`` where
    objects have one, for the known methods; the ``method`` key itself
    dropped, unknown methods skipped."""
    return route_run_config(spark.read.option("multiLine", not one_a_line).json(path))


def route_run_config(cfg: DataFrame) -> DataFrame:
    head = [c for c in ("run", "method") if c in cfg.columns]
    kv = F.from_json(F.to_json(F.struct(*[F.col(c) for c in cfg.columns])), "map<string,string>")
    x = cfg.filter(F.col("method").isin(METHODS)).select(*head, F.explode(kv).alias("key", "value"))
    return x.filter(~F.col("key").isin(head))


def write_results(results: DataFrame, path: str) -> None:
    """One JSON object {accuracy, model_path} per model folder."""
    results.select("model", "accuracy", "model_path").write.mode("overwrite").partitionBy("model").json(path)


def export_table(table: DataFrame, path: str) -> None:
    """Header + one line per row, proper CSV quoting (Q9)."""
    table.write.mode("overwrite").option("header", True).option("quoteAll", False).csv(path)
