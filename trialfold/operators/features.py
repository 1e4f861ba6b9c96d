"""Tabular pipeline: clean, split, weight, score.

Everything is one lazy plan over the dataset; the only driver round trip
is the bounded bucket histogram of the exact train/test split (at most
``2^16`` counts, independent of the data size).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialfold.functions.exprs import num

# Fixed values of the reference pipeline.
MARKER = "No Info"
LABEL = "diabetes"
COLUMNS = ["gender", "age", "bmi", "HbA1c_level", "blood_glucose_level", "diabetes"]
NUMERIC = ["age", "bmi", "HbA1c_level", "blood_glucose_level"]
GENDER_CODES = [("Male", 0), ("Female", 1), ("Other", 2)]
TEST_SIZE = 0.2
SEED = 42


def drop_marker_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Drop rows whose label is the marker; a NULL label is kept."""
    return df.filter(~F.col(label).eqNullSafe(F.lit(MARKER)))


def project(df: DataFrame, key: str = "id") -> DataFrame:
    """The six named columns (plus the row key)."""
    return df.select(key, *COLUMNS)


def drop_sparse(df: DataFrame, thresh: int = 4) -> DataFrame:
    """Keep rows with at least ``thresh`` non-null values of the six."""
    nn = sum(F.col(c).isNotNull().cast("int") for c in COLUMNS)
    return df.filter(nn >= thresh)


def encode_gender(df: DataFrame) -> DataFrame:
    """Male -> 0, Female -> 1, Other -> 2, anything else -> NULL; rows
    coded 2 dropped (NULL kept)."""
    code = F.lit(None).cast("int")
    for name, v in GENDER_CODES:
        code = F.when(F.col("gender") == name, F.lit(v)).otherwise(code)
    d = df.withColumn("gender", code)
    return d.filter(F.col("gender").isNull() | (F.col("gender") != 2))


def impute_marker(df: DataFrame, cols: list[str] = NUMERIC) -> DataFrame:
    """Replace the marker by the column mean (mean of the castable
    values after the earlier filters, Q7) — one aggregate for all columns,
    joined back as a one-row broadcast; NULLs stay NULL."""
    means = df.agg(*[F.avg(num(c)).alias(f"_m_{c}") for c in cols]).withColumn("_one", F.lit(1))
    # a global aggregate is exactly one row: broadcasting it is size-safe
    d = df.withColumn("_one", F.lit(1)).join(F.broadcast(means), "_one").drop("_one")
    for c in cols:
        d = d.withColumn(c, F.when(F.col(c) == MARKER, F.col(f"_m_{c}")).otherwise(num(c)))
    return d.drop(*[f"_m_{c}" for c in cols])


def clean(df: DataFrame) -> DataFrame:
    """O70–O74 in the reference's order."""
    d = drop_sparse(project(drop_marker_labels(df)))
    d = impute_marker(encode_gender(d))
    return d.withColumn(LABEL, num(LABEL).cast("int"))


def split_key(key: Column, seed: int = SEED) -> Column:
    """60-bit md5 rank key of a row (same in any engine)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 1, 15), 16, 10).cast("long")


def exact_split(df: DataFrame, key: str = "id", test_size: float = TEST_SIZE, seed: int = SEED,
                bucket_bits: int = 16) -> DataFrame:
    """Row-exact test set = the ceil(test_size * n) rows with the
    smallest md5 rank.  Exact selection without a global sort: count rows
    per rank bucket (partially aggregated, at most 2^bucket_bits rows reach
    the driver), rank only inside the one boundary bucket, and compare every
    row with the (rank, key) pair found there: no join, no shuffle.  Rows
    that repeat the last key go together.  Adds ``is_test``."""
    d = df.withColumn("_h", split_key(F.col(key), seed)).withColumn("_b", F.shiftright("_h", 60 - bucket_bits))
    counts = d.groupBy("_b").count().orderBy("_b").collect()  # bounded: <= 2^bucket_bits rows
    n = sum(r["count"] for r in counts)
    k = math.ceil(test_size * n)
    acc, cut, rest = 0, None, 0
    for r in counts:
        if acc + r["count"] >= k:
            cut, rest = r["_b"], k - acc
            break
        acc += r["count"]
    if cut is None or k == 0:  # empty input or no test rows
        return d.withColumn("is_test", F.lit(False)).drop("_h", "_b")
    # the last test row is one (rank, key) pair of the boundary bucket
    w = Window.partitionBy("_b").orderBy("_h", key)
    last = (d.filter(F.col("_b") == cut).select("_b", "_h", key).withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") == rest).first())
    upto = (F.col("_h") < last["_h"]) | ((F.col("_h") == last["_h"]) & (F.col(key) <= F.lit(last[key])))
    is_test = (F.col("_b") < cut) | ((F.col("_b") == cut) & upto)
    return d.withColumn("is_test", is_test).drop("_h", "_b")


def class_weight(train: DataFrame, compat: bool = False, label: str = LABEL) -> DataFrame:
    """#negative / #positive (compat=True gives the reference's 1.0, Q8)."""
    if compat:
        return train.agg(F.lit(1.0).alias("scale_pos_weight"))
    return train.agg((F.count_if(F.col(label) == 0) / F.count_if(F.col(label) == 1)).alias("scale_pos_weight"))


def round_and_score(pred: DataFrame, prob: str = "probability", label: str = LABEL, by: list[str] | None = None) -> DataFrame:
    """Probability rounded half-even to 0/1; accuracy = share equal."""
    p = pred.withColumn("prediction", F.bround(F.col(prob), 0).cast("int"))
    g = p.groupBy(*(by or [])).agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"),
                                   F.count("*").alias("n"))
    return g


def typed_assignments(best: DataFrame, assignments: DataFrame, specs: DataFrame) -> DataFrame:
    """The best trial's assignments typed by the spec: double ->
    float, int -> integer, others text.  Output (experiment, best_trial,
    name, value_double, value_int, value_text)."""
    a = best.select("experiment", "best_trial").join(
        assignments.select(F.col("trial").alias("best_trial"), F.explode("assignments").alias("a")), "best_trial")
    a = a.select("experiment", "best_trial", F.col("a.name").alias("name"), F.col("a.value").alias("value"))
    a = a.join(specs.select("experiment", "name", "type"), ["experiment", "name"], "left")
    return a.select("experiment", "best_trial", "name",
                    F.when(F.col("type") == "double", F.col("value").try_cast("double")).alias("value_double"),
                    F.when(F.col("type") == "int", F.col("value").try_cast("long")).alias("value_int"),
                    F.when(~F.coalesce(F.col("type"), F.lit("")).isin("double", "int"), F.col("value")).alias("value_text"))
