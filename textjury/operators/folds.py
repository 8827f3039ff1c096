"""k-fold split as a column: a function of the row, not of the run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textjury.functions.hashing import md5_bucket


NO_KEY = "a row without a key has no fold"


def check_fold_count(k: int) -> None:
    if k <= 1:
        raise RuntimeError(f"fold count must be larger than 1, got {k}")


def fold_of(key: Column, k: int, salt: str = "") -> Column:
    check_fold_count(k)
    bucket = md5_bucket(F.concat(F.lit(salt), key.cast("string")), k)
    return F.when(key.isNotNull(), bucket).otherwise(F.raise_error(F.lit(NO_KEY)).cast("int"))


def assign_folds(
    df: DataFrame, k: int = 5, salt: str = "", key: str | Column = "doc_id"
) -> DataFrame:
    """Add ``fold`` in 0..k-1.

    Equal weights, disjoint and complete, the same on every run and under every
    partitioning; rows added later leave the old ones where they are. With
    ``key=F.md5("text")`` equal texts share a fold.
    """
    column = F.col(key) if isinstance(key, str) else key
    return df.withColumn("fold", fold_of(column, k, salt))


def training_rows(df: DataFrame, held_out: int) -> DataFrame:
    return df.where(F.col("fold") != held_out)


def held_out_rows(df: DataFrame, held_out: int) -> DataFrame:
    return df.where(F.col("fold") == held_out)


def all_training_rows(df: DataFrame, k: int) -> DataFrame:
    """The rows of all k training sets, marked by ``held_out``, from one scan."""
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col("fold"))
    return df.withColumn("held_out", F.explode(others))


def fold_balance(df: DataFrame) -> DataFrame:
    return df.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


def per_fold(counts: DataFrame, k: int) -> DataFrame:
    """Counts per fold with a zero row for each fold that holds nothing."""
    folds = counts.sparkSession.range(k).select(F.col("id").cast("int").alias("fold"))
    return folds.join(counts, "fold", "left").na.fill(0)


def leave_one_out_counts(df: DataFrame, k: int) -> DataFrame:
    """Rows and positive rows of the training set that leaves out each fold.

    One pass counts every fold; training set i is the total minus fold i.
    """
    own = per_fold(
        df.groupBy("fold").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col("label") == 1).cast("bigint")).alias("pos"),
        ),
        k,
    )
    all_folds = Window.partitionBy(F.lit(0))  # k rows
    return own.select(
        F.col("fold").alias("held_out"),
        (F.sum("n").over(all_folds) - F.col("n")).alias("n_train"),
        (F.sum("pos").over(all_folds) - F.col("pos")).alias("n_pos"),
    )
