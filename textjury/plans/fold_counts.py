"""Document frequencies by fold that grow with the labelled table instead of being counted anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.operators.folds import assign_folds, check_fold_count
from textjury.operators.term_weights import buckets, idf_of_training_sets, split_messages
from textjury.operators.vectors import ALL_MESSAGES
from textjury.plans.storage import append_record, read_records

SETTINGS = "num_buckets INT, k INT, salt STRING"


class FoldCounts:
    """(bucket, fold) counts under ``path``, one folder per added batch of messages.

    A message's fold is a function of its id, so an added batch changes no row of an earlier
    one: adding reads the batch alone, and the sums over all folders are those of the whole
    table. A batch is named; adding it again replaces its counts, so a repeated job counts
    nothing twice. At most k * (num_buckets + 1) rows per folder.
    """

    def __init__(self, spark: SparkSession, path: str, num_buckets: int, k: int = 5, salt: str = ""):
        check_fold_count(k)
        self.spark, self.path, self.num_buckets, self.k, self.salt = spark, path.rstrip("/"), num_buckets, k, salt
        settings = {"num_buckets": num_buckets, "k": k, "salt": salt}
        known = read_records(spark, f"{self.path}/settings", SETTINGS)
        row = None if known is None else known.first()
        if row is None:
            append_record(spark, f"{self.path}/settings", settings, SETTINGS)
        elif row.asDict() != settings:
            raise ValueError(f"{path} holds counts for {row.asDict()}, not for {settings}")

    def add(self, messages: DataFrame, batch: str, key: str = "doc_id", words: str = "words") -> None:
        """Count a batch of (key, words) messages."""
        held = F.concat(F.array(F.lit(ALL_MESSAGES)), F.array_distinct(buckets(F.col(words), self.num_buckets)))
        rows = assign_folds(messages, self.k, self.salt, key).where(F.col(words).isNotNull())
        counts = rows.select("fold", F.explode(held).alias("bucket")).groupBy("bucket", "fold").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch}")

    def totals(self) -> DataFrame:
        """(bucket, n, marker): messages per fold as an array, of all batches."""
        counts = self.spark.read.parquet(f"{self.path}/counts")
        of_fold = lambda i: F.sum(F.when(F.col("fold") == i, F.col("n")).otherwise(0))
        return counts.groupBy("bucket").agg(
            F.array(*[of_fold(i) for i in range(self.k)]).alias("n"), F.max("bucket").alias("marker")
        )

    def idf_leave_one_out(self) -> DataFrame:
        """(held_out, bucket, df, idf), as counted from the whole table."""
        return idf_of_training_sets(*split_messages(self.totals()))

    def compact(self, batch: str = "all") -> None:
        """Put the counts of all batches into one folder, written beside them before they go."""
        counts = self.spark.read.parquet(f"{self.path}/counts")
        summed = counts.groupBy("bucket", "fold").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{self.path}/compacted")
        again = self.spark.read.parquet(f"{self.path}/compacted")
        again.withColumn("batch", F.lit(batch)).write.mode("overwrite").partitionBy("batch").parquet(f"{self.path}/counts")
