"""Text-file sources: ``label <tab> text`` lines and plain messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAB = "\t"
NO_TAB = "no tab between label and text"
BAD_LABEL = "label is not a number"
OTHER_LABEL = "label is not 0 or 1"


def _number(label: Column) -> Column:
    # A Java number may end in d or f ("1d"); such a label is not a number here.
    suffixed = label.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~suffixed, label.try_cast("double"))


def _split(df: DataFrame, line: str) -> DataFrame:
    value = F.col(line)
    tab = F.instr(value, TAB)
    label = F.when(tab > 0, _number(F.substring_index(value, TAB, 1)))
    # only the first tab separates; later ones belong to the text
    text = F.when(tab > 0, F.substr(value, tab + 1))
    problem = F.when(tab == 0, NO_TAB).when(label.isNull(), BAD_LABEL)
    kept = [c for c in df.columns if c != line]
    return df.select(*kept, line, label.alias("label"), text.alias("text"), problem.alias("problem"))


def parse_labelled(df: DataFrame, line: str = "value") -> DataFrame:
    """(label DOUBLE, text STRING) of each line; a bad line fails the job.

    The check is a filter, so it also runs when the label is not selected.
    """
    message = F.concat(F.col("problem"), F.lit(": "), F.col(line))
    good = F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return _split(df, line).where(good).drop(line, "problem")


def checked_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """(..., line, label, text, problem) in one frame; ``problem`` is null for a line to train on.

    Unlike :func:`parse_labelled` this lets no label but 0 and 1 pass.
    """
    rows = _split(df, line)
    other = F.col("problem").isNull() & ~F.col("label").isin(0.0, 1.0)
    return rows.withColumn("problem", F.when(other, OTHER_LABEL).otherwise(F.col("problem")))


def parse_or_quarantine(df: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the rejected lines with the reason. Two frames over one input: each reads it."""
    rows = checked_lines(df, line)
    parsed = rows.where("problem is null").drop(line, "problem")
    rejected = rows.where("problem is not null").drop("label", "text")
    return parsed, rejected


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Labelled lines of a text file, keyed by the hash of the line.

    Identical lines share ``doc_id`` and with it the fold.
    """
    lines = spark.read.text(path).withColumn("doc_id", F.md5("value"))
    return parse_labelled(lines).select("doc_id", "label", "text")


def read_messages(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """One message per line, without its line end; ``first`` keeps that many lines.

    The first lines are those of the files in the order of their paths, each from its start.
    """
    lines = spark.read.text(path)
    if first is None:
        return lines.select(F.col("value").alias("text"))
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return (
        lines.select(F.col("value").alias("text"), place.alias("place"))
        .orderBy("place")
        .limit(first)
        .select("text")
    )
