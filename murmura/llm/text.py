"""Column expressions shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text, or an empty one where it is missing."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, without building them."""
    marks = F.regexp_replace(F.regexp_replace(text, WORD, "x"), SPACE, "")
    return F.length(marks).cast("long")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it if ``df`` has such a column already."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys in which a missing value equals a missing value; keeps the left keys."""
    renamed = {key: fresh_name(left, f"_right_{key}") for key in keys}
    other = right.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(renamed[key]))
    joined = left.join(other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and version (hash of the text) are not in ``bad``; all columns stay."""
    version = fresh_name(docs, "_version")
    versioned = docs.withColumn(version, F.xxhash64("text"))
    gone = bad.select("doc_id", F.col("version").alias(version)).distinct()
    return join_same(versioned, gone, ["doc_id", version], "left_anti").drop(version)
