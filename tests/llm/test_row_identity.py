"""Rows that share an id and differ only in where a null stands."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from harborline.llm import line_dedup, ngram_join
from harborline.llm.common import row_key

SCHEMA = "doc_id long, text string, lang string"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("key", [5, None])
def test_line_dedup_keeps_rows_apart(spark, key):
    rows = [(key, "a b c", None), (key, None, "a b c")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(line_dedup.dedup(df)) == Counter(rows)
    assert sorted(r.n_lines for r in line_dedup.decisions(df).collect()) == [0, 1]


@pytest.mark.parametrize("key", [5, None])
def test_representatives_keep_rows_apart(spark, key):
    rows = [(key, "a b c d e f g", None), (key, None, "a b c d e f g"), (key, "q r s t u v w", "x"), (key, "q r s t u v w", "x")]
    assert rows_of(ngram_join.representatives(spark.createDataFrame(rows, SCHEMA))) == Counter(set(rows))


def test_keys_count_every_null(spark):
    rows = [(1, None, "a", [None, 1]), (1, "a", None, [None, 1]), (1, "a", None, [1, None]), (None, "a", None, [1, None]), (1, None, None, None)]
    df = spark.createDataFrame(rows + rows, "i long, a string, b string, c array<int>")
    assert df.select(row_key(df).alias("k")).distinct().count() == len(rows)


def test_many_rows_without_an_id(spark):
    df = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"), F.lit("x").alias("lang"))
    assert df.select(row_key(df).alias("k")).distinct().count() == 200_000
