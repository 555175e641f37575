"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "river stone lamp winter garden engine paper cloud silver market bridge forest candle harbor letter music".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) + rng.choice(["", "", "", ",", "."]) for _ in range(words))


def documents(spark: SparkSession, rows: list[tuple], partitions: int = 3) -> DataFrame:
    """``doc_id, text`` beside columns named like the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    clashing = "row key h kept keep_id block words again digest fp mark ids start length score top times place".split()
    return df.withColumns({c: F.lit(None).cast("string") for c in clashing})


EDGES = [(None, "no id at all"), (1, None), (2, ""), (3, "twice the same row"), (3, "twice the same row"), (4, "twice the same row"),
         (5, " \n\t \r\n "), (6, "ünïcödé ß 日本語 \U0001f600 and more"), (7, prose(7, 30_000)), (8, prose(7, 30_000) + " end"), (9, "x" * 5000)]
