"""Work that must not grow: what the driver plans for a value, and what is swept where no packet has scans."""

import pytest
from pyspark.sql import functions as F

from conftest import got
from packetry.operators import fuzzy, packet


def letters(df) -> int:
    """How often the plan takes the letters out of a value: canon() is its only regexp_replace."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(")


@pytest.mark.parametrize("op", [
    lambda c: fuzzy.damaged(c), lambda c: fuzzy.vocabulary_correct(c, [f"ENTRY_{i:03d}" for i in range(60)]), lambda c: fuzzy.correct_flag_tokens(c, [f"flag_{i:03d}" for i in range(20)]),
    lambda c: fuzzy.correct_field(c, [f"ENTRY_{i:03d}" for i in range(60)], guarded=[f"ENTRY_{i:03d}" for i in range(8)]),
])
def test_letters_are_taken_once(spark, op):
    df = spark.createDataFrame([("x",)], "v string").select(op(F.col("v")).alias("out"))
    assert letters(df) <= 3


@pytest.mark.parametrize("current,exact,cands,want", [
    ("Pele Virfoash", False, ["Pele Virfoash", "Otto Maxim", "Otto Maxim"], ("Otto Maxim", "corroboration")),
    ("Otto Maxin", True, ["Otto Maxin", "Otto Maxim", "Otto Maxim"], ("Otto Maxin", None)),
    ("Otto Mbxim", False, ["Otto Mbxim", "Otto Maxin", "Ofto Maxim"], ("Otto Maxim", "char_majority")),
    ("Otto Maxim", False, [None, "", "[torn]"], ("Otto Maxim", None)), ("", False, ["a", "a"], ("", None)),
])
def test_corroborate(spark, current, exact, cands, want):
    df = spark.createDataFrame([(current, exact, cands)], "c string, x boolean, l array<string>")
    assert tuple(df.select(packet.corroborate(F.col("c"), F.col("x"), F.col("l")).alias("r")).first().r) == want


def test_nearest_entry_of_quoted_words(spark):
    df = spark.createDataFrame([("o'haras",), ("ohara",), ("back\\slash",), ("zzzzzz",), ("",), (None,)], "v string")
    out = got(df.select("v", fuzzy.correct_field(F.col("v"), ["O'Hara", "back\\slash", "Velm-12c"]).alias("w")), "v", "w")
    assert sorted(out, key=repr) == sorted([("o'haras", "O'Hara"), ("ohara", "O'Hara"), ("back\\slash", "back\\slash"), ("zzzzzz", "zzzzzz"), ("", ""), (None, None)], key=repr)
