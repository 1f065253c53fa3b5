"""Short ways for plain numbers and texts."""

from pyspark.sql import functions as F

from proofmill.functions import scalars
from proofmill.functions.canonical import json_text


def test_plain_numbers_and_texts_follow_the_rules_of_all(spark, monkeypatch):
    """The short ways for plain spellings give what the long ones give."""
    raws = ["0", "-0", "7", "007", "7.", "7.0", "7.000", "7.5", "-3", "-3.25", ".5", "1e3", "1_000", " 4 ", "9" * 15, "9" * 16, "9" * 19, "0.1234567890123456", "x", "", "true", "NaN", None]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")

    def told():
        raw = F.col("raw")
        made = rows.select("i", scalars.score_value(raw), scalars.score_problem(raw), scalars.count_value(raw), scalars.count_problem(raw))
        return sorted(repr(tuple(r)) for r in made.collect())

    short = told()
    for name in ("_PLAIN_SCORE", "_PLAIN_COUNT"):
        monkeypatch.setattr(scalars, name, "(?!)")
    assert told() == short
    texts = spark.createDataFrame([("plain é中/",), ('a"b',), ("back\\slash",), ("line\n",), ("\x01",), ("\x7f ",), ("",), (None,)], "t string")
    assert [r.j for r in texts.select(json_text(F.col("t")).alias("j")).collect()] == [
        '"plain é中/"', '"a\\"b"', '"back\\\\slash"', '"line\\n"', '"\\u0001"', '"\x7f "', '""', "null",
    ]
