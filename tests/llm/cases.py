"""Awkward documents that every operator over ``documents`` must handle, and plain-Python helpers."""

import random
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    syllables = ["the", "an", "er", "re", "on", "ti", "in", "ha", "of", "to", "lo", "mi", "su", "da"]
    words = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n)]
    return ". ".join(" ".join(words[i:i + 12]) for i in range(0, n, 12))


def documents() -> list[tuple]:
    rows = [(i, prose(i, 60 + 7 * i), "en", f"src{i % 4}", 0) for i in range(1, 41)]
    rows += [(100 + i, prose(5, 95), "en", "src1", 0) for i in range(15)]          # copies
    rows += [(200, None, "en", "src2", None), (201, "", None, None, 0), (202, " \n\t ", "en", None, 3),
             (203, "one", "en", "src3", 3), (204, "two words", "de", "src3", 9)]
    rows += [(205, prose(9, 30_000), "en", "src0", 0)]                              # very long
    rows += [(206, prose(11, 80), "en", "src2", 1)] * 3                             # repeated rows
    rows += [(None, prose(12, 70), "en", "src2", 1), (None, None, None, None, None)]
    rows += [(207, "Ünïcode — “quotes” 日本語 😀 Σς", "en", "é", 1)]
    return rows


def frame(spark: SparkSession, rows=None, schema: str = SCHEMA) -> DataFrame:
    return spark.createDataFrame(documents() if rows is None else rows, schema).repartition(3)


def stored(df: DataFrame, name: str, folder=None) -> str:
    """``df`` as the table ``name`` of a folder that a registered query can read."""
    folder = folder or tempfile.mkdtemp(prefix="run-")
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


def clashing(df: DataFrame, *names: str) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("kept") for n in names})


def rows(df: DataFrame) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)
