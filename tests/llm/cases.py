"""Tables with the rows that are easily got wrong."""

import random

from pyspark.sql import DataFrame, SparkSession

#: Names that operators use inside.
CLASHES = "id n key at pid th side hub a b own other groups part rank length print keys node component score label found kept place carried".split()

SYLLABLES = "ba ko ri tu ne sa lo mi du fe ga po".split()


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text) with further columns of clashing names, null in every third row."""
    full = [(*r, *(None if i % 3 == 0 else f"{c}{i}" for c in CLASHES)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES))


def odd_rows() -> list[tuple]:
    """Nulls, empty, blank, short, equal and very long texts, repeated rows."""
    long = prose(20_000, 1)
    same = prose(120, 2)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "two words"), (6, same), (7, same), (7, same), (8, long), (None, same), (None, None),
        (9, long), (10, prose(300, 3)), (11, same.upper()),
    ]
