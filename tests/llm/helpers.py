"""Plain-Python counterparts and small tables for the text operators' tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def documents(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def prose(rng: random.Random, n: int, vocabulary: int = 500) -> str:
    seps = [" "] * 12 + ["\n", "  ", "\t", " \r\n"]
    return "".join(f"w{rng.randrange(vocabulary)}" + rng.choice(seps) for _ in range(n))


def near(rng: random.Random, text: str, share: float) -> str:
    w = words_of(text)
    for _ in range(int(len(w) * share)):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def by_id(rows, key="doc_id"):
    return {r[key]: r for r in rows}
