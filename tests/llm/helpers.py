"""Small fixtures and plain-Python versions shared by the tests of this folder."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string"


def docs_table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def awkward(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, extra columns with clashing names."""
    long_text = " ".join(f"word{i % 700}" for i in range(30_000))
    rows = [
        (1, "One two three four five six. Seven eight nine ten eleven!", "en", "a"),
        (1, "One two three four five six. Seven eight nine ten eleven!", "en", "a"),
        (1, "another text under the same id", "en", None),
        (2, None, "en", "a"), (3, "", None, "a"), (4, " \n\t ", "en", "a"), (5, long_text, "en", "b"),
        (None, "a row without an id", None, None), (None, None, None, None),
        (7, "ÀÉ ñandú straße İstanbul <|endoftext|> é  x", "es", "b"), (8, "x" * 50_000, "en", "b"),
    ]
    extra = [(*r, 9.5, "n", i, "s") for i, r in enumerate(rows)]
    return spark.createDataFrame(extra, SCHEMA + ", score double, kept string, part int, shingles string").repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def near_copies(seed=3, groups=15, members=240):
    """(doc_id, text) with copies and near copies of several lengths."""
    rnd = random.Random(seed)
    base = [["".join(rnd.choice("abcdefg") for _ in range(4)) for _ in range(rnd.choice([3, 5, 9, 14, 40, 90, 200]))] for _ in range(groups)]
    out = []
    for k in range(members):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            w[rnd.randrange(len(w))] = rnd.choice(["X", "y", "zz"]) + str(rnd.randrange(3))
        out.append((k, " ".join(w)))
    return out
