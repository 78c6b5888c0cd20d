"""Small tables with the awkward cases, shared by the operator tests."""

from __future__ import annotations

import random

WORDS = "the of and house river token stone über élan mañana straße 12 x9".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + (rnd.choice([".", ",", "", "", ""])) for _ in range(n))


#: doc_id, text, lang, source, n_chars and columns named like the operators' own ones
AWKWARD = [
    (1, "Plain words in a row, nothing more. " + prose(1, 60), "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (3, "", "en", "a"),
    (4, "same text " + prose(4, 50), "de", "b"),
    (4, "same text " + prose(4, 50), "de", "b"),
    (5, "same text " + prose(4, 50), "de", "b"),
    (None, "a row without an id " + prose(5, 30), "fr", None),
    (None, None, None, "c"),
    (6, " \n\t ", "en", "a"),
    (7, "!!! 123 ---", "en", "a"),
    (8, prose(8, 30_000), "es", "a"),
    (9, "x" * 5000, "en", "a"),
    (10, "\U0001F600 \u4E2D\u6587 e\u0301 \u0130 \u03A3\u03C3\u03C2 \x1c \x85 <|endoftext|> \0", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, fp long, spans string, score double, held_out string, text_hash long"


def awkward(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), 7, 7, "s", 0.5, "h", 7) for r in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
