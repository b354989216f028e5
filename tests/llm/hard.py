"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, and columns with clashing names."""

from __future__ import annotations

import random
import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
CLASHES = ["_r1", "_row", "_rank", "node", "size", "key", "lines", "kept", "h1", "word", "_id", "_text", "times", "n", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHES)


def prose(seed: int, n: int) -> str:
    """n words, in lines."""
    rng = random.Random(seed)
    return re.sub(r"(( ?\S+){12}) ", r"\1\n", " ".join(f"{rng.choice(WORDS)}{rng.randrange(300)}" for _ in range(n)))


def hard_documents(spark):
    """Documents whose extra columns have the names that operators may use themselves."""
    shared = "This line is on every page of the house\n"
    texts = [
        (1, None, "en", None),
        (2, "", "en", "a"),
        (3, " \n\t\n ", None, "a"),
        (4, prose(4, 120), "en", "a"),
        (4, prose(4, 120), "en", "a"),  # repeats whole
        (5, prose(4, 120), "en", "b"),  # a copy
        (6, prose(4, 120).replace("\n", "  "), "en", "b"),  # the same words
        (None, prose(7, 80), "fr", "b"),
        (8, prose(8, 30_000), "de", "a"),
        (9, "x" * 200_000, "de", None),
        (10, "one two", "en", "c"),
        (11, "one two", "en", "c"),
        (12, 'token = "abcdef123456" <|endoftext|> é \\### &lt; 日本語\n' * 3, "ja", "c"),
        *((20 + i, shared.upper() * (i % 2) + shared + prose(20 + i, 60), "en", "a") for i in range(12)),
    ]
    rows = [(i, t, lang, s, len(t or ""), *range(len(CLASHES))) for i, t, lang, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
