"""Awkward documents, and plain versions of the operators to compare with."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like those that operators make for themselves.
CLASHING = "a long, b long, n long, id long, key string, hash long, row long, words string, drops string, toxicity string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def awkward(spark, texts=()):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, extra columns."""
    long_text = " ".join(f"word{i % 997} of line\n" if i % 50 == 0 else f"w{i * 7919 % 10007}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, long_text), (6, long_text), (7, "ÄÖ ß 日本語 😀."),
        (None, "a row without an id but with some words in it"), (None, None), (8, "\x00\x01 �"),
        *((100 + i, t) for i, t in enumerate(texts)),
    ]
    full = [(d, t, None if d == 7 else "en", None, None, 1, 2, 3, 4, "k", 5, 6, "w", "d", "t") for d, t in rows]
    return spark.createDataFrame(full, f"{DOCS}, {CLASHING}")


def empty(spark):
    return spark.createDataFrame([], f"{DOCS}, {CLASHING}")


def prose(seed, n, vocabulary=400):
    """n words in sentences, drawn from a small vocabulary."""
    draw = random.Random(seed)
    words, out = [f"{chr(97 + i % 26)}{'aeiou'[i % 5]}{i}" for i in range(vocabulary)], []
    while len(out) < n:
        sentence = [draw.choice(words) for _ in range(draw.randint(3, 12))]
        sentence[0] = sentence[0].capitalize()
        sentence[-1] += "."
        out += sentence
    return " ".join(out[:n])


def rows_of(df, *columns):
    key = lambda row: [repr(v) for v in row]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
