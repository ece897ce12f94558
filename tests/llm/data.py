"""Small documents for the operator tests: odd rows, clashing extra columns, near copies."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Extra columns with names that operators use inside.
    "row long, node string, size string, tie string, bits string, part string, place long, copies string, `a.b` string, words array<string>"
)
EXTRA = (7, "x", "s", "t", "b", "p", 3, "c", "dot", ["w"])


def rows(texts, ids=None, sources=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    out = []
    for k, text in enumerate(texts):
        source = sources[k] if sources else f"s{k % 3}"
        lang = langs[k] if langs else "en"
        out.append((ids[k], text, lang, source, None if text is None else len(text), *EXTRA))
    return out


def frame(spark, texts, **options):
    return spark.createDataFrame(rows(texts, **options), SCHEMA)


def vocabulary(seed=1, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvwxyzé") for _ in range(rng.randint(1, 8))) for _ in range(n)]


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def odd_texts(seed=5):
    """Nulls, empty and blank texts, repeats, ties, one very long text, odd characters."""
    rng, words = random.Random(seed), vocabulary()
    base = [prose(rng, words, rng.randint(30, 90)) for _ in range(12)]
    edited = [b.replace(" ", " X ", 1) for b in base[:4]]
    long = prose(rng, words, 60_000)
    return [
        None, "", " \t\n\r\x0b\x0c ", "one", "one", "Two words", "two WORDS", "a b c d e", "a b c d e", *base, *edited, base[0], base[0], base[0].upper(),
        long, long, None, "", " nbsp em Ünïcödé \U0001F600 \x1c sep", "### $$$ %%% &&& " * 10, "line one here again\n" * 30, "x" * 3000,
    ]


def odd_frame(spark, **options):
    texts = odd_texts()
    ids = list(range(len(texts)))
    ids[5] = None  # a null id
    ids[8] = 7  # a row that repeats as a whole
    return frame(spark, texts, ids=ids, sources=[None if k % 5 == 0 else f"s{k % 3}" for k in range(len(texts))], **options)


def empty_frame(spark):
    return spark.createDataFrame([], SCHEMA)
