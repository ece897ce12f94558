"""Substring dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from storefront_etl.llm import substring_dedup as S
from tests.llm.data import empty_frame, frame, odd_frame, prose, vocabulary


def brute(texts, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def checked(df, width):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = sorted(((d, *x) for (d, _), x in zip(rows, brute([t for _, t in rows], width), strict=True)), key=str)
    got = S.dedup_substrings(df, width).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=str) == want
    for r in got:
        if r["kept_text"] is not None:
            assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
    return want


@pytest.mark.parametrize("width", [35, 5])
def test_passages(spark, width):
    rng, words = random.Random(2), vocabulary(n=300)
    shared = [prose(rng, words, rng.choice([34, 35, 36, 80])) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, words, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), prose(rng, words, rng.randint(0, 20))]
        texts.append("\n".join(parts))
    texts += ["a " * 90, "b c " * 40, "once only " + shared[3]]
    want = checked(frame(spark, texts), width)
    assert any(n for _, _, n, _ in want)


def test_odd_rows(spark):
    checked(odd_frame(spark), 35)


def test_empty_table(spark):
    assert S.dedup_substrings(empty_frame(spark)).count() == 0


def test_sliding_min():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 28):
        x = rng.integers(0, 50, 200).astype(np.uint64)
        assert S.sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(len(x) - width + 1)]
