"""The Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from storefront_etl.llm import merkle_manifest as M
from tests.llm.data import EXTRA, SCHEMA, empty_frame, frame, odd_frame


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    """All levels, from the nodes to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, k):
    """Per level (left sibling, right sibling)."""
    out = []
    for level in levels[:-1]:
        out.append(("", level[k + 1] if k + 1 < len(level) else "") if k % 2 == 0 else (level[k - 1], ""))
        k //= 2
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for doc, source, lang, n, text in rows:
        leaf = h(*map(framed, (doc, source, lang, n, text)))
        struck = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
        trees.setdefault(lang, []).append((doc, leaf, h(*map(framed, (doc, source, lang, n + 1, text))) if struck else leaf))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    levels = {lang: up([leaf for _, leaf, _ in trees[lang]]) for lang in order}
    top = up([levels[lang][-1][0] for lang in order])
    out = []
    for t, lang in enumerate(order):
        for k, (doc, leaf, changed) in enumerate(trees[lang]):
            way = siblings(levels[lang], k) + siblings(top, t)
            node = changed
            for left, right in way:
                node = h(left, node, right)
            out.append((doc, leaf, levels[lang][-1][0], top[-1][0], h(*[x for pair in way for x in pair]), node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest(df):
    return sorted((tuple(r) for r in M.dataset_manifest(df).collect()), key=str)


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_odd_rows(spark):
    df = odd_frame(spark, langs=[None if k % 6 == 0 else ("en", "", "é", "de", "Z")[k % 5] for k in range(len(odd_frame(spark).collect()))])
    assert manifest(df) == brute(plain(df))


def test_several_rounds_and_crowded_words(spark):
    """More leaves than a slot array has, sparse and negative ids, and an id that a third of the rows have."""
    rng = random.Random(3)
    ids = [rng.choice([7, None]) if k % 3 == 0 else rng.randrange(-(2**62), 2**62) if k % 3 == 1 else k for k in range(900)]
    df = frame(spark, [f"text {k}" if k % 10 else "same" for k in range(900)], ids=ids, langs=["en" if k % 8 else "fr" for k in range(900)])
    got = manifest(df)
    assert got == brute(plain(df))
    assert {r[6] for r in got} == {True, False}


def test_many_languages(spark):
    df = frame(spark, ["x"] * 300, langs=[f"l{k}" for k in range(300)])
    assert manifest(df) == brute(plain(df))


def test_null_counts_stay_and_large_ones_do_not_overflow(spark):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 0][:4]
    rows = [(k, "t", "en", "s", n, *EXTRA) for k, n in zip(ids, [None, 2**63 - 1, -1, 0], strict=True)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = manifest(df)
    assert got == brute(plain(df))
    assert [r[6] for r in sorted(got)] == [True, False, False, False]


def test_empty_and_wrong_ids(spark):
    empty = M.dataset_manifest(empty_frame(spark))
    assert empty.collect() == [] and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    with pytest.raises(ValueError, match="whole number"):
        M.dataset_manifest(empty_frame(spark).selectExpr("string(doc_id) AS doc_id", "source", "lang", "n_chars", "text"))
