"""Mixing: targets, steps and emission against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from storefront_etl.llm import mixing
from tests.llm.data import empty_frame, frame, odd_frame, prose, vocabulary


def water_fill(sizes: dict, share=1.5, most=2, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if budget * weight[s] / total >= most * sizes[s]}
        if not over:
            target |= {s: budget * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
        budget -= sum(target[s] for s in over)
        open_ -= over
    return target


def checked(rows):
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    target = water_fill(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(largest[s], 0) + 1e-6
    return taken


def test_targets_and_steps(spark):
    import random

    rng, words = random.Random(3), vocabulary()
    texts = [prose(rng, words, int(rng.paretovariate(1.1) * 5)) for _ in range(300)]
    sources = [rng.choice(["hot"] * 6 + ["b", "c", "d", None, "e"]) for _ in texts]
    docs = frame(spark, texts, sources=sources)
    rows = [r.asDict() for r in mixing.mix_sizes(mixing.slim(docs)).collect()]
    assert len(rows) == 300
    checked(rows)
    again = [r.asDict() for r in mixing.mix_sizes(mixing.slim(docs.repartition(7))).collect()]
    assert {(r["doc_id"], r["copies"]) for r in rows} == {(r["doc_id"], r["copies"]) for r in again}


def test_odd_rows_and_emission(spark):
    docs = odd_frame(spark)
    sized = [r.asDict() for r in mixing.mix_sizes(mixing.slim(docs)).collect()]
    assert len(sized) == docs.count()
    checked(sized)
    texts = {(r["doc_id"], r["source"]): r["text"] for r in docs.collect()}
    for r in sized:
        text = texts[r["doc_id"], r["source"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    emitted = Counter((r["doc_id"], r["source"], r["text"]) for r in mixed.collect())
    wanted = Counter()
    for r in sized:
        wanted[r["doc_id"], r["source"], texts[r["doc_id"], r["source"]]] += r["copies"]
    assert emitted == +wanted


def test_empty_table(spark):
    assert mixing.mix_sizes(mixing.slim(empty_frame(spark))).count() == 0
    assert mixing.mix_sources(empty_frame(spark)).count() == 0
