"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from storefront_etl.llm import spelling as S
from tests.llm.data import empty_frame, frame, odd_frame


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_vocabulary(docs):
    count = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if n >= 2 and len(w) >= 7}


def brute(docs):
    words = brute_vocabulary(docs)
    form, out = {}, {}
    for w, n in words.items():
        others = [v for v in words if abs(len(v) - len(w)) <= 1 and near(v, w)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = [len(others)]
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, n, out[w][0], None if form[w] is None else words[form[w]])
    return sorted(out.values())


def variants(df, **options):
    found = S.spelling_variants(df, **options)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in found.collect())


def planted(seed):
    """Texts with words, their misspellings and misspellings of those, in falling numbers; long and accented words."""
    rng = random.Random(seed)
    letters = "abcdeé×ÀZ"

    def edited(w):
        at = rng.randrange(len(w) + 1)
        return rng.choice([w[:at] + rng.choice(letters) + w[at:], w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :]])

    bag = []
    for _ in range(6):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        bag += [word] * 240
        for _ in range(4):
            one = edited(word)
            bag += [one] * rng.choice([2, 20, 24])
            bag += [edited(one)] * 2
    bag += ["q" * 700] * 30 + ["q" * 701] * 3 + ["ab" * 300] * 2 + ["ab" * 300 + "a"] * 25
    rng.shuffle(bag)
    cuts = [bag[k : k + 50] for k in range(0, len(bag), 50)]
    return [rng.choice([" ", "\n", "7", "_"]).join(c) for c in cuts]


@pytest.mark.parametrize("partition_words", [1, 3, 1000])
def test_planted_variants(spark, partition_words):
    texts = planted(partition_words) + [None, "", "short words only here"]
    ids = [None if k % 9 == 0 else 5 if k % 4 == 0 else k for k in range(len(texts))]
    got = variants(frame(spark, texts, ids=ids), partition_words=partition_words)
    want = brute(list(zip(ids, texts, strict=True)))
    assert got == want
    # Forms of forms occur.
    assert any(r[2] not in (r[0], r[1]) for r in want)


def test_words_with_one_beginning_and_end(spark):
    """A third of the vocabulary in one partition: it is cut down to single places."""
    rng = random.Random(2)
    words = sorted({"same" + rng.choice("abcdefgh") + rng.choice("abcdefgh") + rng.choice("abc") + "ends" for _ in range(120)})
    texts = [" ".join(words)] * 3
    got = variants(frame(spark, texts), partition_words=10)
    assert got == brute(list(enumerate(texts)))


def test_odd_and_empty(spark):
    df = odd_frame(spark)
    assert variants(df) == brute([tuple(r) for r in df.select("doc_id", "text").collect()])
    assert variants(empty_frame(spark)) == []


def test_pairs_against_all_comparisons():
    rng = random.Random(1)
    for t in range(1500):
        length = rng.randint(0, 5)
        words = sorted({"".join(rng.choice("ab" if t % 2 else "abc") for _ in range(length + rng.randint(0, 1))) for _ in range(rng.randint(1, 14))})
        places = rng.randint(0, length + 1)
        want = [
            (a, b) for a in words for b in words
            if len(a) == length and near(a, b) and (len(b) > length or a < b) and S.common_length(a, b) < places
        ]
        assert sorted(S.one_edit_pairs(words, length, places)) == sorted(want)


def test_acceptor_is_minimal():
    machine = S.Acceptor(sorted(["tapped", "topped", "tops", "taps"]))
    reachable, open_ = {0}, [0]
    while open_:
        for state in machine.out[open_.pop()].values():
            if state not in reachable:
                reachable.add(state)
                open_.append(state)
    assert len(reachable) == 7  # start, t, ta = to, p, pp, e, end
