"""License scan, sharding, line templates, quality rules and language ID against plain Python."""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from storefront_etl.llm import language_id as L
from storefront_etl.llm import license_scan as N
from storefront_etl.llm import line_templates as T
from storefront_etl.llm import quality as Q
from storefront_etl.llm import sharding as H
from tests.llm.data import empty_frame, frame, odd_frame, odd_texts, prose, rows, vocabulary

WORD = r"[^\x20\x09-\x0D]+"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- license scan ---------------------------------------------------------
def license_texts():
    rng, words = random.Random(4), vocabulary()
    out = [*odd_texts(), "GNU General\nPublic---License! cc by, CC-BY 4.0; cc bye", "submit license permit licenses", "mit license mit license"]
    for text, _, errors in N.NOTICES:
        for k in range(errors + 2):
            chars = list(text)
            for _ in range(k):
                at = rng.randrange(len(chars))
                kind = rng.choice("ids")
                chars[at : at + (kind != "i")] = [] if kind == "d" else [rng.choice("xyzé")]
            out.append(prose(rng, words, 20) + " " + "".join(chars).upper() + " " + prose(rng, words, 5))
    return out


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    at = []
    for phrase, label in N.BASE_PHRASES:
        p = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


@functools.cache
def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def notice_places(text):
    """(first word, number of words, label, edits): words that a notice's words become by few edits each, in plain Python."""
    words, found = N.normalised(text).decode().split(" "), set()
    for phrase, label, errors in N.NOTICES:
        wanted = phrase.split()
        for k in range(len(words) - len(wanted) + 1):
            total = 0
            for w, x in zip(wanted, words[k : k + len(wanted)], strict=True):
                most = len(w) // N.LETTERS_AN_EDIT
                edits = 0 if w == x else distance(w, x) if abs(len(w) - len(x)) <= most else 99
                total += edits if edits <= most else 99
                if total > errors:
                    break
            if total <= errors:
                found.add((k, len(wanted), label, total))
    return found


def brute_labels(text):
    found = set(filter(None, brute_base(text)[4].split(",")))
    return ",".join(sorted(found | {label for _, _, label, _ in notice_places(text)}))


def test_license_scan(spark):
    texts = license_texts()
    got = {r["doc_id"]: r for r in N.scan_licenses(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        r = got[k]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert r["labels"] == brute_labels(text)
        assert 0 <= r["score"] <= 1 and (r["score"] == 1) == (r["n_base"] > 0 or any(s["edits"] == 0 for s in r["spans"]))
        spans = {(s["first_word"], s["n_words"], s["label"], s["edits"]) for s in r["spans"]}
        assert {s[:3] for s in spans} == {s[:3] for s in notice_places(text)}
    assert any(r["labels"] != r["base_labels"] for r in got.values())
    assert N.scan_licenses(empty_frame(spark)).count() == 0


def test_misspelled_notices_are_found_with_spans(spark):
    rng, words = random.Random(12), vocabulary()
    texts = {
        "Licenced under the Apach License, Version 2.0": "apache", "Permision is hereby granted, free of charge, to any persn obtaining a copy": "mit",
        "GNU Genral Publik License": "gpl", "the Mozila Public Licence": "mpl", "redistribution & use in source": "", "MIT Licence": "mit",
        "Redistributon and use in source and binary forms, with or withot modification, are permited": "bsd",
    }
    docs = [f"{prose(rng, words, 15)} {t} {prose(rng, words, 15)}" for t in texts]
    for r, want in zip(sorted(N.scan_licenses(frame(spark, docs)).collect(), key=lambda r: r["doc_id"]), texts.values(), strict=True):
        assert r["labels"] == want and r["n_base"] == 0
        assert not want or (0 < r["score"] < 1 and {s["first_word"] for s in r["spans"]} <= {15, 16, 18})


def test_ordinary_prose_has_no_license(spark):
    texts = [
        "a bad license", "the bid license", "see it license plates", "the kit license", "all nights reserved", "all rights reserved", "a piche license",
        "the driving license was public", "general public transport", "patches license", "my license", "an mt license", "creative communes", "mit licensed cars license",
    ]
    assert {r["labels"] for r in N.scan_licenses(frame(spark, texts[:-1])).collect()} == {""}


# --- sharding -------------------------------------------------------------
def positions(found):
    per = Counter(r["shard"] for r in found)
    for shard, n in per.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    assert max(per.values()) - min(per.get(k, 0) for k in range(H.SHARDS)) <= 1
    return sorted((r["slot"] * H.SHARDS + r["shard"], r["doc_id"], r["text_crc32"]) for r in found)


@pytest.mark.parametrize("bucket_bytes", [1 << 23, 20_000, 600])
def test_shards(spark, bucket_bytes):
    """Whole records, gapless slots, the same order whatever the input's partitions; small buckets, and one overfilled."""
    df = odd_frame(spark)
    shuffled = H.external_shuffle(df, bucket_bytes=bucket_bytes)
    found = [r.asDict() for r in shuffled.collect()]
    assert len(found) == df.count()
    want = Counter((r["doc_id"], r["text"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    assert Counter((r["doc_id"], r["text"], r["size"], r["text_crc32"]) for r in found) == want
    order = positions(found)
    if bucket_bytes == 1 << 23:
        key = lambda x: str((x[0], x[2])) if x[1] is None else str(x)
        again = positions([r.asDict() for r in H.external_shuffle(df.repartition(5), bucket_bytes=bucket_bytes).collect()])
        assert sorted(map(key, order)) == sorted(map(key, again))
        assert [d for _, d, _ in order if d is not None] != sorted(d for _, d, _ in order if d is not None)


@pytest.mark.parametrize("bucket_bytes", [1 << 23, 2000])
def test_shards_keep_all_columns(spark, bucket_bytes):
    """Extra columns come through, also on shuffled input with overfilled buckets of equal rows."""
    df = odd_frame(spark).withColumns({c: F.lit(f"my {c}") for c in ("bucket", "piece", "pieces", "BEFORE")})
    df = df.unionByName(df.where("doc_id = 9").crossJoin(spark.range(60).select(F.col("id").alias("again"))).drop("again")).repartition(5)
    out = H.external_shuffle(df, bucket_bytes=bucket_bytes)
    extra = [c for c in df.columns if c not in H.ADDED]
    assert out.columns == [*extra, "size", "text_crc32", "shard", "slot"]
    names = [f"`{c}`" for c in extra]
    got, want = out.select(*names).collect(), df.select(*names).collect()
    assert Counter(map(str, got)) == Counter(map(str, want))
    positions([r.asDict() for r in out.select("doc_id", "text", "size", "text_crc32", "shard", "slot").collect()])


def test_fisher_yates_is_uniform():
    rng = np.random.Generator(np.random.PCG64(1))
    orders = Counter(tuple(H.fisher_yates(3, rng)) for _ in range(6000))
    assert len(orders) == 6 and max(orders.values()) < 1150 and min(orders.values()) > 850
    assert H.fisher_yates(0, rng) == [] and H.fisher_yates(1, rng) == [0]


def test_shard_files(spark, tmp_path):
    df = odd_frame(spark)
    H.write_shards(H.external_shuffle(df), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((r["doc_id"], r["text"]) for r in df.collect())
    assert H.external_shuffle(empty_frame(spark)).count() == 0


# --- line templates -------------------------------------------------------
def test_line_templates(spark):
    rng, words = random.Random(8), vocabulary(n=800)
    texts = []
    for k in range(40):
        lines = [prose(rng, words, rng.randint(4, 30)) for _ in range(4)]
        if k % 2:
            lines.insert(1, f"Posted by user{k} on day {k % 7}")  # masked digits
        if k % 3 == 0:
            lines.append(f"Share this page with {rng.choice(words)} and all friends")  # one variable word
        lines.append("Read more")  # short lines recur like others
        texts.append("\n".join(lines))
    texts += ["a line that only copies share\nand more"] * 30  # one text, however often
    got = {r["doc_id"]: r for r in T.drop_recurring_lines(frame(spark, texts), counts=True).collect()}
    for k, text in enumerate(texts):
        want = [x for x in text.split("\n") if not re.match("Posted by|Share this page|Read more", x)]
        assert got[k]["text"] == "\n".join(want)
        assert (got[k]["n_lines"], got[k]["n_dropped"]) == (text.count("\n") + 1, text.count("\n") + 1 - len(want))


def test_line_templates_odd_rows(spark):
    df = odd_frame(spark)
    out = T.drop_recurring_lines(df)
    assert out.columns == df.columns and out.count() == df.count()
    assert sum(r["text"] is None for r in out.collect()) == 2
    assert T.drop_recurring_lines(empty_frame(spark)).count() == 0


# --- quality rules --------------------------------------------------------
def brute_statistics(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]


def test_statistics():
    rng, words = random.Random(6), vocabulary(n=30)
    texts = [*odd_texts(), *[prose(rng, words[: rng.randint(1, 30)], rng.randint(1, 120)).replace(" ", "\n", 5) for _ in range(60)]]
    assert Q.statistics(pa.array(texts)).tolist() == [brute_statistics(t) for t in texts]
    assert Q.statistics(pa.array(texts)[5:20]).tolist() == [brute_statistics(t) for t in texts[5:20]]


def test_forest_scores_match_a_walk():
    """Vectorised scores against a walk through the trees, row by row."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (300, 3)), rng.normal(6, 1, (12, 3))])
    forest = Q.grow_forest(x)

    def walk(row):
        depth = 0.0
        for at in forest.roots:
            while forest.feature[at] >= 0:
                at = forest.child[at] + (row[forest.feature[at]] >= forest.split[at])
            depth += forest.path[at]
        return 2 ** (-depth / len(forest.roots) / forest.norm)

    scores = forest.scores(x)
    assert np.allclose(scores[:40], [walk(r) for r in x[:40]])
    assert scores[300:].min() > np.median(scores[:300])
    good = np.arange(312) < 300
    threshold = Q.calibrated(scores, good)
    assert (scores[300:] >= threshold).mean() > 0.5
    assert (scores[:300] >= threshold).mean() <= Q.GOOD_LOST
    assert Q.calibrated(scores, np.ones(312, dtype=bool)) == float("inf")


def test_quality_rules(spark):
    rng, words = random.Random(9), vocabulary(n=500)
    texts = [prose(rng, words, 60) for _ in range(120)] + [prose(rng, words, 40).replace(" ", " ### $$$ ") for _ in range(20)] + odd_texts()
    docs = frame(spark, texts)
    labels = spark.createDataFrame(
        [(k, int(k < 120), 0) for k in range(138)] + [(None, 1, 0), (3, None, 0), (99999, 0, 0)], "doc_id long, quality int, toxic int"
    )
    forest = Q.fit(docs, labels)
    got = {r["doc_id"]: r for r in Q.quality_rules(docs, forest).collect()}
    for k, text in enumerate(texts):
        want = brute_statistics(text)
        assert [got[k][c] for c in Q.STATISTICS] == want
        assert got[k]["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (got[k]["kept"] and got[k]["base_failed"])
    assert all(got[k]["kept"] for k in range(120))
    assert not any(got[k]["kept"] for k in range(120, 140))  # two of them unlabelled
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k in range(len(texts)) if got[k]["kept"]]


def test_quality_rejects_word_stutter(spark):
    """Words that repeat the one before, within every other limit and without a repeated 8-word window."""
    rng, words = random.Random(4), vocabulary(n=900)
    bad = [" ".join(" ".join([w] * rng.choice([2, 3, 4])) for w in rng.sample(words, 40)) for _ in range(12)]
    docs = frame(spark, [prose(rng, words, rng.randint(40, 120)) for _ in range(200)] + bad)
    labels = spark.createDataFrame([(k, int(k < 200), 0) for k in range(206)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.quality_rules(docs, Q.fit(docs, labels)).collect()}
    assert not any(got[k]["base_failed"] for k in range(212))
    # The last six are not in the labelled sample.
    assert [k for k in range(212) if not got[k]["kept"]] == list(range(200, 212))
    assert Q.stutter(pa.array(["a a b", "b", "", None, "b b"])).tolist() == [0.5, 0, 0, 0, 1]


def test_the_forest_decides_not_the_limits():
    """Good rows outside of the learned space in one thing stay; rows far outside, or in several things, go."""
    rng = np.random.default_rng(5)
    good = rng.normal(size=(4000, len(Q.FEATURES)))
    bad = rng.normal(size=(400, len(Q.FEATURES)))
    bad[np.arange(400), rng.integers(0, 8, 400)] += rng.choice([-1, 1], 400) * rng.uniform(8, 60, 400)
    x, label = np.vstack([good, bad]), np.arange(4400) < 4000
    mixed = rng.permutation(4400)
    forest = Q.learned(x[mixed], label[mixed], np.ones(4400, dtype=bool))
    fresh = rng.normal(size=(3000, len(Q.FEATURES)))
    out = (Q.outside(fresh, forest.low, forest.high) > 0).any(axis=1)
    rejected = forest.judge(fresh) >= forest.threshold
    assert out.sum() > 20 and (out & ~rejected).sum() > 0.5 * out.sum()
    assert rejected.mean() < 0.01
    assert (forest.judge(x[~label]) >= forest.threshold).mean() > 0.9


def test_every_labelled_document_teaches(spark):
    """Quantiles, leaf counts and threshold against one in-memory fit of all labelled rows, repeats included."""
    rng, words = random.Random(8), vocabulary(n=300)
    texts = [prose(rng, words, rng.randint(15, 90)) for _ in range(400)]
    texts += [" ".join(f"{w} #$ {w}" for w in prose(rng, words, 30).split()[: rng.randint(5, 30)]) for _ in range(60)]
    docs = frame(spark, texts)
    docs = docs.unionByName(docs.where("doc_id < 9"))
    labels = spark.createDataFrame([(k, int(k < 405), 0) for k in range(450)] + [(5, 0, 0)], "doc_id long, quality int, toxic int")
    forest = Q.fit(docs, labels)
    taken = docs.where("doc_id < 450").select("doc_id", "text", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("teach")).collect()
    column = pa.array([r["text"] for r in taken])
    stats = Q.statistics(column)
    good = np.array([r["doc_id"] < 405 and r["doc_id"] != 5 for r in taken])
    want = Q.learned(Q.features(column, stats), good, ~Q.base_failed(stats), np.array([r["teach"] for r in taken]))
    assert np.allclose(forest.low, want.low) and np.allclose(forest.high, want.high)
    assert (forest.feature == want.feature).all() and np.allclose(forest.path, want.path)
    assert np.isfinite(want.threshold) and np.isclose(forest.threshold, want.threshold)
    # Every good row that teaches is counted in every tree.
    roots = Q.grow_forest(np.zeros((7, 8)), least=1.0)
    assert np.isclose(roots.norm, Q.expected_path(7))
    assert not hasattr(Q, "SAMPLE")


def test_quality_features_are_the_statistics():
    texts = ["One two two THREE", "a\na\n#b", "", None]
    got = Q.features(pa.array(texts), Q.statistics(pa.array(texts)))
    want = [
        [np.log1p(4), 14 / 4, 0, 0, 0, 1 / 3, np.log1p(4 - 1) / np.log1p(4), 6 / 17],
        [np.log1p(3), 4 / 3, 1 / 3, 1 / 3, 0, 1 / 2, np.log1p(2) / np.log1p(3), 0],
        [0.0] * 8, [0.0] * 8,
    ]
    assert np.allclose(got, want)


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = odd_frame(spark)
    assert Q.fit(docs, labels) is None
    got = Q.quality_rules(docs, None).collect()
    assert len(got) == docs.count() and all(r["kept"] == (not r["base_failed"]) for r in got)
    assert Q.keep_good(empty_frame(spark), labels).count() == 0


# --- language ID ----------------------------------------------------------
def brute_grams(text):
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        padded = f" {word} "
        found.update(word)
        found.update(padded[i : i + 2] for i in range(len(padded) - 1))
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return found


def code(gram):
    value = 0
    for c in gram:
        value = value << L.CODE_BITS | ord(c)
    return value


def test_grams():
    for text in ["The cat,the HAT", "é1é ab_cd 漢字 ß", " x ", "日本 a", "..", "a\U00010400b c"]:
        grams, counts = L.gram_counts(text)
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == {code(g): n for g, n in brute_grams(text).items()}


def test_out_of_place_distance():
    ranked = {"aa": [code(g) for g in ("a", "b", "ab", " a")], "bb": [code(g) for g in ("b", "a", "ba")]}
    profiles = L.Profiles(ranked, 10)
    for text in ("ab ab a", "ba b ba", "zz"):
        counts = {code(g): n for g, n in brute_grams(text).items()}
        mine = sorted(counts, key=lambda g: (-counts[g], g))[:10]
        distance = {
            name: sum(abs(k - r.index(g)) if g in r else 10 for k, g in enumerate(mine)) for name, r in ranked.items()
        }
        best = min(distance, key=lambda name: (distance[name], name))
        assert profiles.nearest(text) == (best, pytest.approx(1 - distance[best] / (10 * len(mine))))
    assert profiles.nearest(None) == profiles.nearest("12 .") == ("und", 0.0)


def test_language_of_held_out_rows(spark):
    from storefront_etl.llm.common import table

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in L.op10_language_id(spark, sf).collect()}
    docs = {r["doc_id"]: r for r in table(spark, sf, "documents").collect()}
    assert set(got) == set(docs)
    held = [d for d, r in got.items() if r["held_out"]]
    assert sorted(held) == sorted(d for d in docs if zlib.crc32(str(d).encode()) % 4 == 2)
    asked = [d for d in held if docs[d]["lang"] and docs[d]["text"] and got[d]["lang_pred"] != "und"]
    assert sum(got[d]["lang_pred"] == docs[d]["lang"] for d in asked) >= 0.95 * len(asked)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd_rows(spark):
    profiles = L.language_profiles(spark.createDataFrame(rows(["der die das", "the this that"], langs=["de", "en"]), odd_frame(spark).schema))
    got = L.identify_language(odd_frame(spark), profiles).collect()
    texts = odd_texts()
    assert len(got) == len(texts)
    assert sum(r["lang_pred"] == "und" for r in got) == sum(not any(c.isalpha() for c in t or "") for t in texts)
    nothing = L.language_profiles(empty_frame(spark))
    assert {r["lang_pred"] for r in L.identify_language(odd_frame(spark), nothing).collect()} == {"und"}
    assert L.identify_language(empty_frame(spark), profiles).count() == 0
