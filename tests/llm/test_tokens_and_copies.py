"""Byte-level BPE against tiktoken, exact dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import regex
import tiktoken

from storefront_etl.llm import byte_bpe as B
from storefront_etl.llm import exact_dedup as X
from tests.llm.data import empty_frame, frame, odd_frame, odd_texts, prose, vocabulary

PATH, PATTERN = B.public_vocabulary()


@pytest.fixture(scope="module")
def tokens():
    return B.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})


def test_encoder(tokens, reference):
    rng = random.Random(1)
    alphabet = [chr(c) for c in [*range(0, 0x600), 0x2028, 0x3000, 0x4E2D, 0xAC00, 0x1F600, 0x10400]]
    texts = [t or "" for t in odd_texts()]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    texts += ["".join(rng.choice("abcdeé") for _ in range(n)) for n in (B.LONG_PIECE - 1, B.LONG_PIECE, B.LONG_PIECE + 1, 3000)]
    texts += ["<|endoftext|>", " " * 400, "\n" * 300, "don't we'll I'm", "a" * 20_000]
    encoder = B.Encoder(tokens)
    for text, (ids, decimal) in zip(texts, encoder.encode(texts, regex.compile(PATTERN)), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert decimal.decode() == ",".join(map(str, ids.tolist()))
        assert encoder.decode(ids) == text.encode()


def test_forgetting_known_matches(tokens, reference, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 3)
    encoder = B.Encoder(tokens)
    for text in ("one two three four", "two three five", "one six"):
        assert next(iter(encoder.encode([text], regex.compile(PATTERN))))[0].tolist() == reference.encode_ordinary(text)


def test_documents_round_trip(spark, reference):
    df = odd_frame(spark)
    encoded = B.encode_documents(df, PATH, PATTERN)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) for r in encoded.collect())
    want = []
    for r in df.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest(), ids))
    assert got == sorted(want)
    back = Counter((r["doc_id"], r["text"]) for r in B.decode_ids(encoded, PATH).collect())
    assert back == Counter((r["doc_id"], r["text"] or "") for r in df.collect())
    assert B.encode_documents(empty_frame(spark), PATH, PATTERN).count() == 0


# --- exact dedup ----------------------------------------------------------
def test_trie():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(500)]
    trie, want = X.Trie(True), defaultdict(list)
    for k, t in enumerate(texts):
        trie.insert(t, k, 1, t.decode())
        want[t].append(k)
    found = {whole: (n.owner, n.rows, n.digest) for whole, n in X.Trie.texts(trie.root, b"")}
    assert found == {t: (max(ks), len(ks), t.decode()) for t, ks in want.items()}
    left = dict(found)
    while (cut := trie.spill()) is not None:
        for whole, n in cut:
            assert left.pop(whole) == (n.owner, n.rows, n.digest)
    rest = {whole for whole, _ in X.Trie.texts(trie.root, b"")}
    assert rest == set(left) and len(rest) == 1


def brute(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[X.normalised(text)].append(doc_id)
    out = Counter()
    for content, ids in groups.items():
        owner = max((d for d in ids if d is not None), default=None)
        digest = hashlib.sha256(content).hexdigest()
        for place, d in enumerate(sorted(ids, key=lambda d: d != owner)):
            out[d, owner, len(ids), place == 0, digest] += 1
    return out


def found(df, **options):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in X.exact_groups(df, **options).collect())


@pytest.mark.parametrize("options", [{}, {"trie_bytes": 1500, "partition_bytes": 4000}])
def test_exact_groups(spark, options):
    """Also with tries so small that subtrees spill, round after round."""
    rng, words = random.Random(5), vocabulary(n=50)
    texts = [prose(rng, words, rng.randint(0, 30)) for _ in range(80)]
    texts += [rng.choice(texts).upper() for _ in range(120)] + [texts[7]] * 150 + ["É", "é", None, "", None]
    df = frame(spark, texts).repartition(6)
    assert found(df, **options) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_exact_groups_odd_rows(spark):
    df = odd_frame(spark)
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert found(df) == want
    kept = X.drop_copies(df)
    assert kept.columns == df.columns
    assert Counter(X.normalised(r["text"]) for r in kept.collect()) == Counter({X.normalised(r["text"]) for r in df.collect()})
    assert Counter((r["doc_id"]) for r in kept.collect()) == Counter(d for (d, _, _, k, _), n in want.items() for _ in range(n) if k)
    assert found(empty_frame(spark)) == Counter()


def test_smallest_owner(spark):
    got = X.exact_groups(frame(spark, ["a", "A", "b"]), largest=False).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in got} == {(0, 0, True), (1, 0, False), (2, 2, True)}
