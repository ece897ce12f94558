"""Byte-level BPE encoding and decoding in padded matrices (operator 7).

A text is cut by the tokenizer's pattern, and each match is encoded on its
own: its bytes become byte tokens, and as long as some neighbouring pair is a
token, the pair with the smallest rank (the leftmost of equal ones) merges.

Matches that a task has not met before are sorted into buckets by length and
become rows of padded numpy matrices.  Every round merges one pair in every
row: the ranks of a row's pairs stand beside it, looked up in a hash table of
all token pairs; rows close up over the merged cell, and finished rows leave
the matrix.  Matches over ``LONG_PIECE`` bytes would take as many rounds as
they have bytes; they merge by the same order through a heap.

The vocabulary is a file of fixed size read on the driver (its path is a
parameter) and broadcast as a list of at most ``MAX_TOKENS`` byte strings;
the pair table is built from it once per Python worker.  Texts never move.

Defined results: null and empty texts have no tokens (digests of the empty
string); special-token strings are ordinary text; rows that repeat are encoded
like any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from storefront_etl.llm.common import per_batch, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_TOKENS = 1 << 20
LONG_PIECE = 256
# Distinct matches a worker remembers (some 200 bytes each), and cells of one matrix.
REMEMBERED = 1 << 18
CELLS = 1 << 18
NO_RANK = np.iinfo(np.int32).max
_EMPTY = np.uint64((1 << 64) - 1)


def read_vocabulary(path: str) -> list[bytes]:
    """Tokens by rank from a rank file (lines of base64 and rank)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    if len(ranks) > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} tokens")
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class PairTable:
    """Open-addressing hash table from a pair of tokens to the rank of the two joined."""

    def __init__(self, tokens: list[bytes], ranks: dict[bytes, int]):
        keys, values = [], []
        for rank, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.shift = np.uint64(64 - (4 * max(1, len(keys)) - 1).bit_length())
        size = 1 << int(64 - int(self.shift))
        self.mask = np.int64(size - 1)
        self.keys = np.full(size, _EMPTY, dtype=np.uint64)
        self.values = np.full(size, NO_RANK, dtype=np.int32)
        keys, values = np.array(keys, dtype=np.uint64), np.array(values, dtype=np.int32)
        at = self.slot(keys)
        while len(keys):
            # Of the keys that want one free slot, one gets it; the others step on.
            free = np.flatnonzero(self.keys[at] == _EMPTY)
            _, one = np.unique(at[free], return_index=True)
            placed = free[one]
            self.keys[at[placed]] = keys[placed]
            self.values[at[placed]] = values[placed]
            rest = np.ones(len(keys), dtype=bool)
            rest[placed] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, ``NO_RANK`` where it is no token (a negative side is padding)."""
        out = np.full(left.shape, NO_RANK, dtype=np.int32)
        real = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[real].astype(np.uint64) << np.uint64(32) | right[real].astype(np.uint64)
        at = self.slot(keys)
        while len(real):
            found = self.keys[at]
            hit = found == keys
            out[real[hit]] = self.values[at[hit]]
            on = ~hit & (found != _EMPTY)
            real, keys, at = real[on], keys[on], (at[on] + 1) & self.mask
        return out


class Encoder:
    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {token: rank for rank, token in enumerate(tokens) if token}
        self.pairs = PairTable(tokens, self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        # By match: its ids as bytes, and as decimals joined by commas.
        self.ids_of: dict[str, bytes] = {}
        self.decimals_of: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None or not piece:
                out[i] = np.array([] if rank is None else [rank], dtype=np.int32)
            elif len(piece) > LONG_PIECE:
                out[i] = self.merge_long(piece)
            else:
                buckets.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for width, members in buckets.items():
            rows = max(1, CELLS // width)
            for lo in range(0, len(members), rows):
                some = members[lo : lo + rows]
                for i, ids in zip(some, self.merge_rows([pieces[i] for i in some], width), strict=True):
                    out[i] = ids
        return out

    def merge_rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, width)
        length = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < length[:, None], self.byte_ids[padded], -1)
        ids = np.concatenate([ids, np.full((len(ids), 1), -1, dtype=np.int32)], axis=1)
        ranks = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), width)
        row = np.arange(len(pieces))
        while len(row):
            at = ranks.argmin(axis=1)
            every = np.arange(len(row))
            best = ranks[every, at]
            done = best == NO_RANK
            if done.any():
                for r, line, n in zip(row[done], ids[done], length[done], strict=True):
                    out[r] = line[:n].copy()
                go = ~done
                row, ids, ranks, length, at, best = row[go], ids[go], ranks[go], length[go], at[go], best[go]
                if not len(row):
                    break
                every = np.arange(len(row))
                used = int(length.max()) + 1
                ids, ranks = ids[:, :used], ranks[:, : used - 1]
            # Close up over the right cell of the merged pair; its last cell becomes padding.
            last = ids.shape[1] - 1
            step = np.arange(last) + (np.arange(last) > at[:, None])
            ids = np.concatenate([np.take_along_axis(ids, step, axis=1), np.full((len(ids), 1), -1, dtype=np.int32)], axis=1)
            ids[every, at] = best
            step = np.minimum(np.arange(last) + (np.arange(last) > at[:, None]), last - 1)
            ranks = np.take_along_axis(ranks, step, axis=1)
            ranks[:, -1] = NO_RANK
            length = length - 1
            ranks[every, at] = self.pairs.ranks(best, ids[every, at + 1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pairs.ranks(ids[before, at[before] - 1], best[before])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same order through a heap of (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
        first = self.pairs.ranks(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NO_RANK)]
        heapq.heapify(heap)
        ends, n = list(range(1, len(piece) + 1)), len(piece)  # a part is [place, ends[place])
        starts = list(range(len(piece)))  # by last byte: where its part starts
        alive = bytearray(b"\1") * n

        def push(place: int) -> None:
            nxt = ends[place]
            if nxt < n:
                rank = self.ranks.get(piece[place : ends[nxt]])
                if rank is not None:
                    heapq.heappush(heap, (rank, place))

        while heap:
            rank, place = heapq.heappop(heap)
            if not alive[place] or ends[place] >= n or self.ranks.get(piece[place : ends[ends[place]]]) != rank:
                continue
            gone = ends[place]
            alive[gone] = 0
            ends[place] = ends[gone]
            starts[ends[place] - 1] = place
            push(place)
            if place:
                push(starts[place - 1])
        return np.array([self.ranks[piece[i : ends[i]]] for i in range(n) if alive[i]], dtype=np.int32)

    def encode(self, texts: list[str], pattern: regex.Pattern) -> Iterator[tuple[np.ndarray, bytes]]:
        """(ids, decimal ids joined by commas) of each text."""
        cut = [pattern.findall(text) for text in texts]
        if len(self.ids_of) > REMEMBERED:
            self.ids_of.clear()
            self.decimals_of.clear()
        new = list(set().union(*cut).difference(self.ids_of))
        for piece, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            self.ids_of[piece] = ids.tobytes()
            self.decimals_of[piece] = ",".join(map(str, ids.tolist())).encode()
        for pieces in cut:
            ids = b"".join(map(self.ids_of.__getitem__, pieces))
            yield np.frombuffer(ids, dtype=np.int32), b",".join(map(self.decimals_of.__getitem__, pieces))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_encoder: list = [None, None]


def worker_encoder(tokens: list[bytes]) -> Encoder:
    """The encoder of this Python worker (kept between tasks that use the same vocabulary)."""
    mark = hashlib.md5(b"\n".join(tokens)).digest()
    if _encoder[0] != mark:
        _encoder[:] = [mark, Encoder(tokens)]
    return _encoder[1]


def vocabulary_broadcast(df: DataFrame, vocabulary_path: str):
    return df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): one row per document; ``ids`` may be left out."""
    tokens = vocabulary_broadcast(docs, vocabulary_path)
    compiled: list = []

    def encode(part: pa.RecordBatch) -> pa.RecordBatch:
        if not compiled:
            compiled.extend([worker_encoder(tokens.value), regex.compile(pattern)])
        encoder, cut = compiled
        texts = part.column("text").fill_null("").to_pylist()
        counts, digests, decoded, ids_out = [], [], [], []
        for ids, decimal in encoder.encode(texts, cut):
            counts.append(len(ids))
            digests.append(hashlib.sha256(decimal).hexdigest())
            decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            if with_ids:
                ids_out.append(ids)
        columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(pa.array(ids_out, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return per_batch(docs.select("doc_id", "text"), "text", encode, schema)


def decode_ids(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text): the round trip's way back."""
    tokens = vocabulary_broadcast(encoded, vocabulary_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = [None if ids is None else b"".join(map(tokens.value.__getitem__, ids)).decode("utf-8", "replace") for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")


def public_vocabulary() -> tuple[str, str]:
    """(path of the rank file, pattern) of the installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), *public_vocabulary(), with_ids=False)
