"""Byte-level BPE by dynamic programming over prefixes.

Of the tokens that can end a prefix of a piece, exactly one ends the encoding
of that prefix: the one that joins validly with the last token of what stands
before it. So one array, the last token of each prefix, holds the encodings of
all prefixes; appending bytes extends it, and an edit leaves it valid up to the
edit. A pair of tokens is valid if merging the bytes of both, in the order of
the ranks, gives just the two.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import slices, table, utf8
from fleethealth.llm.tokens import ranks

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces and pairs that a process remembers; beyond that it starts anew.
REMEMBERED = 400_000
#: Code points of a text that are cut into pieces at once.
LONG = 1 << 21


class Vocabulary:
    """Ranks of byte strings, with what the dynamic programming needs of them."""

    def __init__(self, rank_of: dict[bytes, int]) -> None:
        self.rank_of = rank_of
        self.bytes_of = {i: b for b, i in rank_of.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.size_of = {i: len(b) for i, b in self.bytes_of.items()}
        self.pieces: dict[str, tuple[int, ...]] = {}
        # a token counts in the dynamic programming if merging its own bytes gives it
        self.whole: dict[bytes, int] = {}
        for b, i in sorted(rank_of.items(), key=lambda x: x[1]):
            if len(b) == 1:
                self.halves[i] = None
                self.whole[b] = i
            else:
                parts = self._merged(b, below=i)
                if len(parts) == 2:
                    self.halves[i] = (parts[0], parts[1])
                    self.whole[b] = i
        self.merges = {h: i for i, h in self.halves.items() if h}
        # what may still become a token: the beginnings of all tokens, as numbered states
        self.state_of = {b"": 0}
        for b in self.whole:
            for k in range(1, len(b) + 1):
                self.state_of.setdefault(b[:k], len(self.state_of))
        self.begun = list(self.state_of)
        self.next: dict[int, int] = {}
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {}

    def _merged(self, data: bytes, below: int | None = None) -> list[int]:
        """Plain merging: the pair of the lowest rank, leftmost first, until no pair has a rank (under ``below``)."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = self.rank_of.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best) and (below is None or r < below):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank_of[p] for p in parts]

    def joins(self, a: int, b: int) -> bool:
        """Whether tokens a and b stand side by side when their bytes are merged together.

        The merges that made both are undone, the latest first, along the seam.
        A merge across the seam would have come before the one undone last if
        its rank is lower; then the two don't stand.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        merges, halves = self.merges, self.halves
        undone = len(self.rank_of) + 1
        while True:
            across = merges.get((a, b))
            if across is not None and across < undone:
                known = False
                break
            left, right = halves[a], halves[b]
            if left is None and right is None:
                known = True
                break
            # of two merges of one rank the left one comes first
            if right is None or left is not None and a > b:
                undone, a = a, left[1]
            else:
                undone, b = b + 1, right[0]
        self.pairs[key] = known
        return known

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte: the longest beginning of a token that the bytes so far end with."""
        held = self.begun[state] + bytes((byte,))
        while (found := self.state_of.get(held)) is None:
            held = held[1:]
        if len(self.next) >= REMEMBERED:
            self.next.clear()
        self.next[state << 8 | byte] = found
        if found not in self.ends:
            self.ends[found] = tuple((self.whole[held[k:]], len(held) - k) for k in range(len(held)) if held[k:] in self.whole)
        return found

    def extend(self, data: bytes, last: list[int], states: list[int]) -> list[int]:
        """last[i] and states[i]: the last token of data[:i + 1], and the tokens that may go on from there. Fills both up from where they end, in place.

        Of the tokens that end at a byte, the longest first, the one that stands
        beside the last token of what is before it is taken; just one does.
        """
        after, ends, known, joins = self.next.get, self.ends, self.pairs.get, self.joins
        state = states[-1] if states else 0
        for end in range(len(last), len(data)):
            now = after(state << 8 | data[end])
            state = now if now is not None else self.step(state, data[end])
            for token, n in ends[state]:
                if n > end:
                    break
                stands = known(last[end - n] << 32 | token)
                if stands or stands is None and joins(last[end - n], token):
                    break
            else:
                raise ValueError("a byte without a token")
            last.append(token)
            states.append(state)
        return last

    def tokens(self, last: list[int]) -> list[int]:
        """The ids of the whole, walking back from the last token."""
        out, end, size_of = [], len(last), self.size_of
        while end:
            token = last[end - 1]
            out.append(token)
            end -= size_of[token]
        out.reverse()
        return out

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The ids of each piece that isn't remembered; a piece that is a token is that token, however merging would go.

        Pieces are taken in the order of their bytes, so each keeps what the
        one before has settled of the bytes that both begin with.
        """
        out: dict[str, tuple[int, ...]] = {}
        before, last, states = b"", [], []
        for text in sorted(pieces):
            data = text.encode("utf-8")
            one = self.rank_of.get(data)
            if one is not None:
                out[text] = (one,)
                continue
            n = min(len(before), len(data))
            differ = int.from_bytes(before[:n]) ^ int.from_bytes(data[:n])
            same = n - (differ.bit_length() + 7) // 8
            del last[same:], states[same:]
            before = data
            out[text] = tuple(self.tokens(self.extend(data, last, states)))
        return out

    def ids(self, found: list[list[str]]) -> list[np.ndarray]:
        """The ids of each list of pieces; what none of them has had before is learnt together."""
        if len(self.pieces) >= REMEMBERED:
            self.pieces.clear()
        new = self.learn(set(chain.from_iterable(found)).difference(self.pieces))
        self.pieces.update((x, ids) for x, ids in new.items() if len(x) <= 64)
        known, learnt, out = self.pieces.get, new.get, []
        for own in found:
            ids: list[int] = []
            for x in own:
                ids += known(x) or learnt(x)
            out.append(np.array(ids, dtype="<u4"))
        return out


class Prefixes:
    """The encoding of one growing or edited piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last, self.states = vocabulary, b"", [], []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.vocabulary.extend(self.data, self.last, self.states)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Puts data in the place of bytes start to end; what stands before start is not encoded again."""
        self.data = self.data[:start] + data + self.data[end:]
        del self.last[start:], self.states[start:]
        self.vocabulary.extend(self.data, self.last, self.states)

    def ids(self) -> list[int]:
        one = self.vocabulary.rank_of.get(self.data)
        return [one] if one is not None else self.vocabulary.tokens(self.last)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(ranks(path))


@functools.cache
def pieces_of(pattern: str = public_tokenizers.PATTERN):
    return regex.compile(pattern)


def encode_all(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text. Texts of over LONG code points are cut into pieces bit by bit, so that their pieces aren't held at once."""
    voc, split = vocabulary(path), pieces_of()
    short = [k for k, x in enumerate(texts) if len(x) <= LONG]
    out = dict(zip(short, voc.ids([split.findall(texts[k]) for k in short])))
    for k, text in enumerate(texts):
        if k not in out:
            found = (m.group() for m in split.finditer(text))
            out[k] = np.concatenate([voc.ids([own])[0] for own in iter(lambda: list(islice(found, LONG // 8)), [])])
    return [out[k] for k in range(len(texts))]


def encode(text: str, path: str) -> np.ndarray:
    return encode_all([text], path)[0]


def decode(ids: np.ndarray, path: str) -> bytes:
    return b"".join(map(vocabulary(path).bytes_of.__getitem__, ids.tolist()))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) for each row: the text's matches of the pattern, each encoded apart, no special tokens.

    docs: doc_id, text; other columns are ignored. Null is empty and has no ids.
    Repeated rows come out as often; a null doc_id stays null.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", LONG):
            ids = encode_all([bytes(x).decode("utf-8") for x in utf8(batch.column("__text"))], path)
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and data (binary) of rows doc_id, ids; null ids are none."""
    path = path or public_tokenizers.path(VOCABULARY)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = [decode(np.asarray(x if x is not None else [], dtype="<u4"), path) for x in (y.values.to_numpy(zero_copy_only=False) if y.is_valid else None for y in part.column("ids"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return tokens.select("doc_id", "ids").mapInArrow(of, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, encoding and decoding in one pass; see encoded."""
    path = path or public_tokenizers.path(VOCABULARY)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", LONG):
            every = encode_all([bytes(x).decode("utf-8") for x in utf8(batch.column("__text"))], path)
            n, a, b = zip(*((len(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decode(ids, path)).hexdigest()) for ids in every))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
