"""Best-fit packing by minimum bin slack.

What fills a sequence depends on lengths alone, and there are at most
``capacity`` of them: a count for each length goes to the driver, which plans
the bins. For each bin a subset-sum over the lengths that are left, kept as one
bitset for each length, finds the fullest combination that holds the longest
length left; it is taken as often as the counts allow and removed. Executors
then give the k-th piece of a length the k-th place that the plan has for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import slices, table, utf8, written
from fleethealth.llm.tokens import special_aware

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """The lengths, longest first, of a fullest bin that holds the longest length left."""
    lengths = sorted(counts, reverse=True)
    first = lengths[0]
    room = capacity - first
    reach = [1]  # bit s: the sum s can be had from the lengths so far
    steps = []
    mask = (1 << room + 1) - 1
    for length in lengths:
        n = min(counts[length] - (length == first), room // length)
        now, k = reach[-1], 1
        while n > 0:  # up to n times, by powers of two
            k = min(k, n)
            now |= now << k * length & mask
            n -= k
            k *= 2
        steps.append(length)
        reach.append(now)
        if now >> room & 1:
            break
    total = reach[-1].bit_length() - 1
    out = [first]
    for i in range(len(steps) - 1, -1, -1):  # back through the bitsets: as few of each length as will do
        while not reach[i] >> total & 1:
            out.append(steps[i])
            total -= steps[i]
    return sorted(out, reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, bins of that kind), until no piece is left. At most two kinds or so for each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("a length is between 1 and the capacity")
    out = []
    while left:
        kind = fullest(left, capacity)
        times = min(left[n] // kind.count(n) for n in set(kind))
        out.append((kind, times))
        for n in set(kind):
            left[n] -= times * kind.count(n)
            if left[n] == 0:
                del left[n]
    return out


def places(kinds: list[tuple[list[int], int]]) -> dict[int, list[tuple[int, int, int, list[int]]]]:
    """For each length, in order: (first rank, rank after the last, first sequence, offsets in each sequence)."""
    out: dict[int, list[tuple[int, int, int, list[int]]]] = {}
    sequence = 0
    for kind, times in kinds:
        offsets: dict[int, list[int]] = {}
        at = 0
        for n in kind:
            offsets.setdefault(n, []).append(at)
            at += n
        for n, own in offsets.items():
            spans = out.setdefault(n, [])
            begin = spans[-1][1] if spans else 0
            spans.append((begin, begin + times * len(own), sequence, own))
        sequence += times
    return out


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """A row for each piece; part and nth number the pieces of one length: nth within its part, a part being what one task read."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = special_aware(vocabulary)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in slices(batches, "__text", 1 << 20):
            rows = []
            for doc, text in zip(batch.column("__id").to_pylist(), utf8(batch.column("__text"))):
                ids = np.append(encode(bytes(text).decode("utf-8")), np.uint32(end))
                n = len(ids)
                head = n % capacity or capacity
                start = 0
                for k, size in enumerate([head] + [capacity] * ((n - head) // capacity)):
                    rows.append((doc, k, start, size, zlib.crc32(ids[start : start + size].astype("<u4")), part, int(seen[size])))
                    seen[size] += 1
                    start += size
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, PIECE)


def packed(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens.

    docs: doc_id, text; other columns are ignored. A document is its text's ids
    (null: none) and ``end``. Documents of more than ``capacity`` ids are cut in
    pieces of ``capacity``, the first one perhaps shorter; no other is cut. Gives
    a row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Repeated rows are packed as often as they are there, rows without
    doc_id too. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    cut = written(pieces(docs, vocabulary, capacity, end), "pieces")
    in_part = written(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r.length: r.n for r in in_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    shared = spark.sparkContext.broadcast(places(plan(counts, capacity)))  # two places or so for each length
    before = in_part.selectExpr("part", "length", "sum(n) OVER (PARTITION BY length ORDER BY part) - n AS before")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("before").to_numpy(zero_copy_only=False) + batch.column("nth").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                rows = order[a:b]
                own = spans[int(lengths[rows[0]])]
                which = np.searchsorted([x[1] for x in own], rank[rows], side="right")
                for k in np.unique(which).tolist():
                    begin, _, first, at = own[k]
                    hit = rows[which == k]
                    sequence[hit] = first + (rank[hit] - begin) // len(at)
                    offset[hit] = np.asarray(at)[(rank[hit] - begin) % len(at)]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return cut.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "before", "nth").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
