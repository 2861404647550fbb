"""Document fingerprints from closed syncmers.

A k-mer is chosen if the least of its s-mers stands at its first or last place.
The choice looks at the k-mer alone, so the same passage gives the same anchors
in any document and an edit touches no anchor beyond k characters. All anchors
are kept, so a passage is found in a text of any length. Anchors are matched
with their positions: two documents are alike as far as their common anchors
keep their order, whatever is inserted or removed between them.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import slices, table, utf8

K = 10
S = 4
#: Code points that are hashed at once.
BLOCK = 1 << 18
#: Texts of fewer code points also give anchors of this length and inner length.
SHORT, SHORT_K, SHORT_S = 64, 4, 2
#: Ranges of doc_id at most; their bounds go to all tasks.
MOST_PARTS = 100_000
#: Pairs of equal anchors an anchor of two texts up to which all are tried.
MOST_PAIRS = 8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _codes(text: bytes | memoryview) -> np.ndarray:
    return np.frombuffer(bytes(text).decode("utf-8").encode("utf-32-le"), dtype=np.uint32)


def _window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A polynomial modulo 2**64 of each window of ``width`` code points, mixed; built by doubling."""
    mixed = _mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    base = 0x2545F4914F6CDD1D
    n = len(codes) - width + 1
    out, done = np.zeros(n, dtype=np.uint64), 0
    block, size = mixed, 1
    while True:
        if width >> (size.bit_length() - 1) & 1:
            out = out * np.uint64(pow(base, size, 1 << 64)) + block[done : done + n]
            done += size
        if done == width:
            return _mix(out)
        block = block[: len(block) - size] * np.uint64(pow(base, size, 1 << 64)) + block[size:]
        size *= 2


def syncmers(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes and places of the closed syncmers of a text of at least k code points."""
    with np.errstate(over="ignore"):
        inner = _window_hashes(codes, s)
        n, m = len(codes) - k + 1, k - s + 1
        least, size = inner, 1  # least of every window of m s-mers, by doubling
        while size * 2 <= m:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        least = np.minimum(least[:n], least[m - size : m - size + n])
        at = np.flatnonzero((inner[:n] == least) | (inner[m - 1 : m - 1 + n] == least))
        return _window_hashes(codes, k)[at] >> np.uint64(32), at


def sketch(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors of a text and their places, by place, then by hash.

    A text without a syncmer has one anchor, its first k code points or what
    there is of them; an empty text has none.
    """
    if len(codes) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = []
    for start in range(0, len(codes) - K + 1, BLOCK):
        h, at = syncmers(codes[start : start + BLOCK + K - 1])
        found.append((h, at + start))
    if SHORT_K <= len(codes) < SHORT:
        found.append(syncmers(codes, SHORT_K, SHORT_S))
    h, at = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if len(h) == 0:
        with np.errstate(over="ignore"):
            return _window_hashes(codes[:K], min(K, len(codes))) >> np.uint64(32), np.zeros(1, np.int64)
    if len(codes) < SHORT:
        order = np.lexsort((h, at))
        h, at = h[order], at[order]
    return h, at


def _rising(places: np.ndarray) -> int:
    """Length of the longest rising subsequence."""
    if (np.diff(places) > 0).all():
        return len(places)
    tails: list[int] = []
    for x in places.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails)


def _in_turn(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each anchor of x that has one, by rising place, the place in y of the equal anchor that comes as often before."""

    def keys(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(h, kind="stable")
        at = np.arange(len(h))
        first = np.maximum.accumulate(np.where(np.r_[True, np.diff(h[order]) > 0], at, 0))
        return h[order] << np.uint64(32) | (at - first).astype(np.uint64), order

    (kx, ox), (ky, oy) = keys(x), keys(y)
    _, i, j = np.intersect1d(kx, ky, assume_unique=True, return_indices=True)
    return oy[j][np.argsort(ox[i])]


def chain(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence of two texts' anchors.

    Exact, but in texts that repeat the same anchors so often that all their
    pairs are more than MOST_PAIRS an anchor: there equal anchors meet in turn,
    from the start or from the end, whichever gives more.
    """
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    front = int(differ[0]) if len(differ) else n
    x, y, n = x[front:], y[front:], n - front
    differ = np.flatnonzero(x[::-1][:n] != y[::-1][:n])
    back = int(differ[0]) if len(differ) else n
    x, y = x[: len(x) - back], y[: len(y) - back]
    if len(x) == 0 or len(y) == 0:
        return front + back
    order = np.argsort(y, kind="stable")
    low, high = (np.searchsorted(y[order], x, side) for side in ("left", "right"))
    each = high - low
    total = int(each.sum())
    if total > MOST_PAIRS * (len(x) + len(y)):
        return front + back + max(_rising(_in_turn(x, y)), _rising(_in_turn(x[::-1], y[::-1])))
    # an anchor's places in y by falling place, so that it counts once
    return front + back + _rising(order[np.repeat(high, each) - 1 - (np.arange(total) - np.repeat(np.cumsum(each) - each, each))])


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The longest chain of common anchors whose places rise in both texts: twice its length over the anchors of both.

    Two empty texts are alike, an empty and another not at all.
    """
    if len(a[0]) == 0 or len(b[0]) == 0:
        return float(len(a[0]) == len(b[0]))
    return 2 * chain(a[0], b[0]) / (len(a[0]) + len(b[0]))


def text_of(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """Base64 of the anchors by place: how many, 32-bit hashes, steps from place to place as bytes, and in 64 bits each the steps of 255 or more; no anchors are the empty string."""
    h, at = fingerprint
    if len(h) == 0:
        return ""
    steps = np.diff(at, prepend=0)
    return base64.b64encode(b"".join([np.uint64(len(h)).tobytes(), h.astype("<u4").tobytes(), np.minimum(steps, 255).astype(np.uint8).tobytes(), steps[steps >= 255].astype("<i8").tobytes()])).decode()


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    data = base64.b64decode(fingerprint)
    n = int.from_bytes(data[:8], "little")
    steps = np.frombuffer(data, dtype=np.uint8, count=n, offset=8 + 4 * n if n else 0).astype(np.int64)
    steps[steps == 255] = np.frombuffer(data[8 + 5 * n :], dtype="<i8")
    return np.frombuffer(data[8 : 8 + 4 * n], dtype="<u4").astype(np.uint64), np.cumsum(steps)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each row. Null is empty, whose fingerprint is the empty string; repeated rows come out as often."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array([text_of(sketch(_codes(x))) for x in utf8(batch.column("__text"))], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, fingerprint string")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """docs with ``part``, the number of its range of doc_ids, and the first row of each range once more, as ``head``, in the range before.

    The first range's head goes to the last range. Only ids are read to find
    the ranges, and a head for each range.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id").where("doc_id is not null")
    cuts = sorted(set(ids.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    bounds = spark.sparkContext.broadcast(np.array(cuts))

    @F.pandas_udf("int")
    def part(doc_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds.value, doc_id.to_numpy(np.float64, na_value=-np.inf), side="left"))

    docs = docs.withColumn("part", part("doc_id"))
    firsts = {r.part: r.least for r in docs.where("doc_id is not null").groupBy("part").agg(F.min("doc_id").alias("least")).collect()}  # a row a range
    nulls = docs.where("doc_id is null")
    no_id = nulls.agg(F.min("text").alias("text")).first().text
    order = sorted(set(firsts) | ({0} if no_id is not None else set()))
    if not order:
        return docs.withColumn("head", F.lit(False))
    before = dict(zip(order, [order[-1], *order[:-1]]))
    wanted = spark.createDataFrame([(i, before[p]) for p, i in firsts.items() if p or no_id is None] or [(None, 0)], "first long, part int")
    heads = docs.drop("part").join(F.broadcast(wanted), F.col("doc_id") == F.col("first")).groupBy("doc_id", "part").agg(F.min("text").alias("text"))
    if no_id is not None:
        heads = heads.unionByName(nulls.groupBy("doc_id").agg(F.min("text").alias("text")).withColumn("part", F.lit(before[0])))
    return docs.withColumn("head", F.lit(False)).unionByName(heads.select("doc_id", "text", "part", F.lit(True).alias("head")))


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of an edited form of it, and how alike they are.

    docs: doc_id, text; other columns are ignored. Null is empty. The last
    floor(n_chars / 2) code points are replaced by the first as many (or all) of
    the next document, by rising doc_id, the first coming after the last. Of
    repeated doc_ids the next is the following row, by text; null ids come
    first. A table of one row is followed by itself; an empty one gives an empty
    one. Rows are dealt once, by ranges of doc_id, each a few times smaller than
    what a task reads of the input.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in slices(batches, "text", 1 << 20):
            rows = []
            for doc, part, head, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "head")), utf8(batch.column("text"))):
                codes = _codes(text)
                own = sketch(codes)
                if held is not None and held[1] == part:
                    before, _, old, old_own = held
                    half = len(old) // 2
                    edited = np.concatenate([old[: len(old) - half], codes[:half]])
                    changed = sketch(edited)
                    sha = hashlib.sha256(edited.tobytes().decode("utf-32-le").encode("utf-8")).hexdigest()
                    rows.append((before, len(old), sha, text_of(old_own), text_of(changed), likeness(old_own, changed), likeness(old_own, own)))
                held = None if head else (doc, part, codes, own)
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[x.split()[0] for x in RESULT.split(", ")])

    dealt = _dealt(docs, min(MOST_PARTS, 4 * max(1, docs.rdd.getNumPartitions())))
    return dealt.repartition("part").sortWithinPartitions("part", "head", "doc_id", "text").mapInArrow(of, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(table(spark, sf_dir, "documents"))
