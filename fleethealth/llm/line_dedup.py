"""Line deduplication with two Bloom filters.

A first pass puts the 64-bit hash of every line key into a filter of keys that
were seen once and, when another document brings it, into one of keys that
were seen twice. A second pass looks each line up in the second filter; only
lines that may be repeats are shuffled, and their text decides; a document then
gets the SHA-256 of what it loses. A filter's false hit costs a shuffled row and never changes the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import LOWER, SPACE, join_sized, slices, table, utf8, written

LEAST_CHARS = 10
#: 64-bit words of a filter: what a task can hold. With over about eight keys a word more lines are shuffled, no other ones dropped.
MOST_WORDS = 1 << 23
#: Words in a block of the filters; blocks are merged apart from each other.
BLOCK = 1 << 14


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).translate(LOWER)


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def document_keys(text: bytes | memoryview, least: int) -> list[bytes | None]:
    """Each line's key, or None where it is too short to count."""
    return [k if len(k) >= least and code_points(k) >= least else None for k in map(line_key, bytes(text).split(b"\n"))]


def _words_and_masks(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """A key has one word of a filter and four bits in it."""
    one = np.uint64(1)
    mask = np.zeros(len(h), dtype=np.uint64)
    for s in (0, 6, 12, 18):
        mask |= one << ((h >> np.uint64(s)) & np.uint64(63))
    return ((h >> np.uint64(24)) % np.uint64(words)).astype(np.int64), mask


def twice_seen_filter(docs: DataFrame, words: int, least: int = LEAST_CHARS) -> np.ndarray:
    """The filter of keys that at least two documents may hold: ``words`` 64-bit words, merged block by block on the executors."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = []
        for batch in slices(batches, "__text"):
            for text in utf8(batch.column("__text")):
                own = {xxhash.xxh64_intdigest(k) for k in document_keys(text, least) if k is not None}
                hashes.append(np.fromiter(own, dtype=np.uint64, count=len(own)))
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]), return_counts=True)
        at, mask = _words_and_masks(keys, words)
        order = np.argsort(at, kind="stable")
        at, mask, again = at[order], mask[order], np.where(counts[order] > 1, mask[order], np.uint64(0))
        if len(at) == 0:
            return
        # keys of one word meet here as well: a bit that two of them set counts as seen twice
        first = np.flatnonzero(np.r_[True, np.diff(at) > 0])
        once, twice = np.bitwise_or.reduceat(mask, first), np.bitwise_or.reduceat(again, first)
        at = at[first]
        cuts = np.flatnonzero(np.r_[True, np.diff(at // BLOCK) > 0]).tolist() + [len(at)]
        spans = list(zip(cuts, cuts[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(at[a]) // BLOCK for a, _ in spans], pa.int32()),
                pa.array([(at[a:b] % BLOCK).astype(np.uint16).tobytes() for a, b in spans], pa.binary()),
                pa.array([once[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([twice[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            names=["block", "at", "once", "twice"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, once, twice in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "once", "twice"))):
                if block not in held:
                    held[block] = np.zeros((2, BLOCK), dtype=np.uint64)
                one, two = held[block]
                i = np.frombuffer(at, dtype=np.uint16)
                now = np.frombuffer(once, dtype=np.uint64)
                two[i] |= np.frombuffer(twice, dtype=np.uint64) | (one[i] & now)
                one[i] |= now
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x[1].tobytes() for x in held.values()], pa.binary())], names=["block", "twice"])

    parts = docs.select(F.col("text").alias("__text")).mapInArrow(fill, "block int, at binary, once binary, twice binary")
    out = np.zeros(words, dtype=np.uint64)
    for row in parts.repartition(F.col("block")).mapInArrow(merge, "block int, twice binary").collect():  # 8 bytes a word in all
        now = np.frombuffer(row.twice, dtype=np.uint64)
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = now
    return out


def filter_words(n_docs: int) -> int:
    """A word for each document, as documents have some ten lines; a power of two within MOST_WORDS."""
    return min(MOST_WORDS, max(BLOCK, 1 << max(0, int(n_docs) - 1).bit_length()))


def repeated_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """Lines to drop: (doc_id, digest), digest being the SHA-256 of the line's key. See deduplicated_lines."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    words = filter_words(docs.count())
    shared = spark.sparkContext.broadcast(twice_seen_filter(docs, words, least).tobytes())

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, dtype=np.uint64)
        for batch in slices(batches, "__text"):
            ids, keys = [], []
            for doc, text in zip(batch.column("__id").to_pylist(), utf8(batch.column("__text"))):
                own = list({k for k in document_keys(text, least) if k is not None})
                ids += [doc] * len(own)
                keys += own
            if not keys:
                continue
            at, mask = _words_and_masks(np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys)), words)
            hit = np.flatnonzero(twice[at] & mask == mask).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in hit], pa.int64()), pa.array([keys[i] for i in hit], pa.binary())], names=["doc_id", "key"])

    found = written(docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).mapInArrow(suspects, "doc_id long, key binary"), "suspects")
    digest = F.unhex(F.sha2("key", 256))
    ends = found.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    first = written(ends.where("first <> last").select(digest.alias("digest"), "first", "n"), "repeated-lines")
    lines = found.select("doc_id", digest.alias("digest"))
    return join_sized(lines, first, ["digest"], "n", found.count()).where("doc_id <> first").select("doc_id", "digest")


def deduplicated_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """Drops lines that an earlier document holds.

    docs: doc_id, text; other columns are ignored. A text is split at \\n, null
    or empty being one empty line. A line's key is the line without ASCII white
    space at both ends and with A-Z in lower case. Keys of at least ``least``
    code points that two doc_ids hold lose all their lines but in the smallest
    doc_id that holds them. Gives a row for each row: doc_id, text (what stays,
    joined by \\n; an empty string if nothing does), n_lines, n_dropped.
    Repeated rows of one doc_id count as one document. Rows without doc_id come
    out unchanged and don't count. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drops = repeated_lines(docs, least).groupBy("doc_id").agg(F.collect_set("digest").alias("drops"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, lines, dropped = [], [], []
            for text, drop in zip(utf8(batch.column("text")), batch.column("drops").to_pylist()):
                if not drop:
                    texts.append(bytes(text))
                    lines.append(texts[-1].count(b"\n") + 1)
                    dropped.append(0)
                    continue
                gone = set(drop)
                own = bytes(text).split(b"\n")
                stay = [x for x, k in zip(own, document_keys(text, least)) if k is None or hashlib.sha256(k).digest() not in gone]
                texts.append(b"\n".join(stay))
                lines.append(len(own))
                dropped.append(len(own) - len(stay))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"])

    return docs.join(drops, "doc_id", "left").select("doc_id", "text", "drops").mapInArrow(keep, "doc_id long, text string, n_lines long, n_dropped long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM split
), firsts AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) <> max(doc_id)
), marked AS (
  SELECT keyed.doc_id, pos, line, coalesce(keyed.doc_id <> first, false) AS gone FROM keyed LEFT JOIN firsts ON keyed.k = firsts.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
