"""Exact deduplication by composable polynomial fingerprints.

A text of n bytes is cut into chunks. A chunk's value is its bytes, read as
16-bit numbers, in a polynomial modulo a prime; chunks combine by
``value(a + b) = value(a) * base ** length(b) + value(b)``, so chunks of one
huge text can be hashed anywhere and in parallel where they are stored as rows
(``chunk_table_fingerprints``); the query hashes each text in one task. Two primes give 62 bits, and
the length in bytes is part of the key. Rows whose keys are equal are then
compared chunk by chunk on their bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from fleethealth.llm.common import delete_work, join_sized, slices, table, utf8, written

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1299709601)
#: 16-bit numbers in a chunk: products below 2**47, sums below 2**59.
UNITS = 4096
#: Bytes of a chunk that is compared.
COMPARED = 1 << 16


@functools.cache
def _powers() -> list[np.ndarray]:
    out = []
    for p, r in zip(PRIMES, BASES):
        row = np.empty(UNITS, dtype=np.int64)
        x = 1
        for i in range(UNITS - 1, -1, -1):
            row[i] = x
            x = x * r % p
        out.append(row)
    return out


def combine(left: tuple[int, ...], right: tuple[int, ...], right_units: int) -> tuple[int, ...]:
    """The value of left followed by right, from their values and right's length in 16-bit numbers."""
    return tuple((a * pow(r, right_units, p) + b) % p for a, b, r, p in zip(left, right, BASES, PRIMES))


def polynomial(data: bytes | memoryview) -> tuple[int, int]:
    """The fingerprint of ``data``; an odd last byte counts as a number of its own (the length in the key tells the two apart)."""
    n = len(data)
    even = np.frombuffer(data, dtype="<u2", count=n // 2)
    whole = len(even) // UNITS
    value = (0, 0)
    if whole:
        parts = even[: whole * UNITS].reshape(whole, UNITS)
        for at in range(0, whole, 64):
            block = parts[at : at + 64].astype(np.int64)
            sums = [(block @ w) % p for w, p in zip(_powers(), PRIMES)]
            for x in zip(*(s.tolist() for s in sums)):
                value = combine(value, x, UNITS)
    rest = even[whole * UNITS :].astype(np.int64)
    if n % 2:
        rest = np.append(rest, np.int64(data[n - 1]))
    if len(rest):
        value = combine(value, tuple(int(rest @ w[UNITS - len(rest) :]) % p for w, p in zip(_powers(), PRIMES)), len(rest))
    return value


def key_of(value: tuple[int, int]) -> int:
    return value[0] << 31 | value[1]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, fp and sha256 for each row; a null text counts as empty."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            texts = utf8(batch.column("__text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__id"),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([key_of(polynomial(x)) for x in texts], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                ],
                names=["doc_id", "n_bytes", "fp", "text_sha256"],
            )

    return docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).mapInArrow(of, "doc_id long, n_bytes long, fp long, text_sha256 string")


def chunk_table_fingerprints(chunks: DataFrame) -> DataFrame:
    """Fingerprints of texts that are stored as rows (doc_id, chunk_no, data binary), each chunk but a text's last of an even number of bytes.

    Chunks are hashed where they lie; only their values and lengths meet, in
    the order of chunk_no. Null data is an empty chunk. Gives doc_id, n_bytes, fp.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x or b"" for x in batch.column("data").to_pylist()]
            units = [(len(x) + 1) // 2 for x in data]
            values = [polynomial(x) for x in data]
            shifts = [tuple(pow(r, n, p) for r, p in zip(BASES, PRIMES)) for n in units]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("chunk_no"),
                    pa.array([len(x) for x in data], pa.int64()),
                    *(pa.array([v[i] for v in values], pa.int64()) for i in (0, 1)),
                    *(pa.array([s[i] for s in shifts], pa.int64()) for i in (0, 1)),
                ],
                names=["doc_id", "chunk_no", "n", "v0", "v1", "s0", "s1"],
            )

    values = chunks.select(F.col("doc_id").cast("long"), F.col("chunk_no").cast("long"), "data").mapInArrow(of, "doc_id long, chunk_no long, n long, v0 long, v1 long, s0 long, s1 long")

    def fold(i: int) -> Column:
        return F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: (a * x[f"s{i}"] + x[f"v{i}"]) % PRIMES[i])

    return values.groupBy("doc_id").agg(F.sum("n").alias("n_bytes"), F.sort_array(F.collect_list(F.struct("chunk_no", "v0", "v1", "s0", "s1"))).alias("parts")).select("doc_id", "n_bytes", (F.shiftleft(fold(0), 31) + fold(1)).alias("fp"))


def _bloom_positions(keys: np.ndarray, n_bits: int) -> list[np.ndarray]:
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [((h >> np.uint64(s)) ^ (h >> np.uint64(s + 20))) % np.uint64(n_bits) for s in (1, 9, 17)]


def _mixed(keys: DataFrame, docs: DataFrame, n_bits: int) -> DataFrame:
    """(n_bytes, fp, chunk_no, data) of the texts whose key may be among ``keys``.

    The filter has n_bits bits whatever the number of keys, so its broadcast is
    bounded; with more keys more texts that need no comparison pass, which
    costs time and changes nothing.
    """
    spark = docs.sparkSession

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[int] = set()
        bits = np.zeros(n_bits // 8, dtype=np.uint8)
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in _bloom_positions(fp, n_bits):
                np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        for block in np.flatnonzero(bits.reshape(-1, 4096).any(axis=1)).tolist():
            words.add(block)
        blocks = sorted(words)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([bits[4096 * b : 4096 * (b + 1)].tobytes() for b in blocks], pa.binary())], names=["block", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist()):
                now = np.frombuffer(data, dtype=np.uint8)
                out[block] = out[block] | now if block in out else now
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([x.tobytes() for x in out.values()], pa.binary())], names=["block", "bits"])

    full = np.zeros(n_bits // 8, dtype=np.uint8)
    for row in keys.select("fp").mapInArrow(fill, "block int, bits binary").repartition(F.col("block")).mapInArrow(merge, "block int, bits binary").collect():  # n_bits / 8 bytes at most
        full[4096 * row.block : 4096 * (row.block + 1)] = np.frombuffer(row.bits, dtype=np.uint8)
    shared = spark.sparkContext.broadcast(full.tobytes())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in slices(batches, "__text"):
            texts = utf8(batch.column("__text"))
            fps = np.array([key_of(polynomial(x)) for x in texts], dtype=np.int64)
            hit = np.ones(len(fps), dtype=bool)
            for at in _bloom_positions(fps, n_bits):
                hit &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            rows = [(len(texts[i]), int(fps[i]), k, bytes(texts[i][a : a + COMPARED])) for i in np.flatnonzero(hit).tolist() for k, a in enumerate(range(0, max(1, len(texts[i])), COMPARED))]
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["n_bytes", "fp", "chunk_no", "data"])

    return docs.select(F.col("text").alias("__text")).mapInArrow(pick, "n_bytes long, fp long, chunk_no int, data binary")


def exact_groups(docs: DataFrame, filter_bits: int = 1 << 25) -> DataFrame:
    """Groups of rows whose texts are the same, byte for byte.

    docs: doc_id, text; other columns are ignored. Null text is empty. One row
    out for each row in, repeated rows too: doc_id, keep_id (the largest doc_id
    of the group), group_size (rows), kept, text_sha256. Of repeated rows with
    one doc_id all are kept or none. A null doc_id never stays where another
    one is there; a group of only null ids keeps all its rows, with keep_id null.
    An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = written(fingerprints(docs), "fingerprints")
    key = ["n_bytes", "fp"]
    groups = prints.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    repeated = written(groups.where("group_size > 1").select(*key), "repeated")
    chunks = _mixed(repeated, docs, filter_bits).groupBy(*key, "chunk_no").agg(F.min("data").alias("low"), F.max("data").alias("high"))
    clashes = written(chunks.where("low <> high").select(*key).distinct().join(repeated, key, "left_semi"), "clashes")
    delete_work(docs.sparkSession, repeated)
    if not clashes.isEmpty():  # different texts of one fingerprint: these are told apart by their bytes
        ids = prints.join(clashes, key, "left_semi").select("doc_id", *key)
        texts = docs.join(ids, docs.doc_id.eqNullSafe(ids.doc_id), "left_semi")
        named = texts.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.first(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_sha256"))
        groups = groups.join(clashes, key, "left_anti").withColumn("text_sha256", F.lit(None).cast("string"))
        apart = prints.join(clashes, key, "left_semi").join(named, "text_sha256").select(prints["*"], "keep_id", "group_size")
        same = prints.join(clashes, key, "left_anti").join(groups.drop("text_sha256"), key)
        joined = same.select(*apart.columns).unionByName(apart)
    else:
        joined = join_sized(prints, groups, key, "group_size", prints.count())
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns, extra ones too.

    Of rows that repeat doc_id and text one stays, the least by the hash of
    all columns (those that Spark can hash), so that a second run keeps the same.
    """
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    ids = exact_groups(docs).where("kept").select(key(F.col("doc_id")).alias("__fh_id"), F.col("text_sha256").alias("__fh_sha"))
    texts = docs.withColumns({"__fh_id": key(F.col("doc_id")), "__fh_sha": F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)})
    return _one_row(texts.join(ids, ["__fh_id", "__fh_sha"], "left_semi"), docs)


def _one_row(stays: DataFrame, docs: DataFrame) -> DataFrame:
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    least = F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.xxhash64(*hashed)).alias("row")  # combined before the shuffle
    return stays.groupBy("__fh_id", "__fh_sha").agg(least).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
