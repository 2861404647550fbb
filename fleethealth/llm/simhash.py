"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Distinct fingerprints are laid out in cells by the population counts of their
four 16-bit parts, and cells in tiles. The sum over the parts of the
differences between two cells' counts is a lower bound of the bits in which
their fingerprints differ, so tile pairs beyond the radius are skipped and all
others are compared in full, by exclusive-or and bit counts in numpy. A tile
pair gives the edges of a spanning forest of its links and not all of them,
so the output stays linear in the tiles' size in dense groups.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import LOWER, join_sized, slices, table, utf8, written
from fleethealth.llm.components import Forest, connected

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints in a tile, on average at most.
TILE = 2048
PARTS = 4

#: XXH64's fixed values.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64_spans(data: bytes, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each data[start:start + size]."""
    padded = data + bytes(8)
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    with np.errstate(over="ignore"):
        s = np.uint64(seed)
        at = start.astype(np.int64)
        left = size.astype(np.int64)
        h = np.full(len(at), s + P5, dtype=np.uint64)
        long = np.flatnonzero(left >= 32)
        if len(long):
            v = [np.full(len(long), x, dtype=np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            stripes = left[long] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                base = at[long[on]] + 32 * k
                for j in range(4):
                    v[j][on] = _round(v[j][on], words[base + 8 * j])
            x = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for j in range(4):
                x = (x ^ _round(np.zeros_like(x), v[j])) * P1 + P4
            h[long] = x
        h += left.astype(np.uint64)
        at = at.copy()
        at[long] += left[long] // 32 * 32
        left[long] %= 32
        for _ in range(3):
            on = np.flatnonzero(left >= 8)
            if len(on) == 0:
                break
            lane = words[at[on]]
            h[on] = _rotl(h[on] ^ _rotl(lane * P2, 31) * P1, 27) * P1 + P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        h[on] = _rotl(h[on] ^ (words[at[on]] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
        at[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero(left >= 1)
            if len(on) == 0:
                break
            h[on] = _rotl(h[on] ^ (words[at[on]] & np.uint64(255)) * P5, 11) * P1
            at[on] += 1
            left[on] -= 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    return h


def simhashes(texts: list[bytes | memoryview], width: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text: see near_groups."""
    clean = [b" ".join(bytes(x).translate(LOWER).split()) for x in texts]
    words = np.array([x.count(b" ") + 1 if x else 0 for x in clean], dtype=np.int64)
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(words)
    if len(full) == 0:
        return out
    data = b" ".join(x for x in clean if x)
    gaps = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
    words = words[full]
    first_word = np.cumsum(words) - words
    shingles = np.maximum(1, words - width + 1)
    first = np.cumsum(shingles) - shingles
    doc = np.repeat(np.arange(len(words)), shingles)
    a = first_word[doc] + np.arange(len(doc)) - first[doc]
    b = a + np.minimum(width, words[doc]) - 1
    bits = np.zeros((len(words), 64), dtype=np.int64)
    step = 1 << 15  # shingles whose bits are spread out at once
    h = xxh64_spans(data, starts[a], ends[b] - starts[a])
    for at in range(0, len(doc), step):
        own = doc[at : at + step]
        cuts = np.flatnonzero(np.r_[True, np.diff(own) > 0])
        spread = np.unpackbits(h[at : at + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits[own[cuts]] += np.add.reduceat(spread, cuts, axis=0, dtype=np.uint32)
    set_bits = 2 * bits > shingles[:, None]
    out[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(simhashes(utf8(batch.column("__text")), width).view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, fp long")


@functools.cache
def _offsets(radius: int) -> list[tuple[int, ...]]:
    return [x for x in itertools.product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, x)) <= radius]


def around(cell: int, radius: int = RADIUS) -> list[int]:
    """Cells that can hold a fingerprint within the radius of one in ``cell``, itself included."""
    own = [cell // 17**k % 17 for k in range(PARTS)]
    moved = ([a + b for a, b in zip(own, step)] for step in _offsets(radius))
    return [sum(y * 17**k for k, y in enumerate(x)) for x in moved if all(0 <= y <= 16 for y in x)]


def is_home(one: tuple[int, int], other: tuple[int, int]) -> bool:
    """Whether ``one`` of two tiles is where the pair is compared: a coin for each pair, so that every tile is home to half of its pairs."""
    low, high = sorted((one, other))
    return one == other or (one == low) == bool(zlib.crc32(np.array([*low, *high], dtype=np.int64).tobytes()) & 1)


def forest_edges(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between a's and b's fingerprints."""
    hits = np.empty((len(a), len(b)), dtype=bool)
    step = max(1, (1 << 19) // max(1, len(b)))
    for at in range(0, len(a), step):
        hits[at : at + step] = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
    rows, cols = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
    if len(rows) == 0:
        return a[:0], b[:0]
    hits = hits[np.ix_(rows, cols)]
    n = int(hits.sum())
    if n <= 2 * (len(rows) + len(cols)):
        i, j = np.nonzero(hits)
        return a[rows[i]], b[cols[j]]
    nodes = np.concatenate([a[rows], b[cols]])
    # least label spreads over the links; dense groups are settled in a few rounds
    left, right = np.arange(len(rows)), np.full(len(cols), len(rows))
    while True:
        new_right = np.where(hits, left[:, None], len(rows)).min(axis=0)
        new_left = np.minimum(left, np.where(hits, new_right[None, :], len(rows)).min(axis=1))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    label = np.concatenate([left, right])
    return nodes, nodes[label]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) over distinct fingerprints ``fp`` that connect just what the links connect."""
    spark = distinct.sparkSession
    if radius > 16:
        raise ValueError("the radius is at most 16")
    cell = sum(F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(65535).cast("long"))).cast("int") * 17**k for k in range(PARTS))
    placed = distinct.select("fp", cell.alias("cell"))
    # at most 17 ** 4 rows, whatever the input
    tiles = {r.cell: -(-r.n // tile) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = spark.sparkContext.broadcast(tiles)
    sizes = spark.createDataFrame(list(tiles.items()) or [(0, 1)], "cell int, n int")
    packed = placed.join(F.broadcast(sizes), "cell").groupBy("cell", F.pmod(F.xxhash64("fp"), "n").cast("int").alias("tile")).agg(F.collect_list("fp").alias("fps"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_tiles = shared.value
        for batch in batches:
            cells, nos, fps = batch.column("cell").to_pylist(), batch.column("tile").to_pylist(), batch.column("fps")
            for i, (c, t) in enumerate(zip(cells, nos)):
                homes = [(o, k) for o in around(c, radius) for k in range(n_tiles.get(o, 0)) if is_home((o, k), (c, t))]
                for at in range(0, len(homes), 256):
                    part = homes[at : at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int32()), pa.array([x != (c, t) for x in part], pa.bool_()), pa.array([fps[i].values.to_numpy(zero_copy_only=False).tobytes()] * len(part), pa.binary())],
                        names=["cell", "tile", "other", "fps"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, forest = None, np.zeros(0, dtype=np.uint64), Forest()
        for batch in batches:
            found = []
            for c, t, other, data in zip(*(batch.column(x).to_pylist() for x in ("cell", "tile", "other", "fps"))):
                fps = np.frombuffer(data, dtype=np.uint64)
                if (c, t) != key:
                    assert not other, "a tile comes before what it is compared with"
                    key, home, forest = (c, t), fps, Forest()
                u, v = forest_edges(home, fps, radius)
                found += [(a, b) for a, b in zip(u.view(np.int64).tolist(), v.view(np.int64).tolist()) if a != b and forest.join(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    dealt = packed.mapInArrow(deal, "cell int, tile int, other boolean, fps binary")
    return dealt.repartition("cell", "tile").sortWithinPartitions("cell", "tile", "other").mapInArrow(compare, "u long, v long")


def near_groups(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Groups of documents whose SimHash fingerprints lie within ``radius`` bits, chained.

    docs: doc_id, text; other columns are ignored. A-Z become lower case, words
    are runs of anything but ASCII white space, shingles are ``width`` words
    joined by a space, repeats counted; fewer words are one shingle. A bit of
    the fingerprint is set if it is in over half the shingles' XXH64 (seed 42).
    Null, empty and blank texts have fingerprint zero, which links like any
    other. Gives for each row, repeated rows too: doc_id, fingerprint (16 hex
    digits), component_id (the smallest doc_id it reaches, its own included).
    A null doc_id counts only where a component has no other; then component_id
    is null. An empty table gives an empty one.
    """
    prints = written(fingerprints(docs, width), "simhashes")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    nodes = written(distinct, "distinct")
    roots = connected(links(nodes.select("fp"), radius, tile))
    labelled = written(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")), "labelled")
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    by_print = written(join_sized(labelled, ids, ["root"], "nodes", labelled.count()).select("fp", "rows", "component_id"), "by-print")
    joined = join_sized(prints, by_print, ["fp"], "rows", prints.count())
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group, that of the smallest doc_id, with all its columns. Rows without doc_id stay."""
    keep = near_groups(docs).where("doc_id = component_id").select(F.col("doc_id").alias("__fh_keep")).distinct()
    named = docs.where("doc_id is not null")
    return named.join(keep, named["doc_id"] == keep["__fh_keep"], "left_semi").select(*docs.columns).unionByName(docs.where("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))

