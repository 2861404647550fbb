"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash proposes and the sets decide. A fingerprint has 128 bits, as at 0.8 two
fingerprints differ in 15 % of their bits, which 64 bits don't tell well from
chance. Fingerprints are laid out in tiles by the number of shingles; tiles
whose sizes allow 0.8 are compared in full. What a tile pair links goes on as
groups, not as pairs, so dense groups stay linear in the tiles' size; each group
then meets with its texts' shingles, and links below 0.8 are dropped before
components are taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethealth.llm.common import LOWER, join_sized, slices, utf8, written
from fleethealth.llm.components import Forest, connected
from fleethealth.llm.simhash import is_home, xxh64_spans

WIDTH = 5
#: As numerator and denominator, so that exactly 0.8 counts.
SIMILAR = (4, 5)
#: Bits of 128, and of the first 64, in which two texts of that similarity differ at most: three and four deviations above the mean.
RADIUS, FIRST = 32, 22
#: Fingerprints and shingles in a tile, on average at most.
TILE, TILE_SHINGLES = 1 << 14, 1 << 22
#: Cells of sizes in a factor of 5 / 4; one more is compared, for rounding.
STEPS = 4


def shingle_sets(texts: list[bytes | memoryview], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles as rising 64-bit hashes, one text after the other, and how many it has.

    A-Z become lower case, words are runs of anything but ASCII white space;
    fewer than ``width`` words are one shingle, no word is none.
    """
    clean = [b" ".join(bytes(x).translate(LOWER).split()) for x in texts]
    words = np.array([x.count(b" ") + 1 if x else 0 for x in clean], dtype=np.int64)
    data = b" ".join(x for x in clean if x)
    if not data:
        return np.zeros(0, dtype=np.uint64), words
    gaps = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(data)]
    shingles = np.where(words > 0, np.maximum(1, words - width + 1), 0)
    doc = np.repeat(np.arange(len(words)), shingles)
    a = (np.cumsum(words) - words)[doc] + np.arange(len(doc)) - (np.cumsum(shingles) - shingles)[doc]
    b = a + np.minimum(width, words[doc]) - 1
    h = xxh64_spans(data, starts[a], ends[b] - starts[a])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
    return h[new], np.bincount(doc[new], minlength=len(words))


def _majority(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(counts)), counts)
    bits = np.zeros((len(counts), 64), dtype=np.int64)
    step = 1 << 15  # shingles whose bits are spread out at once
    for at in range(0, len(doc), step):
        own = doc[at : at + step]
        cuts = np.flatnonzero(np.r_[True, np.diff(own) > 0])
        spread = np.unpackbits(h[at : at + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits[own[cuts]] += np.add.reduceat(spread, cuts, axis=0, dtype=np.uint32)
    return np.packbits(2 * bits > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _again(h: np.ndarray) -> np.ndarray:
    """Other 64 bits from the same hashes."""
    with np.errstate(over="ignore"):
        h = (h + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def _nodes(h: np.ndarray, counts: np.ndarray) -> list[int]:
    """A number for each set of shingles."""
    ends = np.cumsum(counts)
    return [int.from_bytes(hashlib.blake2b(h[e - n : e].tobytes(), digest_size=8).digest(), "little", signed=True) for e, n in zip(ends.tolist(), counts.tolist())]


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, node (the set of shingles), n (how many) and the fingerprint's halves a and b."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", 1 << 20):
            h, n = shingle_sets(utf8(batch.column("__text")))
            halves = [pa.array(_majority(x, n).view(np.int64), pa.int64()) for x in (h, _again(h))]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(_nodes(h, n), pa.int64()), pa.array(n, pa.int64()), *halves], names=["doc_id", "node", "n", "a", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, node long, n long, a long, b long")


def near(a: np.ndarray, b: np.ndarray, a2: np.ndarray, b2: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether each of one tile (a, a2; n shingles) and each of another (b, b2; m) may be similar."""
    hits = np.bitwise_count(a[:, None] ^ b[None, :]) <= FIRST
    i, j = np.nonzero(hits)
    far = np.bitwise_count(a[i] ^ b[j]) + np.bitwise_count(a2[i] ^ b2[j]) > RADIUS
    far |= SIMILAR[1] * np.minimum(n[i], m[j]) < SIMILAR[0] * np.maximum(n[i], m[j])
    hits[i[far], j[far]] = False
    return hits


def linked(x: np.ndarray, y: np.ndarray | None) -> list[np.ndarray]:
    """Groups of a tile's columns (node, n, a, b), and another's, that links between the two connect; y is None for a tile with itself."""
    both = x if y is None else np.concatenate([x, y], axis=1)
    other, shift = (x, 0) if y is None else (y, x.shape[1])
    a, b = both[2].view(np.uint64), both[3].view(np.uint64)
    label = np.arange(both.shape[1])
    step = max(1, (1 << 19) // max(1, other.shape[1]))
    for at in range(0, x.shape[1], step):
        end = min(at + step, x.shape[1])
        hits = near(a[at:end], a[shift : shift + other.shape[1]], b[at:end], b[shift : shift + other.shape[1]], x[1, at:end], other[1])
        for i in np.flatnonzero(hits.any(axis=1)).tolist():
            found = label[np.flatnonzero(hits[i]) + shift]
            if (found != label[at + i]).any():
                old = np.unique(np.append(found, label[at + i]))
                label[np.isin(label, old)] = old[0]
    roots, inverse, counts = np.unique(label, return_inverse=True, return_counts=True)
    order = np.argsort(inverse, kind="stable")
    ends = np.cumsum(counts)
    return [both[:, order[e - c : e]] for e, c in zip(ends.tolist(), counts.tolist()) if c > 1]


def candidates(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """(part, node, a, b): groups of nodes that fingerprints link within a pair of tiles; a node may be in many."""
    spark = nodes.sparkSession
    placed = nodes.where("n > 0").select("node", "n", "a", "b", F.floor(F.log("n") / F.log(F.lit(SIMILAR[1] / SIMILAR[0])) * STEPS).cast("int").alias("cell"))
    # a few hundred rows, whatever the input: sizes on a logarithmic scale
    tiles = {r.cell: -(-r.n // max(1, min(tile, TILE_SHINGLES // r.most))) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("n").alias("most")).collect()}
    shared = spark.sparkContext.broadcast(tiles)
    sizes = spark.createDataFrame(list(tiles.items()) or [(0, 1)], "cell int, tiles int")
    packed = placed.join(F.broadcast(sizes), "cell").groupBy("cell", F.pmod(F.xxhash64("node"), "tiles").cast("int").alias("tile")).agg(F.collect_list(F.struct("node", "n", "a", "b")).alias("rows"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_tiles = shared.value
        for batch in batches:
            for i, (c, t) in enumerate(zip(batch.column("cell").to_pylist(), batch.column("tile").to_pylist())):
                rows = batch.column("rows")[i].values
                data = np.stack([rows.field(x).to_numpy(zero_copy_only=False) for x in ("node", "n", "a", "b")]).tobytes()
                homes = [(o, k) for o in range(c - STEPS - 1, c + STEPS + 2) for k in range(n_tiles.get(o, 0)) if is_home((o, k), (c, t))]
                for at in range(0, len(homes), 16):
                    part = homes[at : at + 16]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int32()), pa.array([x != (c, t) for x in part], pa.bool_()), pa.array([data] * len(part), pa.binary())],
                        names=["cell", "tile", "other", "data"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home = None, None
        for batch in batches:
            for c, t, other, data in zip(*(batch.column(x).to_pylist() for x in ("cell", "tile", "other")), batch.column("data")):
                rows = np.frombuffer(data.as_buffer(), dtype=np.int64).reshape(4, -1)
                if (c, t) != key:
                    assert not other, "a tile comes before what it is compared with"
                    key, home = (c, t), rows.copy()
                groups = linked(home, rows if other else None)
                if groups:
                    parts = np.repeat([int.from_bytes(hashlib.blake2b(g[0].tobytes(), digest_size=8).digest(), "little", signed=True) for g in groups], [g.shape[1] for g in groups])
                    found = np.concatenate(groups, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (parts, found[0], found[2], found[3])], names=["part", "node", "a", "b"])

    dealt = packed.mapInArrow(deal, "cell int, tile int, other boolean, data binary")
    return dealt.repartition("cell", "tile").sortWithinPartitions("cell", "tile", "other").mapInArrow(compare, "part long, node long, a long, b long")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, as rising arrays, have the Jaccard similarity or more."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return SIMILAR[1] * common >= SIMILAR[0] * (len(x) + len(y) - common)


def _checked(rows: list[tuple[int, int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the true links among a group's (node, a, b, set)."""
    rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: r[0])
    a, b = (np.array([r[k] for r in rows], dtype=np.int64).view(np.uint64) for k in (1, 2))
    n = np.array([len(r[3]) for r in rows])
    forest, out = Forest(), []
    for i in range(1, len(rows)):
        for j in np.flatnonzero(near(a[i : i + 1], a[:i], b[i : i + 1], b[:i], n[i : i + 1], n[:i])[0]).tolist():
            if forest.root(i) != forest.root(j) and similar(rows[i][3], rows[j][3]):
                forest.join(i, j)
                out.append((rows[i][0], rows[j][0]))
    return out


def links(docs: DataFrame, nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """Edges (u, v) over nodes that connect just what pairs of near fingerprints and enough common shingles connect."""
    found = written(candidates(nodes, tile), "near-candidates")
    wanted = found.select("node").distinct()
    keys = nodes.join(wanted, "node", "left_semi").select(_key("least").alias("__fh_key")).distinct()
    texts = docs.select(_key("doc_id").alias("__fh_key"), F.col("text").cast("string").alias("__text")).join(keys, "__fh_key", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", 1 << 20):
            h, n = shingle_sets(utf8(batch.column("__text")))
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([pa.array(_nodes(h, n), pa.int64()), pa.array([h[e - k : e].tobytes() for e, k in zip(ends.tolist(), n.tolist())], pa.binary())], names=["node", "shingles"])

    held = texts.select("__text").mapInArrow(sets, "node long, shingles binary").join(wanted, "node", "left_semi").dropDuplicates(["node"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []

        def done() -> pa.RecordBatch:
            edges = _checked(rows)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in edges], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            for p, node, a, b, data in zip(*(batch.column(x).to_pylist() for x in ("part", "node", "a", "b", "shingles"))):
                if p != part:
                    yield done()
                    part, rows = p, []
                rows.append((node, a, b, np.frombuffer(data, dtype=np.uint64)))
        yield done()

    return found.join(held, "node").select("part", "node", "a", "b", "shingles").repartition("part").sortWithinPartitions("part").mapInArrow(check, "u long, v long")


def deduplicated(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """One document of each group of near copies, chained, that of the smallest doc_id, with all its columns.

    Equal sets of shingles are near copies, so null, empty and blank texts are
    one group. Rows without doc_id stay, and link others. Of repeated doc_ids
    all rows stay if one of them is its group's smallest. An empty table gives
    an empty one.
    """
    prints = written(fingerprints(docs), "near-prints")
    nodes = written(prints.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("a").alias("a"), F.min("b").alias("b")), "near-nodes")
    roots = connected(links(docs, nodes, tile))
    labelled = written(nodes.join(roots, "node", "left").select("node", "least", "rows", F.coalesce("root", "node").alias("root")), "near-labelled")
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    by_node = written(join_sized(labelled, ids, ["root"], "nodes", labelled.count()).select("node", "rows", "component_id"), "by-node")
    joined = join_sized(prints.where("doc_id is not null"), by_node, ["node"], "rows", prints.count())
    stays = joined.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    gone = stays.where("not stays").select(F.col("doc_id").alias("__fh_gone"))
    return docs.join(gone, F.col("doc_id").cast("long") == gone["__fh_gone"], "left_anti").select(*docs.columns)
