import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleethealth.llm import components, exact_dedup, line_dedup, simhash
from tests.llm.conftest import TEXTS


def sql(small, text):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    cur = con.execute(text)
    return sorted(cur.fetchall()), [x[0] for x in cur.description]


@pytest.mark.parametrize("module", [exact_dedup, line_dedup])
def test_against_sql(spark, small, module):
    want, columns = sql(small, module.SQL)
    assert sorted(tuple(r) for r in module.query(spark, small).select(*columns).collect()) == want


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=300))
def test_polynomials_combine(a, b):
    a = a[: len(a) // 2 * 2]
    units = (len(b) + 1) // 2
    assert exact_dedup.polynomial(a + b) == exact_dedup.combine(exact_dedup.polynomial(a), exact_dedup.polynomial(b), units)


def test_long_polynomial_against_plain_arithmetic():
    data = np.random.default_rng(0).integers(0, 256, 70001).astype(np.uint8).tobytes()
    want = []
    for p, r in zip(exact_dedup.PRIMES, exact_dedup.BASES):
        x = 0
        for i in range(0, len(data) - 1, 2):
            x = (x * r + data[i] + 256 * data[i + 1]) % p
        want.append((x * r + data[-1]) % p)
    assert exact_dedup.polynomial(data) == tuple(want)


def test_chunk_table_gives_the_same_fingerprint(spark):
    data = bytes(range(256)) * 40 + b"odd"
    rows = [(1, k, data[a : a + 1000]) for k, a in enumerate(range(0, len(data), 1000))] + [(2, 0, None)]
    got = {r.doc_id: (r.n_bytes, r.fp) for r in exact_dedup.chunk_table_fingerprints(spark.createDataFrame(rows, "doc_id long, chunk_no int, data binary").repartition(3)).collect()}
    assert got == {1: (len(data), exact_dedup.key_of(exact_dedup.polynomial(data))), 2: (0, 0)}


def brute_groups(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_exact_groups_of_odd_rows(odd, none):
    assert sorted((tuple(r) for r in exact_dedup.exact_groups(odd).collect()), key=repr) == brute_groups(TEXTS)
    assert exact_dedup.exact_groups(none).count() == 0


def test_texts_of_one_fingerprint_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "polynomial", lambda data: (1, 1))
    texts = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc"), (5, "longer")]
    got = exact_dedup.exact_groups(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_groups(texts)


def test_exact_dedup_keeps_columns_and_one_row(odd, none):
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert len(got) == len({t or "" for _, t in TEXTS}) and {(6, TEXTS[0][1]), (5, " \n\t "), (4, "")} <= set(got)
    assert exact_dedup.deduplicated(none).count() == 0


def brute_lines(texts, least=10):
    clean = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in texts:
        for x in (t or "").split("\n"):
            if i is not None and len(clean(x)) >= least:
                holders[clean(x)].add(i)
    first = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or clean(x) not in first or first[clean(x)] == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def test_lines_of_odd_rows(odd, none):
    assert sorted((tuple(r) for r in line_dedup.deduplicated_lines(odd).collect()), key=repr) == brute_lines(TEXTS)
    assert line_dedup.deduplicated_lines(none).count() == 0


def test_lines_with_a_crowded_filter(spark, monkeypatch):
    """Nearly every line is suspected; the text still decides."""
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    monkeypatch.setattr(line_dedup, "filter_words", lambda n: 8)
    rng = random.Random(1)
    texts = [(i, "\n".join(f"line number {rng.randrange(400)}" for _ in range(20))) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in line_dedup.deduplicated_lines(df).collect()), key=repr) == brute_lines(texts)


def test_xxh64_of_spans():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 3000).astype(np.uint8).tobytes()
    at, n = rng.integers(0, 2500, 800), rng.integers(0, 200, 800)
    assert [int(x) for x in simhash.xxh64_spans(data, at, n)] == [xxhash.xxh64_intdigest(data[a : a + k], 42) for a, k in zip(at, n)]


def brute_print(text, width=3):
    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=3):
    u, inv = np.unique(np.array(prints, dtype=np.uint64), return_inverse=True)
    forest = components.Forest()
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i:] ^ u[i]) <= radius):
            forest.join(i, i + int(j))
    root = [forest.root(int(i)) for i in inv]
    least = {}
    for r, i in zip(root, ids):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in root]


def test_simhash_of_odd_rows(odd, none):
    prints = [brute_print(t) for _, t in TEXTS]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(TEXTS, prints, brute_components([i for i, _ in TEXTS], prints))]
    assert sorted((tuple(r) for r in simhash.near_groups(odd).collect()), key=repr) == sorted(want, key=repr)
    assert simhash.near_groups(none).count() == 0


def test_simhash_against_brute_force(spark, documents):
    got = simhash.near_groups(documents, tile=16).collect()
    prints = {r.doc_id: brute_print(r.text) for r in documents.collect()}
    ids = sorted(prints)
    want = dict(zip(ids, brute_components(ids, [prints[i] for i in ids])))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", want[i]) for i in ids}


def test_dense_and_chained_fingerprints(spark):
    """Thousands of links within a few tiles, and chains across them."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for b in base for _ in range(60)}
    chain = rng.getrandbits(64)
    for j in range(0, 60, 3):
        chain ^= 7 << j
        prints.add(chain)
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(4)
    roots = {r.node: r.root for r in components.connected(simhash.links(df, tile=32)).collect()}
    want = brute_components(signed, prints)
    label = defaultdict(set)
    for s, w in zip(signed, want):
        label[w].add(roots.get(s, s))
    assert all(len(v) == 1 for v in label.values()) and len({next(iter(v)) for v in label.values()}) == len(label)


def test_near_copies_go_and_columns_stay(odd):
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {1, 3} <= set(ids) and not {4, 5} & set(ids) and None in ids


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
def test_components(spark, edges):
    forest = components.Forest()
    for a, b in edges:
        forest.join(a, b)
    want = {(x, forest.root(x)) for e in edges for x in e if forest.root(x) != x}
    assert {tuple(r) for r in components.connected(spark.createDataFrame(edges or [(0, 0)], "u long, v long")).collect()} == want


def test_components_of_a_long_path_and_a_star(spark):
    n = 300
    path = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    star = spark.range(1000, 1500).select(F.col("id").alias("u"), F.lit(999).cast("long").alias("v"))
    got = {tuple(r) for r in components.connected(path.union(star).repartition(8)).collect()}
    assert got == {(i, 0) for i in range(1, n + 1)} | {(i, 999) for i in range(1000, 1500)}
