import random

import corpus_pipeline
import numpy as np
import pytest

from fleethealth.llm import components, near_copies, simhash
from fleethealth.llm.common import LOWER


def brute_set(text, width=5):
    words = (text or "").encode().translate(LOWER).split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_kept(rows):
    sets = [brute_set(t) for _, t in rows]
    holders = {}
    for k, s in enumerate(sets):
        for x in s or {b""}:
            holders.setdefault(x, []).append(k)
    forest = components.Forest()
    for i, j in {(a, b) for v in holders.values() for a in v for b in v if a < b}:
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            forest.join(i, j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[forest.root(k)] = min(i, least.get(forest.root(k), i))
    return sorted(i for k, (i, _) in enumerate(rows) if least[forest.root(k)] == i)


def planted():
    """Copies with a few replaced words, pairs just above and below 0.8, and a dense group; 3-bit links of op5's digest miss most."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(4000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    out = []
    for _ in range(60):
        base = text(rng.randrange(60, 400))
        copy = list(base)
        for _ in range(rng.randrange(1, 2 + len(base) // 40)):
            copy[rng.randrange(len(copy))] = "changed"
        out += [base, copy]
    for extra in (20, 26):  # 100 shingles of 120 and of 126
        base = text(104)
        out += [base, base + text(extra)]
    base = text(200)
    for _ in range(80):
        copy = list(base)
        copy[rng.randrange(200)] = rng.choice(words)
        out.append(copy)
    return [(k, " ".join(x)) for k, x in enumerate(out)]


@pytest.mark.parametrize("tile", [16, near_copies.TILE])
def test_planted_near_copies(spark, tile):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(r.doc_id for r in near_copies.deduplicated(df, tile).collect())
    assert got == brute_kept(rows)
    assert len(got) < simhash.deduplicated(df).count() - 20


def test_stage_takes_near_copies_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("trim(text) <> ''")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, None).collect())
    assert got == brute_kept(rows)


def test_odd_rows(odd, none):
    kept = near_copies.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {1, 2, 3} <= set(ids) and not {4, 5, 6} & set(ids) and None in ids
    assert near_copies.deduplicated(none).count() == 0


def test_recall_at_the_limit():
    """Sets of exactly 0.8."""
    rng = np.random.default_rng(1)
    for n in (9, 45, 900):
        c = n * 8 // 9
        caught = 0
        for _ in range(300):
            h = rng.integers(0, 2**64, 2 * n - c, dtype=np.uint64)
            sets = np.concatenate([np.sort(h[:n]), np.sort(h[n - c :])])
            a, b = (near_copies._majority(x, np.array([n, n])) for x in (sets, near_copies._again(sets)))
            k = np.array([n])
            caught += int(near_copies.near(a[:1], a[1:], b[:1], b[1:], k, k)[0, 0])
        assert caught >= 290
