import hashlib
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleethealth.llm import byte_bpe, language_id, packing, syncmers, token_counts, tokens, toxicity
from tests.llm.conftest import TEXTS, rows_of

MULTI = public_tokenizers.path(byte_bpe.VOCABULARY)
ALPHABET = "aaabeet  \n\t'sÃ©éüß你мир12!?😀\xa0"


@pytest.fixture(scope="module")
def multi():
    return tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.ranks(MULTI), special_tokens={})


# byte-level BPE


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=80))
def test_bpe_against_tiktoken(multi, text):
    ids = byte_bpe.encode(text, MULTI)
    assert ids.tolist() == multi.encode_ordinary(text)
    assert byte_bpe.decode(ids, MULTI) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000, "\n" * 1500, "=" * 2000, "你好" * 700])
def test_bpe_of_long_pieces(multi, text):
    assert byte_bpe.encode(text, MULTI).tolist() == multi.encode_ordinary(text)


def test_pairs_against_plain_merging():
    voc = byte_bpe.vocabulary(MULTI)
    rng = random.Random(2)
    ids = sorted(voc.bytes_of)
    for a, b in [(rng.choice(ids), rng.choice(ids)) for _ in range(3000)] + [voc.halves[i] for i in rng.sample(ids, 500) if voc.halves[i]]:
        assert voc.joins(a, b) == (voc._merged(voc.bytes_of[a] + voc.bytes_of[b]) == [a, b])


def test_prefixes_append_and_replace():
    voc = byte_bpe.vocabulary(MULTI)
    p = byte_bpe.Prefixes(voc, b"internat")
    p.append(b"ionalisation")
    assert p.ids() == byte_bpe.Prefixes(voc, b"internationalisation").ids()
    p.replace(5, 8, b"ference")
    assert p.data == b"interferenceionalisation" and p.ids() == byte_bpe.Prefixes(voc, p.data).ids()


def test_bpe_of_odd_rows(odd, none, multi):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.round_trip(odd).collect()), key=repr)
    want = []
    for i, t in TEXTS:
        ids = np.array(multi.encode_ordinary(t or ""), dtype="<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert byte_bpe.round_trip(none).count() == 0
    back = byte_bpe.decoded(byte_bpe.encoded(odd))
    assert sorted(((r.doc_id, bytes(r.data)) for r in back.collect()), key=repr) == sorted(((i, (t or "").encode()) for i, t in TEXTS), key=repr)


# token counts


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=90), st.lists(st.tuples(st.integers(0, 95), st.integers(0, 30), st.text(alphabet=ALPHABET, max_size=8)), max_size=5))
def test_counts_follow_edits(text, edits):
    count = token_counts.counter(public_tokenizers.path(token_counts.VOCABULARY))
    doc = token_counts.Document(text, count)
    for at, n, new in edits:
        s = min(at, len(text))
        e = min(at + n, len(text)) if at + n > s else s
        text = text[:s] + new + text[e:]
        doc.edit(at, at + n, new)
        assert doc.text == text
        assert [x for b in doc.blocks for x in b[0]] == [len(x) for x in count.split(text)]
        assert doc.tokens() == len(count.encode(text))
        assert doc.prefix_tokens(len(text)) == doc.tokens()


def test_few_code_points_are_counted_again():
    count = token_counts.counter(public_tokenizers.path(token_counts.VOCABULARY))
    doc = token_counts.Document("some words and more of them " * 5000, count)
    doc.edit(70000, 70004, "other")
    assert doc.recounted < 40 and doc.tokens() == len(count.encode(doc.text))


def sums_hold(doc):
    """Whether each node of the tree is the sum of the blocks below it."""
    leaves = [(sum(a), sum(b)) for a, b in doc.blocks] + [(0, 0)] * (doc.size - len(doc.blocks))
    sums = [(0, 0)] * doc.size + leaves
    for i in range(doc.size - 1, 0, -1):
        sums[i] = sums[2 * i][0] + sums[2 * i + 1][0], sums[2 * i][1] + sums[2 * i + 1][1]
    return sums == doc.tree


def test_edits_over_many_blocks_correct_sums():
    count = token_counts.counter(public_tokenizers.path(token_counts.VOCABULARY))
    text = "some words and more of them, 12 or 345; " * 800
    doc, rng = token_counts.Document(text, count), np.random.default_rng(5)
    for _ in range(150):
        at, n = int(rng.integers(0, len(text) + 1)), int(rng.choice([0, 3, 40, 2500]))
        new = "new parts, " * int(rng.choice([0, 1, 7, 150]))
        text = text[:at] + new + text[at + n :]
        doc.edit(at, at + n, new)
        assert doc.text == text and sums_hold(doc)
        assert doc.tokens() == len(count.encode(text))
        cut = int(rng.integers(0, len(text) + 1))
        ends = np.cumsum([len(x) for x in count.split(text)])
        assert doc.prefix_tokens(cut) == sum(map(count, count.split(text)[: int((ends <= cut).sum())]))
    doc.edit(0, len(text), "")
    assert doc.tokens() == 0 and sums_hold(doc)
    doc.edit(0, 0, "again")
    assert doc.tokens() == len(count.encode("again"))


def test_few_trees_are_built():
    count = token_counts.counter(public_tokenizers.path(token_counts.VOCABULARY))
    doc = token_counts.Document("some words " * 5000, count)
    for _ in range(1000):
        doc.edit(30000, 30000, " more")
    assert doc.builds <= 1 + 1000 // ((token_counts.FULL - 1) * token_counts.BLOCK) + 1
    doc.edit(10000, 40000, "")
    doc.edit(0, 0, "x")
    assert doc.tokens() == len(count.encode(doc.text)) and sums_hold(doc)


def test_counts_of_odd_rows(odd, none):
    enc = tokens.encoder(public_tokenizers.path(token_counts.VOCABULARY))
    want = []
    for i, t in TEXTS:
        text = t or ""
        n = len(enc.encode_ordinary(text))
        for s, e, new in token_counts.sample_edits(len(text), text):
            text = text[: min(s, len(text))] + new + text[min(e, len(text)) :]
        want.append((i, len(t or ""), n, hashlib.sha256(text.encode()).hexdigest(), len(enc.encode_ordinary(text))))
    got = [(r.doc_id, r.n_chars, r.n_tokens, r.edited_sha256, r.edited_tokens) for r in token_counts.counted(odd).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert token_counts.counted(none).count() == 0


# packing


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6))
def test_a_bin_is_as_full_as_can_be(counts):
    kind = packing.fullest(counts, 30)
    sums = {0}
    first = max(counts)
    for n, c in counts.items():
        for _ in range(c - (n == first)):
            sums |= {s + n for s in sums}
    assert sum(kind) == first + max(s for s in sums if s + first <= 30)
    assert all(kind.count(n) <= counts[n] for n in set(kind))
    left = dict(counts)
    for k, times in packing.plan(counts, 30):
        for n in k:
            left[n] -= times
    assert not any(left.values())


def check_packing(got, texts):
    tok = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = []
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, packing.END], dtype="<u4")
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by), sum(r.length for r in got)


def test_packing_of_odd_rows(odd, none):
    check_packing(packing.packed(odd).collect(), TEXTS)
    assert packing.packed(none).count() == 0


def test_packing_wastes_little(documents):
    n, total = check_packing(packing.packed(documents.repartition(4)).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    assert n <= total / 1024 * 1.03 + 2


def test_special_strings_are_encoded_as_the_library_does(spark):
    texts = [(1, "a <|endoftext|> b"), (2, "plain")]
    check_packing(packing.packed(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts)


# document fingerprints


def brute_syncmers(codes, k, s):
    with np.errstate(over="ignore"):
        out = []
        for i in range(len(codes) - k + 1):
            inner = [int(syncmers._window_hashes(codes[j : j + s], s)[0]) for j in range(i, i + k - s + 1)]
            if min(inner) in (inner[0], inner[-1]):
                out.append((int(syncmers._window_hashes(codes[i : i + k], k)[0]) >> 32, i))
    return out


def test_syncmers_against_brute_force(documents):
    for r in documents.limit(8).collect():
        codes = syncmers._codes((r.text or "")[:300].encode())
        if len(codes) >= syncmers.K:
            h, at = syncmers.syncmers(codes)
            assert list(zip(h.tolist(), at.tolist())) == brute_syncmers(codes, syncmers.K, syncmers.S)


def test_sketches_do_not_depend_on_blocks(monkeypatch):
    codes = syncmers._codes(("some text that goes on " * 40 + "and ends").encode())
    whole = syncmers.text_of(syncmers.sketch(codes))
    monkeypatch.setattr(syncmers, "BLOCK", 37)
    assert syncmers.text_of(syncmers.sketch(codes)) == whole
    assert syncmers.text_of(syncmers.parse(whole)) == whole


def test_likeness():
    a = syncmers.sketch(syncmers._codes(b"one two three four five six seven eight"))
    nothing = syncmers.sketch(syncmers._codes(b""))
    assert syncmers.likeness(a, a) == 1.0 and syncmers.likeness(nothing, nothing) == 1.0 and syncmers.likeness(a, nothing) == 0.0


def test_a_passage_is_found_in_long_texts():
    """Fifty words in common of texts of over 20,000 characters; places far apart and no anchors are coded too."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(5000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(50)
    a, b = (syncmers.sketch(syncmers._codes(f"{text(2000)} {passage} {text(2000 + k)}".encode())) for k in (0, 300))
    inside = syncmers.sketch(syncmers._codes(passage.encode()))[0]
    assert len(inside) > 50 and set(inside.tolist()) <= set(a[0].tolist()) & set(b[0].tolist())
    assert syncmers.likeness(a, b) >= 2 * len(inside) / (len(a[0]) + len(b[0]))
    gaps = np.array([1, 2, 3], dtype=np.uint64), np.array([0, 255, 10**10])
    for x in (a, gaps, syncmers.sketch(syncmers._codes(b""))):
        back = syncmers.parse(syncmers.text_of(x))
        assert back[0].tolist() == x[0].tolist() and back[1].tolist() == x[1].tolist()


def test_inserted_words_leave_texts_alike():
    """Eight words within a text split it into nine segments of different offsets."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(800)]
    base = [rng.choice(words) for _ in range(900)]
    more = list(base)
    for k in range(8):
        more.insert(50 + 103 * k, "inserted" + "x" * k)
    a, b = (syncmers.sketch(syncmers._codes(" ".join(x).encode())) for x in (base, more))
    assert syncmers.likeness(a, b) > 0.95 and syncmers.likeness(b, a) > 0.95
    swapped = syncmers.sketch(syncmers._codes(" ".join(base[450:] + base[:450]).encode()))
    assert 0.45 < syncmers.likeness(a, swapped) < 0.6


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=30))
def test_chains_against_brute_force(x, y):
    rows = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y):
            last, rows[j + 1] = rows[j + 1], last + 1 if a == b else max(rows[j + 1], rows[j])
    got = syncmers.chain(np.array(x, dtype=np.uint64), np.array(y, dtype=np.uint64))
    most = syncmers.MOST_PAIRS
    assert got <= rows[-1] and (got == rows[-1] or sum(x.count(b) for b in y) > most)
    syncmers.MOST_PAIRS = 10**9
    try:
        assert syncmers.chain(np.array(x, dtype=np.uint64), np.array(y, dtype=np.uint64)) == rows[-1]
    finally:
        syncmers.MOST_PAIRS = most


def edited_of(texts):
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edits_of_odd_rows(odd, none):
    got = syncmers.with_edits(odd).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == edited_of(TEXTS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert syncmers.with_edits(none).count() == 0


def test_edits_of_documents(documents):
    got = syncmers.with_edits(documents.repartition(5)).collect()
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == edited_of(texts)
    held = {r.doc_id: r.fingerprint for r in got}
    by = {}
    for i, t in texts:
        by.setdefault(t or "", set()).add(held[i])
    assert all(len(v) == 1 for v in by.values())
    long = [r for r in got if r.n_chars >= 200]
    assert sum(r.near_edited > r.near_next for r in long) / len(long) > 0.97
    alone = syncmers.with_edits(documents.limit(1)).collect()
    assert len(alone) == 1


# languages


def test_languages_of_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in language_id.query(spark, small).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r.held_out and r.lang_pred != "und"]
    assert len(got) == docs.count() and {i for i, r in got.items() if r.held_out} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_a_mixture_has_both_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language_id.fit(docs)
    text = {r.lang: r.t for r in docs.where("n_chars > 1500").groupBy("lang").agg(F.min("text").alias("t")).collect()}
    names, pi, chosen = model.identify([(text["en"][:1000] + " " + text["de"][:1000]).encode(), b"", b"12 34"])
    assert {model.names[j] for j in np.flatnonzero(chosen[0])} == {"de", "en"} and 0.3 < pi[0].max() < 0.7
    assert names[1:] == ["und", "und"] and not chosen[1:].any()


def test_languages_of_a_text_do_not_depend_on_others():
    """The second language is no gain over the first, and both others are; another text's gain doesn't decide whether they are tried."""
    n, low = 1000, 1e-6
    alone = np.array([[1, low, low]] * 100 + [[0.4, 1, low]] * 450 + [[0.4, low, 1]] * 450, dtype=np.float32)
    other = np.full((n, 3), low, dtype=np.float32)
    other[np.arange(n), np.arange(n) % 2] = 1.0
    pi, chosen = language_id.mixtures(alone, np.array([n]))
    both_pi, both = language_id.mixtures(np.concatenate([other, alone]), np.array([n, n]))
    assert chosen[0].all() and both.tolist() == [[True, True, False], [True] * 3]
    assert (pi[0] == both_pi[1]).all()


def some_languages(n=4):
    rng = np.random.default_rng(5)
    return language_id.Languages([f"l{i}" for i in range(n)], np.log(rng.dirichlet([0.05] * language_id.BUCKETS, n).T + 1e-9).astype(np.float32))


LONG = ["word " * 700, "x" * 3000, "ß É 你好。мир 😀 " * 200, "你好" * 900, "a b" + "c" * 500 + " d" * 300, " " * 2500, "12 34 " * 400]


@pytest.mark.parametrize("most", [7, 64, 1000])
def test_pieces_of_long_texts_are_the_text(most):
    """A long text in pieces has the words, trigrams and languages that it has as a whole, also beside other texts."""
    model, texts = some_languages(), [x.encode() for x in (*LONG, "", "a", "".join(LONG))]
    for text in texts:
        parts = list(language_id.pieces(text, most))
        assert b"".join(parts) == text
        whole, cut = language_id.words_of([text]), [language_id.words_of([x]) for x in parts]
        assert np.concatenate([x.buckets for x in cut]).tolist() == whole.buckets.tolist()
        assert sum(int(x.counts[0]) for x in cut) == whole.counts[0] == len(whole.starts)
    want, got = model.identify(texts), model.identify(texts, most)
    assert want[0] == got[0] and (want[1] == got[1]).all() and (want[2] == got[2]).all()


def test_memory_of_a_long_text():
    """What a long text needs beside itself is a row of numbers for each word, not for each letter."""
    model, text = some_languages(), b"seven letters a word, " * 400_000
    model.identify([b"a"])
    tracemalloc.start()
    model.identify([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * len(text)


def plain_mixture(likelihood, rounds=15):
    """Every set of languages, by expectation-maximisation written out word by word."""
    n, m = len(likelihood), len(likelihood[0])
    best = None
    for k in range(1, m + 1):
        for langs in itertools.combinations(range(m), k):
            pi = {j: 1 / k for j in langs}
            for _ in range(rounds):
                share = dict.fromkeys(langs, 0.0)
                for row in likelihood:
                    total = sum(pi[j] * row[j] for j in langs)
                    for j in langs:
                        share[j] += pi[j] * row[j] / total
                pi = {j: x / n for j, x in share.items()}
            score = sum(math.log(sum(pi[j] * row[j] for j in langs)) for row in likelihood) - (k - 1) * (0.5 * math.log(n + 1) + language_id.GAIN)
            if best is None or score > best[0] + 1e-6:
                best = score, langs, pi
    return best


@pytest.mark.parametrize("seed", range(12))
def test_mixtures_against_every_set(seed):
    rng = np.random.default_rng(seed)
    m, n = 4, int(rng.integers(5, 120))
    share = rng.dirichlet([0.4] * m)
    likelihood = np.exp(-rng.exponential(rng.uniform(1, 6), (n, m)))
    likelihood[np.arange(n), rng.choice(m, n, p=share)] = 1.0
    likelihood = likelihood.astype(np.float32)
    want_score, langs, want = plain_mixture(likelihood.astype(float).tolist())
    pi, chosen = language_id.mixture(likelihood)
    assert tuple(np.flatnonzero(chosen)) == langs
    assert np.allclose(pi[list(langs)], [want[j] for j in langs], atol=1e-3) and abs(pi.sum() - 1) < 1e-3


def test_training_rows_are_the_lowest_hashes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("lang"), F.concat(F.lit("t"), "id").alias("text"))
    got = {(r.lang, int(r.text[1:])) for r in language_id.training_rows(docs, 200).collect()}
    for lang in "ab":
        order = [r.doc_id for r in docs.where(F.col("lang") == lang).orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(language_id.HASHES)), "doc_id").limit(200).collect()]
        assert {i for x, i in got if x == lang} == set(order)


def test_languages_of_odd_rows(spark, odd, none):
    model = language_id.fit(odd)
    got = {(r.doc_id, r.lang_pred) for r in language_id.identified(odd, model).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (10, "en")} <= got
    assert language_id.identified(none, model).count() == 0
    blank = language_id.fit(none)
    assert {r.lang_pred for r in language_id.identified(odd, blank).collect()} == {"und"}
    kept = language_id.accepted(odd, model)
    assert kept.columns == odd.columns and {3, 4, 5}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.count() == len(TEXTS) - 3


# toxicity


@pytest.fixture(scope="module")
def marked(spark):
    """Documents of plain words; a tenth has insults with changing ends, and labels that are now and then wrong."""
    rng = random.Random(7)
    plain = ["".join(rng.choice("aeiou") + rng.choice("bcdfglmnprst") for _ in range(3)) for _ in range(300)]
    docs, labels = [], []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(40)]
        bad = rng.random() < 0.15
        if bad:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["nincompoop", "zzblock" + rng.choice(plain), "dunce"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad) if rng.random() > 0.02 else 1 - int(bad), int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, truth int")


def test_toxicity_of_held_out_documents(marked):
    docs, labels = marked
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.predicted for r in toxicity.scored(docs, model).collect()}
    truth = {r.doc_id: r.truth for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    hits = sum(got[i] and t for i, t in truth.items())
    assert hits / max(1, sum(got[i] for i in truth)) > 0.9 and hits / sum(truth.values()) > 0.9
    accuracy = model.label_model.accuracies()
    assert min(accuracy.values()) >= 0 and max(accuracy.values()) > 0.9


def test_label_model_finds_accuracies_and_correlation():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.3
    vote = lambda p: np.where(rng.random(6000) < p, y, ~y)
    a, b, c = vote(0.9), vote(0.8), vote(0.7)
    copy = np.where(rng.random(6000) < 0.9, c, ~c)
    votes = np.stack([np.where(x, toxicity.TOXIC, toxicity.CLEAN) for x in (a, b, c, copy)], axis=1).astype(np.int8)
    model, p = toxicity.LabelModel.fit(votes, np.where(a, 0.7, 0.2))
    assert (2, 3) in model.groups
    got = model.accuracies()
    assert abs(got[0] - 0.9) < 0.05 and abs(got[1] - 0.8) < 0.05 and abs(got[2] - 0.7) < 0.06
    assert ((p > 0.5) == y).mean() > 0.88


def plain_label_model(votes, start, groups, rounds):
    """Expectation-maximisation document by document, with a count for each group's joint votes."""
    p = list(start)
    for _ in range(rounds):
        prior = min(max(sum(p) / len(p), 1e-4), 1 - 1e-4)
        tables = []
        for g in groups:
            size = 3 ** len(g)
            held = [dict.fromkeys(itertools.product(range(3), repeat=len(g)), 0.5 / size) for _ in range(2)]
            for row, q in zip(votes, p):
                held[1][tuple(row[v] for v in g)] += q
                held[0][tuple(row[v] for v in g)] += 1 - q
            tables.append([{k: x / sum(t.values()) for k, x in t.items()} for t in held])
        p = []
        for row in votes:
            yes, no = prior, 1 - prior
            for g, t in zip(groups, tables):
                key = tuple(row[v] for v in g)
                yes, no = yes * t[1][key], no * t[0][key]
            p.append(yes / (yes + no))
    return p


@pytest.mark.parametrize("seed", range(4))
def test_label_model_against_plain_counting(seed):
    rng = np.random.default_rng(seed)
    y = rng.random(300) < 0.4
    votes = np.stack([np.where(rng.random(300) < 0.3, 0, np.where(rng.random(300) < q, y, ~y) + 1) for q in (0.9, 0.75, 0.7)], axis=1)
    votes = np.concatenate([votes, votes[:, 2:]], axis=1).astype(np.int8)  # the last voter copies the one before
    start = np.where(votes[:, 0] == 2, 0.7, 0.3)
    model, got = toxicity.LabelModel.fit(votes, start, rounds=8)
    assert (2, 3) in model.groups
    want = plain_label_model(votes.tolist(), start.tolist(), model.groups, 8)
    assert np.allclose(got, want, atol=2e-3)
    # documents that vote alike may be counted once
    rows, first, place, times = np.unique(np.concatenate([votes, (start > 0.5)[:, None]], axis=1), axis=0, return_index=True, return_inverse=True, return_counts=True)
    _, few = toxicity.LabelModel.fit(votes[first], start[first], times, rounds=8)
    assert np.allclose(few[place.ravel()], got, atol=1e-6)


def test_votes_are_the_bits():
    words_low, stems_high, shouting, hardly = 1 << 0, 1 << (2 * toxicity.LEVELS - 1), 1 << 2 * toxicity.LEVELS, 1 << (len(toxicity.VOTERS) - 1)
    said = np.array([words_low | shouting, stems_high, hardly])
    loose, strict = toxicity.votes_of(said, toxicity.PURITIES[0]), toxicity.votes_of(said, toxicity.PURITIES[-1])
    assert loose[0, 0] == toxicity.TOXIC and strict[0, 0] == toxicity.ABSTAIN and strict[0, -1] == toxicity.CLEAN and loose[0, -1] == toxicity.ABSTAIN
    assert strict[1, 2 * toxicity.LEVELS - 1] == toxicity.TOXIC and loose[0, 2 * toxicity.LEVELS] == toxicity.TOXIC
    assert loose[2, -2] == loose[2, -1] == toxicity.CLEAN and (loose[2, :-2] == toxicity.ABSTAIN).all()


def test_scores_do_not_depend_on_the_way(marked):
    """A text that is looked through again scores as by what the label model's votes found."""
    docs, labels = marked
    one = {r.doc_id: (round(r.score, 9), r.predicted) for r in toxicity.fitted_scores(docs, labels).collect()}
    two = {r.doc_id: (round(r.score, 9), r.predicted) for r in toxicity.scored(docs, toxicity.fit(docs, labels)).collect()}
    assert one == two and len(one) == 1500


def test_toxicity_of_odd_rows(spark, odd, none, marked):
    model = toxicity.fit(*marked)
    got = toxicity.scored(odd, model).collect()
    assert len(got) == len(TEXTS) and len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(none, model).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.scored(odd, toxicity.fit(odd, no_labels)).collect()} == {0}
    twice = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(odd, toxicity.fit(odd, twice)).count() == len(TEXTS)
    assert toxicity.accepted(odd, model).columns == odd.columns


def test_rows_helper():
    assert len(rows_of(TEXTS)[0]) == 11
