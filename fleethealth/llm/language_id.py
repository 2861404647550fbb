"""Language identification as a mixture of languages.

Each language is a table of letter-trigram probabilities. The words of a
document are drawn from a mixture of languages; expectation-maximisation
estimates the proportions from the words' likelihoods under each set of
languages, and the set of the highest likelihood less a penalty for its size is
the document's. The proportions within that set are the result.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleethealth.llm.common import slices, table, utf8

#: Documents that a language's table is learnt from: those of the lowest hash of doc_id.
FIT_PER_LANGUAGE = 4000
BUCKETS = 1 << 16
#: Bytes of a text that are looked at together; a longer text goes through in pieces.
PIECE = 1 << 20
ROUNDS = 15
#: A language beyond the first must gain half the logarithm of the words, and this.
GAIN = 3.0
#: Languages up to which all sets of them are tried.
EXACT = 6
TINY = np.float32(1e-30)
#: Values of the hash by which training rows are chosen.
HASHES = 1 << 40
UNDETERMINED = "und"


@functools.cache
def _symbols() -> np.ndarray:
    """For each code point its lower-case letter as one of 1 to 511, or 0 for what is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = ord(x.lower()[0])
            out[c] = low if low < 384 else 384 + low % 128
    return out


@dataclass(frozen=True)
class Words:
    """Trigram buckets of a batch of texts, one for each letter, the words' first letters, and words for each text."""

    buckets: np.ndarray
    starts: np.ndarray
    counts: np.ndarray


def _letters(text: str) -> np.ndarray:
    return _symbols()[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]


def pieces(text: bytes | memoryview, most: int = PIECE) -> Iterator[bytes | memoryview]:
    """The text in pieces of at most ``most`` bytes, or of one word that is longer; each but the last ends with a character that is no letter, so words and their trigrams stay whole."""
    at, end = 0, most
    while end < len(text):
        seen = bytes(text[at:end]).decode("utf-8", "ignore")  # a character that the end cuts is left to the next piece
        gaps = np.flatnonzero(_letters(seen) == 0)
        if len(gaps):
            cut = at + len(seen[: gaps[-1] + 1].encode("utf-8"))
            yield text[at:cut]
            at, end = cut, cut + most
        else:
            end += end - at
    yield text[at:]


def words_of(texts: list[bytes | memoryview]) -> Words:
    codes, counts = [], np.zeros(len(texts), dtype=np.int64)
    gap = np.zeros(1, dtype=np.uint32)
    for i, text in enumerate(texts):
        s = _letters(bytes(text).decode("utf-8"))
        codes += [gap, s]
        letter = s > 0
        counts[i] = int(letter[:1].sum()) + int((letter[1:] & ~letter[:-1]).sum())
    s = np.concatenate([gap, *codes, gap])
    at = np.flatnonzero(s)
    buckets = ((s[at - 1] * np.uint32(512) + s[at]) * np.uint32(512) + s[at + 1]) * np.uint32(2654435761) >> np.uint32(16)
    starts = np.flatnonzero(s[at - 1] == 0)
    return Words(buckets.astype(np.int64), starts, counts)


def proportions(likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation-maximisation from equal shares: each language's share of a document's words, and the log likelihood.

    A word's likelihoods over their mean under the shares are its share of each
    language, so a round is two products of the matrix with a vector.
    """
    n, m = likelihood.shape
    pi = np.full(m, 1 / m, dtype=likelihood.dtype)
    for _ in range(ROUNDS):
        pi *= (1 / (likelihood @ pi + TINY)) @ likelihood / n
    return pi, float(np.log(likelihood @ pi + TINY).sum(dtype=np.float64))


def mixture(likelihood: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in one document, and which are in its set.

    likelihood: for each word, one at least, of each language, scaled so that
    the largest is 1. The set is the one of the highest log likelihood less a
    penalty for each language beyond the first; the smaller set, then the
    languages that are first, at a tie. No set is likelier than all languages
    together, so sets that can't make up for their penalty aren't tried. Of up
    to EXACT languages all other sets are, of more those that add one language
    to the best set of one less.
    """
    n, m = likelihood.shape
    penalty = 0.5 * np.log(n + 1.0) + GAIN
    alone = np.log(likelihood + TINY).sum(axis=0, dtype=np.float64)
    chosen, shares = (int(alone.argmax()),), np.ones(1)
    best = float(alone[chosen[0]])
    everything = proportions(likelihood) if m > 1 else (shares, best)
    grown = chosen
    for k in range(2, m + 1):
        if everything[1] - (k - 1) * penalty <= best:
            break
        tried = []
        for langs in itertools.combinations(range(m), k) if m <= EXACT else [tuple(sorted((*grown, x))) for x in range(m) if x not in grown]:
            pi, fitted = everything if k == m else proportions(likelihood[:, langs])
            tried.append((fitted - (k - 1) * penalty, langs, pi))
        score, grown, pi = max(tried, key=lambda x: x[0])
        if score > best:
            best, chosen, shares = score, grown, pi
    out, member = np.zeros(m), np.zeros(m, dtype=bool)
    out[list(chosen)], member[list(chosen)] = shares, True
    return out, member


def mixtures(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mixture of each document; counts: words of each, in the order of likelihood's rows."""
    ends = np.cumsum(counts)
    found = [mixture(likelihood[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist())]
    return np.stack([x for x, _ in found]), np.stack([x for _, x in found])


def training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """The rows that languages are learnt from: at most ``per_language`` of each lang, by the hash of doc_id.

    Rows far above a lang's limit are left out before the rows of a lang meet,
    so a lang of a third of all rows brings no more of them than another.
    """
    own = docs.where("lang is not null and text is not null and doc_id is not null")
    hashed = own.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)).alias("hash"))
    share = F.least(F.lit(1.0), (per_language + 10 * float(np.sqrt(per_language)) + 50) / F.count(F.lit(1)))
    limits = F.broadcast(hashed.groupBy("lang").agg(F.ceil(share * HASHES).alias("limit")))  # a row a language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    ids = hashed.join(limits, "lang").where("hash < limit").withColumn("rank", rank).where(F.col("rank") <= per_language).select(F.col("doc_id").alias("__fit")).distinct()
    return own.join(F.broadcast(ids), own.doc_id == ids["__fit"], "left_semi").select("lang", "text")  # per_language rows a language


@dataclass(frozen=True)
class Languages:
    names: list[str]
    #: log probability of each bucket in each language, as BUCKETS x languages
    table: np.ndarray

    def likelihood(self, words: Words) -> np.ndarray:
        """For each word of each language, scaled so that the largest is 1."""
        if not len(words.starts):
            return np.zeros((0, len(self.names)), dtype=self.table.dtype)
        logs = np.add.reduceat(self.table[words.buckets], words.starts, axis=0)
        return np.exp(logs - logs.max(axis=1, keepdims=True))

    def identify(self, texts: list[bytes | memoryview], most: int = PIECE) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Name, proportions and set for each text.

        Of a text of over ``most`` bytes a row of numbers is held for each word, and of one piece all letters.
        """
        n = len(self.names)
        names = [UNDETERMINED] * len(texts)
        pi, chosen = np.zeros((len(texts), n)), np.zeros((len(texts), n), dtype=bool)
        if not n:
            return names, pi, chosen
        words = words_of([x if len(x) <= most else b"" for x in texts])
        full = np.flatnonzero(words.counts)
        if len(full):
            pi[full], chosen[full] = mixtures(self.likelihood(words), words.counts[full])
        for i in [i for i, x in enumerate(texts) if len(x) > most]:
            likelihood = np.concatenate([self.likelihood(words_of([x])) for x in pieces(texts[i], most)])
            if len(likelihood):
                pi[i], chosen[i] = mixture(likelihood)
        for i in np.flatnonzero(chosen.any(axis=1)).tolist():
            names[i] = self.names[int(pi[i].argmax())]
        return names, pi, chosen


def learn(rows: DataFrame) -> Languages:
    """Counts trigrams on the executors; a table of BUCKETS numbers for each language comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            langs = batch.column("lang").to_pylist()
            texts = utf8(batch.column("text"))
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == lang]
                for some in [[t for t in own if len(t) <= PIECE], *([x] for t in own if len(t) > PIECE for x in pieces(t))]:
                    now = np.bincount(words_of(some).buckets, minlength=BUCKETS)
                    held[lang] = held[lang] + now if lang in held else now
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([x.astype(np.int64).tobytes() for x in held.values()], pa.binary())], names=["lang", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                now = np.frombuffer(data, dtype=np.int64)
                held[lang] = held[lang] + now if lang in held else now
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["lang", "counts"])

    found = {r.lang: np.frombuffer(r.counts, dtype=np.int64) for r in rows.mapInArrow(count, "lang string, counts binary").repartition(F.col("lang")).mapInArrow(add, "lang string, counts binary").collect()}
    names = sorted(found)
    if not names:
        return Languages([], np.zeros((BUCKETS, 0), dtype=np.float32))
    # halfway to the trigrams of all languages, so that a rare language isn't ruled out by what it lacks
    every = sum(found.values()) + 0.1
    background = every / every.sum()
    logs = [np.log((found[x] + 50.0 * background) / (found[x].sum() + 50.0)) for x in names]
    return Languages(names, np.stack(logs, axis=1).astype(np.float32))


def identified(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, lang_pred, score and languages (map of the set's proportions) for each row.

    docs: doc_id, text; other columns are ignored. Texts that are null, empty or
    without a letter are ``und`` with score 0 and no languages, as is everything
    if nothing was learnt. Ties go to the language whose name is first. Repeated
    rows come out as often; a null doc_id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "__text", 1 << 20):
            names, pi, chosen = known.identify(utf8(batch.column("__text")))
            sets = [[(known.names[j], float(pi[i, j])) for j in np.flatnonzero(chosen[i]).tolist()] for i in range(len(names))]
            score = np.clip(pi.max(axis=1), 0, 1) if pi.shape[1] else np.zeros(len(names))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))], names=["doc_id", "lang_pred", "score", "languages"])

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, "doc_id long, lang_pred string, score double, languages map<string,double>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, per_language: int = FIT_PER_LANGUAGE) -> Languages:
    """Learns from text and lang of rows that aren't held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return learn(training_rows(docs.where(~held_out(F.col("doc_id"))), per_language))


def accepted(docs: DataFrame, model: Languages, least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose language is known and makes up ``least`` of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            names, pi, _ = shared.value.identify(utf8(batch.column("text")))
            keep = [x != UNDETERMINED and p >= least for x, p in zip(names, pi.max(axis=1) if pi.shape[1] else np.zeros(len(names)))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(of, docs.schema).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identified(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.array_join(F.array_sort(F.map_keys("languages")), ",").alias("languages"))
