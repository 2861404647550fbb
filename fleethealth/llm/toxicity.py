"""Toxicity by weak supervision.

Words and word stems that go with the label, found by a test that allows for
the number of candidates, form lexicons: a voter for words and one for stems, at
each level of purity. Pattern voters look at shouting, masked words, address and
the like; two voters stand for clean text. A generative label model estimates
from the votes on all documents, labelled or not, how accurate each voter is and
which voters are correlated beyond the label; labels are its first guess and no
vote. Its posterior labels train a linear classifier over the words and stems,
which scores every whole text.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleethealth.llm.common import slices, table, utf8, written
from fleethealth.llm.near_copies import shingle_sets

#: Labelled rows that lexicons and classifier are learnt from, those of the lowest hash of doc_id.
FIT_LABELLED = 20_000
STEMS = (3, 4, 5, 6, 7, 8)
#: A feature is used if the share of labelled rows among those that hold it is above one of these, two standard errors
#: allowed for. Which one, the labelled rows that no feature is chosen on decide.
PURITIES = (0.5, 0.6, 0.7, 0.8, 0.9)
THRESHOLD = 0.3
REMEMBERED = 150_000
#: Features that a task counts before it passes them on.
COUNTED = 50_000
#: Share of a stem's toxic rows that one word or longer stem may have.
ONE_WORD = 0.8
ABSTAIN, CLEAN, TOXIC = 0, 1, 2

_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = {
    "shouting": re.compile(r"(?:\b[^\W\d_a-z]{3,}\b[^\w\n]*){4,}"),
    "exclaiming": re.compile(r"[!?]{3,}"),
    "masked": re.compile(r"\b[^\W\d_]+[*@#$]{2,}[^\W\d_]*"),
    "address": re.compile(r"\b(?:you are|you're|du bist|tu es|eres|vous êtes)\b", re.IGNORECASE),
}


def features(word: str) -> list[tuple[int, str]]:
    """The word, as kind 0, and its proper stems, the stem's length being their kind."""
    return [(0, word), *((n, word[:n]) for n in STEMS if len(word) > n)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class LabelModel:
    """Votes given the label, for groups of voters; voters of one group are correlated and have one table together."""

    groups: list[tuple[int, ...]] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)  # 2 x 3 ** voters
    prior: float = 0.0
    correlations: dict[tuple[int, int], float] = field(default_factory=dict)

    @staticmethod
    def _codes(votes: np.ndarray, group: tuple[int, ...]) -> np.ndarray:
        return sum(votes[:, v].astype(np.int64) * 3**k for k, v in enumerate(group))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for group, t in zip(self.groups, self.tables):
            c = self._codes(votes, group)
            odds += np.log(t[1, c]) - np.log(t[0, c])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))

    def accuracies(self) -> dict[int, float]:
        """Of each voter, the share of right votes among those that it casts."""
        out = {}
        for group, t in zip(self.groups, self.tables):
            for k, v in enumerate(group):
                digit = np.arange(t.shape[1]) // 3**k % 3
                right = self.prior * t[1, digit == TOXIC].sum() + (1 - self.prior) * t[0, digit == CLEAN].sum()
                cast = right + self.prior * t[1, digit == CLEAN].sum() + (1 - self.prior) * t[0, digit == TOXIC].sum()
                out[v] = float(right / max(cast, 1e-12))
        return out

    def _em(self, votes: np.ndarray, p: np.ndarray, rounds: int, times: np.ndarray) -> np.ndarray:
        for _ in range(rounds):
            self.prior = float(np.clip(np.average(p, weights=times), 1e-4, 1 - 1e-4))
            self.tables = []
            for group in self.groups:
                c, size = self._codes(votes, group), 3 ** len(group)
                t = np.stack([np.bincount(c, weights=w, minlength=size) for w in (times * (1 - p), times * p)]) + 0.5 / size
                self.tables.append(t / t.sum(axis=1, keepdims=True))
            new = self.posterior(votes)
            if np.abs(new - p).max() < 1e-4:
                return new
            p = new
        return p

    @staticmethod
    def beyond_label(cast: np.ndarray, start: np.ndarray, times: np.ndarray, rounds: int = 100) -> np.ndarray:
        """How far voters (columns of -1, 0, 1; rows that stand for as many as ``times`` says) correlate beyond what the label explains.

        If the label alone made voters agree, their covariances would be products
        of one number for each voter. These are fitted by least absolute
        deviations, which a few correlated pairs don't bend; what is left over is
        returned, in units of the voters' deviations.
        """
        share = times / times.sum()
        centred = cast - share @ cast
        cov = (centred * share[:, None]).T @ centred
        dev = np.sqrt(np.diag(cov)) + 1e-9
        guess = start - share @ start
        v = centred.T @ (share * guess) / (np.sqrt(share @ guess**2) + 1e-9)
        off = ~np.eye(len(cov), dtype=bool)
        for _ in range(rounds):
            w = np.where(off, 1 / np.maximum(np.abs(cov - np.outer(v, v)), 1e-6), 0.0)
            v = 0.5 * v + 0.5 * ((w * cov) @ v) / np.maximum(w @ v**2, 1e-12)
        return np.where(off, cov - np.outer(v, v), 0.0) / dev[:, None] / dev[None, :]

    @classmethod
    def fit(cls, votes: np.ndarray, start: np.ndarray, times: np.ndarray | None = None, strong: float = 0.15, most: int = 6, rounds: int = 50) -> tuple[LabelModel, np.ndarray]:
        """votes: rows x voters of ABSTAIN, CLEAN, TOXIC; start: a first guess of the posterior, which says what toxic is; times: how many documents voted like a row."""
        m = votes.shape[1]
        times = np.ones(len(votes)) if times is None else np.asarray(times, dtype=float)
        model = cls(groups=[(v,) for v in range(m)])
        corr = model.beyond_label((votes == TOXIC).astype(float) - (votes == CLEAN), start, times)
        member = {v: (v,) for v in range(m)}
        for a, b in sorted(itertools.combinations(range(m), 2), key=lambda x: -abs(corr[x])):
            if abs(corr[a, b]) < strong:
                break
            model.correlations[a, b] = float(corr[a, b])
            if member[a] != member[b] and len(member[a]) + len(member[b]) <= most:
                joint = tuple(sorted(member[a] + member[b]))
                for v in joint:
                    member[v] = joint
        model.groups = sorted(set(member.values()))
        return model, model._em(votes, start, rounds, times)


def logistic(rows: list[np.ndarray], n_features: int, target: np.ndarray, l2: float = 1e-3, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept for rows of feature numbers and soft targets, by accelerated gradient steps."""
    sizes = np.array([len(x) for x in rows], dtype=np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    n = max(1, len(rows))
    w, b = np.zeros(n_features), float(np.log((target.sum() + 0.5) / ((1 - target).sum() + 0.5)))
    mw, mb = w.copy(), b
    gw, gb = np.full(n_features, 1e-8), 1e-8
    for k in range(rounds):
        z = np.bincount(row, weights=w[flat], minlength=len(rows)) + b
        e = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - target
        dw, db = np.bincount(flat, weights=e[row], minlength=n_features) / n + l2 * w / n_features, e.mean()
        gw += dw**2
        gb += db**2
        w, b = w - 0.5 * dw / np.sqrt(gw), b - 0.5 * db / np.sqrt(gb)
        mw, mb = mw + (w - mw) / (1 + min(k, 50)), mb + (b - mb) / (1 + min(k, 50))
    return mw, mb


@dataclass(frozen=True)
class Classifier:
    weights: dict[tuple[int, str], int]
    w: np.ndarray
    b: float
    label_model: LabelModel
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def scores(self, texts: list[str]) -> np.ndarray:
        known = self.known
        of = self.weights.get
        hits = []
        for text in texts:
            found: set[int] = set()
            for x in words_of(text):
                own = known.get(x)
                if own is None:
                    own = tuple(i for f in features(x) if (i := of(f)) is not None)
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[x] = own
                if own:
                    found.update(own)
            hits.append(sorted(found))
        return self.scores_of(hits)

    def scores_of(self, hits: list[list[int]]) -> np.ndarray:
        """Scores of documents whose features' numbers are known."""
        z = np.array([self.b + float(self.w[x].sum()) if x else self.b for x in hits])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that labels may be learnt from. Of a doc_id that is labelled twice the higher label counts."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """(doc_id, text, toxic, checks): the labelled rows that are learnt from, of ``labelled`` doc_ids at most; a fifth of the rows checks.

    Rows are dealt to learning and checking by their least five-word shingle,
    and of rows that share it, copies and near copies, one stays: a label that
    is repeated with its text is no more evidence than once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chosen = _marked(docs, labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")  # ``labelled`` ids at most

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            h, n = shingle_sets(utf8(batch.column("text")))
            first = np.where(n > 0, np.append(h, np.uint64(0))[np.cumsum(n) - n], np.uint64(0))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "toxic", "text")), pa.array(first.view(np.int64))], names=["doc_id", "toxic", "text", "least"])

    marked = written(rows.mapInArrow(of, "doc_id long, toxic int, text string, least long"), "toxicity-labelled")
    stays = marked.groupBy("least").agg(F.min("doc_id").alias("doc_id"))
    checks = F.pmod(F.xxhash64("least"), F.lit(5)) == 0
    return marked.join(stays, ["least", "doc_id"], "left_semi").dropDuplicates(["doc_id", "least"]).select("doc_id", "text", "toxic", checks.alias("checks"))


def _mine(rows: DataFrame) -> list[tuple[int, str, float]]:
    """Words and stems that go with the label more often than chance explains, the strongest first, with the lower bound of their purity."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: Counter = Counter()
        toxic: Counter = Counter()

        def counted() -> pa.RecordBatch:
            keys = list(both)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()), pa.array([x for _, x in keys], pa.string()), pa.array([both[f] for f in keys], pa.int64()), pa.array([toxic[f] for f in keys], pa.int64())],
                names=["kind", "feature", "n", "n_toxic"],
            )
            both.clear()
            toxic.clear()
            return out

        for batch in slices(batches, "text"):
            for text, y in zip(utf8(batch.column("text")), batch.column("toxic").to_pylist()):
                own = {f for x in words_of(bytes(text).decode("utf-8")) for f in features(x)}
                both.update(own)
                if y:
                    toxic.update(own)
                if len(both) >= COUNTED:
                    yield counted()
        yield counted()

    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")).first()
    if not total.n or not total.toxic or total.toxic == total.n:
        return []
    rate = total.toxic / total.n
    candidates = Observation("candidates")
    grouped = rows.mapInArrow(count, "kind int, feature string, n long, n_toxic long").groupBy("kind", "feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("k"))
    counted = written(grouped.observe(candidates, F.count(F.lit(1)).alias("n")).where("k >= 3"), "features")
    xlog = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    evidence = 2 * (xlog(k, n * rate) + xlog(n - k, n * (1 - rate)))
    needed = 2 * float(np.log(max(1, candidates.get["n"]))) + 2
    low = (k + 2 - 2 * F.sqrt(k * (n - k) / n + 1)) / (n + 4)  # Wilson's bound
    best = counted.withColumns({"evidence": evidence, "low": low}).where((F.col("low") > max(PURITIES[0], 2 * rate)) & (F.col("evidence") > needed)).orderBy(F.desc("evidence"), "kind", "feature").collect()  # of the sample's words
    return [(r.kind, r.feature, r.low) for r in _own_evidence(best)]


def _own_evidence(found: list) -> list:
    """Drops stems whose toxic rows nearly all come from one longer stem or word that is found as well: these say nothing about other words."""
    most: dict[str, int] = {}
    for r in found:
        for n in STEMS:
            if n < len(r.feature):
                most[r.feature[:n]] = max(r.k, most.get(r.feature[:n], 0))
        if r.kind == 0 and len(r.feature) in STEMS:
            most[r.feature] = max(r.k, most.get(r.feature, 0))
    return [r for r in found if r.kind == 0 or most.get(r.feature, 0) < ONE_WORD * r.k]


LEVELS = len(PURITIES)
#: A document's votes are the bits of one number, in this order; that no lexicon votes is a vote as well.
VOTERS = [*(f"{kind}_{p}" for kind in ("words", "stems") for p in PURITIES), *_PATTERNS, "hardly_found"]


def _observed(rows: DataFrame, chosen: list[tuple[int, str, float]], *more: str) -> DataFrame:
    """For each row its features' numbers (hits) and its votes, with doc_id and the columns ``more``."""
    index = {(kind, x): i for i, (kind, x, _) in enumerate(chosen)}
    bits = [1 << ((kind > 0) * LEVELS + sum(low > p for p in PURITIES) - 1) for kind, _, low in chosen]
    shared = rows.sparkSession.sparkContext.broadcast((index, bits))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bits = shared.value
        get, known = numbers.get, {}
        for batch in slices(batches, "__text"):
            hits, votes = [], []
            for text in utf8(batch.column("__text")):
                text = bytes(text).decode("utf-8")
                words = words_of(text)
                found: set[int] = set()
                for x in words:
                    own = known.get(x)
                    if own is None:
                        own = tuple(i for f in features(x) if (i := get(f)) is not None)
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[x] = own
                    if own:
                        found.update(own)
                said = 0
                for i in found:
                    said |= bits[i]
                for k, pattern in enumerate(_PATTERNS.values()):
                    if pattern.search(text):
                        said |= 1 << 2 * LEVELS + k
                if len(found) * 200 <= len(words):
                    said |= 1 << len(VOTERS) - 1
                hits.append(sorted(found))
                votes.append(said)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(hits, pa.list_(pa.int32())), pa.array(votes, pa.int32()), *(batch.column(c) for c in more)], names=["doc_id", "hits", "votes", *more])

    kinds = dict(rows.dtypes)
    own = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("__text"), *more)
    return own.mapInArrow(of, ", ".join(["doc_id long, hits array<int>, votes int", *(f"{c} {kinds[c]}" for c in more)]))


def votes_of(said: np.ndarray, purity: float) -> np.ndarray:
    """Rows x voters of ABSTAIN, CLEAN, TOXIC; lexicons of a lower purity abstain, and the last voter says clean where no lexicon speaks."""
    bit = (said[:, None] >> np.arange(len(VOTERS)) & 1).astype(bool)
    bit[:, [k for k in range(2 * LEVELS) if PURITIES[k % LEVELS] < purity]] = False
    out = np.where(bit, TOXIC, ABSTAIN).astype(np.int8)
    out[:, -1] = np.where(bit[:, -1], CLEAN, ABSTAIN)
    nothing = np.where(bit[:, : 2 * LEVELS].any(axis=1), ABSTAIN, CLEAN)
    return np.concatenate([out, nothing[:, None].astype(np.int8)], axis=1)


def _labels(said: np.ndarray, times: np.ndarray, marked: np.ndarray, toxic: np.ndarray, purity: float) -> tuple[LabelModel, dict[int, float]]:
    """The label model, and the posterior for each combination of votes.

    said: the combinations; times: documents of each; marked, toxic: labelled ones and those of them labelled toxic.
    """
    votes = votes_of(said, purity)
    guess = np.where(votes[:, -1] == CLEAN, 0.05, 0.6)
    model, posterior = LabelModel.fit(votes, (toxic + 2 * guess) / (marked + 2), times)
    return model, dict(zip(said.tolist(), posterior.tolist()))


def _linear(seen: list, chosen: list[tuple[int, str, float]], posterior: dict[int, float], purity: float) -> tuple[np.ndarray, float]:
    """Classifier of the sampled rows, by posterior labels, over features of the purity."""
    used = np.array([low > purity for _, _, low in chosen], dtype=bool)
    hits = [h[used[h]] for h in (np.asarray(r.hits, dtype=np.int64) for r in seen)]
    w, b = logistic(hits, len(chosen), np.array([posterior[r.votes] for r in seen]))
    return np.where(used, w, 0.0), b


def _seen(rows: DataFrame) -> list:
    """The sample's observations, in an order of their own, so that fits repeat."""
    return sorted(rows.collect(), key=lambda r: (r.votes, r.hits, r.toxic, r.checks))  # FIT_LABELLED ids


def _purity(rows: DataFrame) -> float:
    """The limit of PURITIES by which a model of four fifths of the sample labels the rest best, the strictest of equals."""
    chosen = _mine(rows.where("not checks"))
    seen = _seen(_observed(rows, chosen, "toxic", "checks")) if chosen else []
    learn, check = [r for r in seen if not r.checks], [r for r in seen if r.checks]
    if not learn or not check:
        return PURITIES[0]
    said, place = np.unique([r.votes for r in learn], return_inverse=True)
    times, toxic = np.bincount(place), np.bincount(place, weights=[float(r.toxic > 0) for r in learn])
    true = np.array([r.toxic > 0 for r in check])
    best, limit = -1.0, PURITIES[0]
    for p in PURITIES:
        if not any(low > p for _, _, low in chosen):
            break
        _, posterior = _labels(said, times, times, toxic, p)
        w, b = _linear(learn, chosen, posterior, p)
        say = np.array([w[r.hits].sum() + b >= np.log(THRESHOLD / (1 - THRESHOLD)) for r in check])
        f1 = 2 * float((say & true).sum()) / max(1, int(say.sum() + true.sum()))
        if f1 >= best:
            best, limit = f1, p
    return limit


def _fitted(docs: DataFrame, labels: DataFrame, labelled: int) -> tuple[Classifier, DataFrame | None]:
    """The classifier, and each row's hits and votes (doc_id, hits, votes)."""
    rows = written(sample(docs, labels, labelled), "toxicity-sample")
    chosen = _mine(rows)
    if not chosen:
        rate = rows.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0] or 0.0
        rate = min(max(rate, 0.001), 0.999)
        return Classifier({}, np.zeros(0), float(np.log(rate / (1 - rate))), LabelModel(prior=rate)), None
    purity = _purity(rows)
    votes = written(_observed(docs, chosen), "toxicity-votes")
    marked = _marked(docs, labels).select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    told = votes.where(~held_out(F.col("doc_id"))).join(marked, "doc_id", "left").groupBy("votes").agg(F.count(F.lit(1)).alias("times"), F.count("toxic").alias("marked"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    said, times, known, toxic = (np.array(x) for x in zip(*sorted(tuple(r) for r in told.collect())))  # at most 2 ** len(VOTERS) rows, whatever the input
    model, posterior = _labels(said, times, known, toxic, purity)
    w, b = _linear(_seen(_observed(rows, chosen, "toxic", "checks")), chosen, posterior, purity)
    return Classifier({(kind, x): i for i, (kind, x, _) in enumerate(chosen)}, w, b, model), votes


def fit(docs: DataFrame, labels: DataFrame, labelled: int = FIT_LABELLED) -> Classifier:
    """Lexicons and classifier are learnt from ``labelled`` labelled rows at most, the label model from the votes on all rows.

    The driver holds the sample's features' numbers and a count for each combination of votes, and no texts.
    """
    return _fitted(docs, labels, labelled)[0]


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, score and predicted for each row.

    docs: doc_id, text; other columns are ignored. Null and empty texts get the
    score of a text without any word. Repeated rows come out as often; a null
    doc_id stays null. Without labels, or with labels of one kind only, every
    score is the labels' rate, within 0.001 and 0.999.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            yield _result(batch.column("__id"), shared.value.scores([bytes(x).decode("utf-8") for x in utf8(batch.column("__text"))]))

    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text")).mapInArrow(of, RESULT)


RESULT = "doc_id long, score double, predicted int"


def _result(ids: pa.Array, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])


def fitted_scores(docs: DataFrame, labels: DataFrame, labelled: int = FIT_LABELLED) -> DataFrame:
    """What ``scored`` gives by a model of the same docs; the words that the label model's votes have found are not looked for again."""
    model, votes = _fitted(docs, labels, labelled)
    if votes is None:
        return scored(docs, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _result(batch.column("doc_id"), shared.value.scores_of(batch.column("hits").to_pylist()))

    return votes.select("doc_id", "hits").mapInArrow(of, RESULT)


def accepted(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = shared.value.scores([bytes(x).decode("utf-8") for x in utf8(batch.column("text"))])
            yield batch.filter(pa.array([x < threshold for x in score], pa.bool_()))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(of, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fitted_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
