import corpus_pipeline
import pytest

from fleethealth.llm import language_id, toxicity
from fleethealth.llm.common import written
from tests.llm.conftest import TEXTS
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_text import check_packing


@pytest.fixture(scope="module")
def small():
    """A table with labels enough to learn from."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, small):
    """What each stage returns, written and read again."""
    out = [spark.read.parquet(f"{small}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], small), f"test-{name}"))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "exact_dedup", "simhash_near_dedup", "best_fit_packing"]


def test_filters_keep_columns_and_rows(spark, small, kept):
    before, clean, named = kept[:3]
    assert before.columns == clean.columns == named.columns == kept[3].columns == kept[4].columns
    assert set(texts(named)) <= set(texts(clean)) <= set(texts(before))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    there = {i for i, _ in texts(clean)}
    fine = [i for i, y in labels.items() if y == 0]
    assert sum(i in there for i in fine) / len(fine) > 0.97
    assert sum(i in there for i, y in labels.items() if y) < 0.6 * sum(labels.values())
    assert named.count() > 0.97 * clean.count()


def test_exact_stage(kept):
    last = {}
    for i, t in texts(kept[2]):
        last[t] = max(i, last.get(t, i))
    assert sorted(texts(kept[3])) == sorted((i, t) for t, i in last.items())


def test_near_stage(kept):
    """Near copies are texts whose five-word shingles have a Jaccard similarity of 0.8 or more, as the pipeline's contract has it, not op5's digests."""
    rows = sorted(texts(kept[3]))
    assert sorted(i for i, _ in texts(kept[4])) == brute_kept(rows)


def test_toxicity_stage_is_the_score(spark, small, kept):
    """A document goes just if its own score reaches the threshold."""
    score = {r.doc_id: r.score for r in toxicity.fitted_scores(kept[0], spark.read.parquet(f"{small}/labels.parquet")).collect()}
    assert sorted(i for i, _ in texts(kept[1])) == sorted(i for i, x in score.items() if x < toxicity.THRESHOLD)


def test_language_stage_is_the_largest_share(spark, small, kept):
    model = language_id.fit(spark.read.parquet(f"{small}/documents.parquet"))
    want = []
    for i, t in texts(kept[1]):
        names, pi, _ = model.identify([(t or "").encode()])
        if names[0] != "und" and pi[0].max() >= 0.5:
            want.append(i)
    assert sorted(i for i, _ in texts(kept[2])) == sorted(want)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_rows(spark, small, odd, none, name):
    """Nulls, empty and blank texts, repeated rows, clashing columns, and no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, small)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert stage(spark, none, small).count() == 0
    if name != "best_fit_packing":
        assert got.columns == odd.columns
    if name in ("toxicity", "best_fit_packing"):
        assert set(ids) == {i for i, _ in TEXTS}
    if name == "language_id":
        assert not {3, 4, 5} & set(ids)
    if name == "exact_dedup":
        assert len(ids) == len({t or "" for _, t in TEXTS})


def test_packing_stage(kept):
    check_packing(kept[5].collect(), texts(kept[4]))


def test_run_is_the_stages(spark, small, kept):
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, small).collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in kept[5].collect())
