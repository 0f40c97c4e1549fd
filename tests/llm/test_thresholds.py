import corpus_pipeline as pipeline
from llm_fixtures import documents  # noqa: F401
from nightledger.llm.hyperminhash import BANDS, bands_for, near_duplicates


def test_the_pipeline_links_from_four_fifths_on(spark, documents):
    words = [f"word{k}" for k in range(200)]
    changed = [f"other{k}" if k in (30, 80, 130, 180) else w for k, w in enumerate(words)]
    assert 0.8 < (196 - 20) / (196 + 20) < 0.85
    far = [f"far{k}" if k in (20, 50, 80, 110, 150, 180) else w for k, w in enumerate(words)]
    docs = documents([(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(far)), (4, "quite another text")])
    assert sorted(r.doc_id for r in pipeline.near(spark, docs, "").collect()) == [1, 3, 4]
    assert sorted(r.doc_id for r in near_duplicates(docs).filter("kept").collect()) == [1, 2, 3, 4]


def test_bands_follow_the_threshold():
    assert BANDS == 26 and bands_for(0.80) == 39
    assert (1 - 0.8**5) ** 39 <= 2.5e-7 < (1 - 0.8**5) ** 38
