import random

from llm_fixtures import documents, labels  # noqa: F401
import corpus_pipeline as pipeline
import pytest
from test_near_duplicates import brute as brute_links
from test_quality import clean, poor

import __spark_entry__ as contract
from checks.compare import compare, duck
from nightledger.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def folder(spark, documents, labels, tmp_path):
    pick = random.Random(8)
    rows = [(k, poor(pick) if k % 8 == 0 else clean(pick, pick.randrange(60, 200))) for k in range(300)]
    texts = dict(rows)
    rows += [(1000 + k, texts[k] + ("" if k % 2 else " ")) for k in (1, 3, 5)] + [(1000, texts[1].replace(" ", "\t"))]
    rows += [(2000, texts[7] + " more"), (3000, None), (3001, ""), (9, texts[9])]
    marks = [(k, int(k % 8 != 0), int(k % 10 == 1)) for k in range(0, 300)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels(marks).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage(spark, folder):
    sf_dir, rows = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality", "exact", "near", "mix", "pack"]
    kept = stages["quality"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    lost = set(ids(docs)) - set(ids(kept))
    assert len([k for k in lost if k % 8 == 0 and k < 300]) >= 36 and len([k for k in lost if k % 8]) <= 6
    one = stages["exact"](spark, docs, sf_dir)
    assert one.columns == docs.columns
    assert ids(one) == sorted({k for k, _ in rows} - {1000, 1001, 1003, 1005, 3001})
    near = stages["near"](spark, docs.dropDuplicates(["doc_id"]), sf_dir)
    assert ids(near) == sorted(r[0] for r in brute_links([*dict(rows).items()]) if r[3])
    mixed = stages["mix"](spark, docs, sf_dir)
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(ids(docs)) and mixed.count() > 150
    assert {r.doc_id for r in stages["pack"](spark, docs, sf_dir).collect()} == {k for k, _ in rows}


def test_run(spark, folder):
    sf_dir, _ = folder
    assert pipeline.run(spark, sf_dir).count() > 100
    assert set(pipeline.QUERIES) == {"pipeline"}


def test_an_empty_table(spark, folder, tmp_path):
    sf_dir, _ = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0, name


def test_registered():
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name, monkeypatch):
    import checks.compare as tool

    monkeypatch.setitem(tool.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(tool.ORACLE, name, ORACLE[name])
    assert compare(spark, duck(SF_DIR), name, SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_over_the_given_tables(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
