"""The named queries: against SQL where there is some, else for their columns and rows; the pipeline."""

import oracle
import pytest

import corpus_pipeline
from tidefeed.llm.catalogue import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SMALL), con, ORACLES[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_a_row_for_each_row(spark, name):
    table = "pages" if "url" in name else "documents"
    rows = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert QUERIES[name](spark, SMALL).count() == rows


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against what its operator says of the stage's own input."""
    from tidefeed.llm import decontam, jaccard, linedup

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{number}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        seen.append((before, docs))
        if number < 4:
            assert docs.columns == columns
    toxic, lines, copies, clean, encoded = seen
    assert toxic[1].join(toxic[0], columns).count() == toxic[1].count() < toxic[0].count()
    texts = {r.doc_id: r.text for r in linedup.dedup_lines(lines[0]).collect()}
    assert {r.doc_id: r.text for r in lines[1].collect()} == texts
    first = jaccard.similar_documents(copies[0]).where("doc_id = component_id")
    assert {r.doc_id for r in copies[1].collect()} == {r.doc_id for r in first.collect()}
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    flagged = decontam.decontaminate(clean[0], items, ["doc_id"]).where("contaminated")
    assert {r.doc_id for r in clean[0].collect()} - {r.doc_id for r in clean[1].collect()} == {
        r.doc_id for r in flagged.collect()
    }
    assert encoded[1].where("round_trip").count() == encoded[0].count()
    whole = corpus_pipeline.run(spark, SMALL)
    assert {tuple(r.digests) for r in whole.collect()} == {tuple(r.digests) for r in encoded[1].collect()}


def test_stages_on_messy_rows(spark, rows):
    """NULL and empty texts, repeated and missing ids, a long text, no column n_chars and more columns, no rows."""
    line = "a line of more than forty characters that many documents share"
    texts = [(1, None), (2, ""), (3, "plain words only here"), (3, "other plain words"), (None, "no id at all"), (4, "w " * 30000)]
    texts += [(10 + i, f"{line}\nown words of number {i} and {i * 7}") for i in range(6)]
    docs = rows("doc_id long, text string, lang string, toxic string, n_hit int", *[(i, t, "en", "x", 1) for i, t in texts])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns and stage(spark, docs.limit(0), SMALL).count() == 0
        assert {r.doc_id for r in kept.where("text is null or length(text) < 30").collect()} >= {1, 2, 3, None}
        assert kept.count() == docs.count()  # nothing of this is toxic, contaminated or a near copy
    lines = corpus_pipeline.line_dedup_stage(spark, docs, SMALL)
    assert [r.doc_id for r in lines.where(f"text like '{line}%'").collect()] == [15]
    pieces = corpus_pipeline.sentencepiece_stage(spark, docs, SMALL)
    assert pieces.count() == docs.count() and pieces.where("round_trip").count() == docs.count()
