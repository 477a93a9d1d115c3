"""Pipeline: every stage against a brute-force version of its decision."""

import corpus_pipeline
from llm_cases import SF, docs, edge_rows
from test_near import contaminated_brute_force, near_brute_force

from txlake.llm import quality
from txlake.llm.common import table, written


def test_stages_against_brute_force(spark):
    frame = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    kept = {r.doc_id for r in quality.score_quality(frame, labels).where("predicted = 1").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in frame.collect()]
        out = written(stage(spark, frame, SF), f"test_{name}")
        ids = {r.doc_id for r in out.collect()}
        if name == "quality":
            assert ids == kept
        elif name == "near_dedup":
            assert ids == {d for d, _, _, stays in near_brute_force(before, 5) if stays}
        elif name == "decontamination":
            assert ids == {d for d, _ in before} - {d for d, *_ in contaminated_brute_force(before, items)}
        else:
            assert ids == {d for d, _ in before}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == frame.columns
        frame = out
    final = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert final == {tuple(r) for r in frame.collect()}


def test_stages_take_edge_rows(spark):
    for rows in ([r if len(r) == 3 else (*r, "s1") for r in edge_rows()], []):
        frame = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            frame = written(stage(spark, frame, SF), "test_edge")
        left = [r.doc_id for r in frame.collect() if r.doc_id is not None]
        assert len(left) == len(set(left)) <= len(rows)
