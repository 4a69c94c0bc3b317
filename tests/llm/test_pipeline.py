"""The pipeline's stages, each judged on what the stage before has kept."""

import brute
import corpus_pipeline
from pyspark.sql import functions as F

from txnguard.llm import queries, toxic
from txnguard.session import materialise

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, FOLDER))
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "mixture":
            assert docs.columns == before.columns
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if name == "toxicity":
            scored = toxic.score(before, queries.toxic_model(spark, FOLDER), spans=False)
            assert set(kept[name]) == {r.i for r in scored.where("score < 0.5").select(F.col("row.doc_id").alias("i")).collect()}
        elif name == "near_duplicates":
            assert set(kept[name]) == set(brute.near_classes(rows).values())
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            hits = brute.benchmark_hits(rows, items)
            assert set(kept[name]) == {i for i, _ in rows if not hits[i][4]} and len(kept[name]) < len(rows)
        elif name == "personal_data":
            assert set(kept[name]) == {i for i, _ in rows}
            for i, text in rows:
                new = kept[name][i]
                assert new.n_chars == len(new.text)
                assert not brute.personal(new.text)
                if not brute.personal(text):
                    assert new.text == text or "<" in new.text
        else:
            assert all(0 < r.taken <= 2 * r["size"] for r in kept[name].values())


def test_run_is_registered_and_repeats(spark):
    first = sorted((r.doc_id, r.taken) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert first and first == sorted((r.doc_id, r.taken) for r in corpus_pipeline.run(spark, FOLDER).collect())


def test_every_stage_on_odd_rows(spark, odd_docs, no_docs):
    """Nulls, repeated rows, names that clash with those of the plan, missing columns, no rows."""
    odd_docs = odd_docs.where("text IS NULL OR length(text) < 1000")  # long ones: see the tests of each operator
    clashing = odd_docs.withColumns({c: F.lit(1) for c in ("target", "taken", "repeats", "mix_size")})
    bare = odd_docs.select("doc_id", "text", "source")
    stages = dict(corpus_pipeline.STAGES)
    for docs, names in ((clashing, list(stages)), (bare, ["personal_data", "mixture"]), (no_docs, ["toxicity", "decontamination", "personal_data", "mixture"])):
        for name in names:
            stage = stages[name]
            after = materialise(stage(spark, docs, FOLDER))
            assert after.columns[: len(docs.columns)] == docs.columns
            assert after.count() <= docs.count()
            if name != "mixture":
                assert after.columns == docs.columns
    plan = corpus_pipeline.mixture(spark, clashing, FOLDER)
    assert plan.columns[len(clashing.columns) :] == ["mix_mix_size", "source_size", "mix_target", "mix_repeats", "extra", "mix_taken"]
    kept = {r.doc_id for r in plan.collect()}
    assert kept <= {r.doc_id for r in odd_docs.collect()} and 11 in kept
