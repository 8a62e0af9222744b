"""The pipeline, stage by stage, on a small table with planted cases."""
import corpus_pipeline
from tests.conftest import SF_SMALL


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    item = max((r.text for r in bench.collect()), key=lambda t: len(t.split()))
    first = docs.where("doc_id = 0").first()
    plants = spark.createDataFrame([
        (10_001, first.text, "en", "src1", len(first.text)),
        (10_002, f"Words of a plain kind stand here, as in any text. {item}", "en", "src1", 0),
        (10_003, item, "en", "src2", len(item)),
        (10_004, "JUNK!! WORDS!! " * 60, "en", "src2", 0),
        (10_005, None, None, None, None),
    ], docs.schema)
    folder = str(tmp_path)
    docs.unionByName(plants).write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")

    seen, df = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        df = corpus_pipeline.materialise(stage(spark, df, folder), f"test-{name}")
        seen[name] = df
        assert df.columns[:5] == docs.columns
    ids = {name: {r.doc_id for r in d.select("doc_id").collect()} for name, d in seen.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert 10_004 not in ids["quality"] and sum(d in ids["quality"] for d in good) >= 0.95 * len(good)
    assert 10_001 not in ids["near_dedup"] and (0 in ids["near_dedup"]) == (0 in ids["quality"])
    assert 10_003 not in ids["decontaminate"]
    cut = {r.doc_id: r for r in seen["decontaminate"].where("doc_id = 10002").collect()}
    assert all(item not in r.text and r.n_chars == len(r.text) for r in cut.values())
    before = {r.doc_id: r.text for r in seen["near_dedup"].collect()}
    hit = {r.doc_id for r in corpus_pipeline.decontaminate.report(seen["near_dedup"], bench).where("contaminated").collect()}
    assert all(r.text == before[r.doc_id] for r in seen["decontaminate"].collect() if r.doc_id not in hit)
    assert ids["mix"] <= ids["decontaminate"]
    counts = [r["count"] for r in seen["shard"].groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1 and seen["shard"].count() == seen["mix"].count()


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"] and out.count() > 0


def _through(spark, df, folder):
    for name, stage in corpus_pipeline.STAGES:
        before = df
        df = corpus_pipeline.materialise(stage(spark, df, folder), f"edge-{name}")
        own = [c for c in before.columns if c not in ("shard", "slot")]
        assert [c for c in df.columns if c not in ("shard", "slot")] == own, name
    return df


def test_stages_with_clashing_columns_nulls_and_repeated_rows(spark, edge):
    out = _through(spark, edge, SF_SMALL)
    assert out.columns[-2:] == ["shard", "slot"] and out.where("n_words <> 'clash'").isEmpty()
    assert 0 < out.count() and out.where("doc_id IS NOT NULL").select("doc_id").distinct().count() <= edge.count()


def test_stages_on_an_empty_table(spark, no_docs):
    assert _through(spark, no_docs, SF_SMALL).isEmpty()
