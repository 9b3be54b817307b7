"""Each stage against a plain version on its own input."""
import corpus_pipeline
import plain
from cases import SF


def test_stages(spark, documents):
    docs = documents
    before = sorted(documents.columns)
    for name, stage in corpus_pipeline.STAGES:
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, SF)
        if name == "best_fit_packing":
            assert sorted(tuple(r)[:5] for r in out.collect()) == sorted(plain.pieces(rows))
            break
        assert sorted(out.columns) == before
        out = spark.createDataFrame(out.collect(), documents.schema)
        left = sorted(r["doc_id"] for r in out.collect())
        if name == "language_id":
            assert left == sorted(d for d, t in rows if any(c.isalpha() for c in t or ""))
        if name == "exact_dedup":
            assert left == sorted(c[0] for c in plain.copies(rows) if c[3])
        if name == "near_dedup":
            assert left == sorted(d for d, _, c in plain.near(rows) if d == c)
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert left == sorted(c[0] for c in plain.contaminated(rows, items) if not c[5])
        docs = out


def test_odd_rows_pass_every_stage(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            assert out.count() >= 0


def test_one_text_of_each_group_of_near_copies_stays(spark, odd, odd_rows):
    docs = odd.unionByName(odd.filter("doc_id is null or doc_id % 2 = 0").selectExpr("1L as doc_id", "concat(text, ' !') as text", *odd.columns[2:])).dropDuplicates(["doc_id", "text"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    component = plain.linked([plain.fingerprint(t) for _, t in rows])
    left = [component[plain.fingerprint(r["text"])] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()]
    assert sorted(left) == sorted(set(component.values()))


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
