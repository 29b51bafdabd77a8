import corpus_pipeline
import test_decontaminate
import test_lines
import test_near
import test_toxicity
from pyspark.sql import functions as F

from waymark.llm.common import table
from waymark.llm.toxicity import fit_toxicity

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs)
        assert i == 4 or docs.columns == columns
    before, after = sorted(rows(kept[0]).items()), rows(kept[1])
    texts = test_lines.brute(before, 8)
    assert after == {k: new for (k, _), new in zip(before, texts, strict=True) if new.strip()}
    own = sorted(after.items())
    assert rows(kept[2]) == {own[g[0]][0]: own[g[0]][1] for g in test_near.brute(own)}
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    own = rows(kept[2])
    clean = rows(kept[3])
    grams = {x: set(test_decontaminate.bag(x.lower().replace(",", "").replace(".", "").split())) for x in items}
    for k, text in own.items():
        said = set(test_decontaminate.bag(text.lower().replace(",", "").replace(".", "").replace("\n", " ").split()))
        leaks = any(said & g and test_decontaminate.brute(text, x) >= 0.8 for x, g in grams.items())
        assert leaks == (k not in clean)
    assert {r.doc_id for r in kept[4].collect()} == set(clean)


def test_run_gives_the_stages_rows(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)

    def told(df):
        return {r.doc_id: (r.n, r.pieces and r.ids) for r in df.groupBy("doc_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces"), F.min("doc_tokens").alias("ids")).collect()}

    assert told(corpus_pipeline.run(spark, SF)) == told(docs) != {}


def test_columns_with_the_stages_working_names(spark):
    docs = table(spark, SF, "documents")
    named = docs.withColumns({c: F.lit(7) for c in ("_had", "_toxicity", "_matches", "_found", "row", "kept", "bucket", "matches", "toxicity")})
    for name, stage in corpus_pipeline.STAGES[:4]:
        got, plain = stage(spark, named, SF), stage(spark, docs, SF)
        assert got.columns == named.columns, name
        assert rows(got) == rows(plain), name
        assert got.where(" or ".join(f"{c} <> 7" for c in ("_had", "_toxicity", "_matches", "_found", "row", "kept", "bucket"))).count() == 0, name


def test_toxicity_stage_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = fit_toxicity(docs, table(spark, SF, "labels"))
    kept = rows(corpus_pipeline.toxicity(spark, docs, SF))
    assert kept == {k: t for k, t in rows(docs).items() if test_toxicity.brute_score(model, t) < corpus_pipeline.TOXIC}
