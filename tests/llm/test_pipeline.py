"""The corpus pipeline: stages one by one, and as a whole."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import decontaminate, secret_scan
from tests.llm import cases
from tests.llm.test_near_dedup import brute
from tests.llm.test_text_models import check_pieces

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def test_stages_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]


def test_each_stage_on_odd_documents(spark):
    docs = cases.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, cases.empty(spark), SF).count() == 0
    assert STAGES["packing"](spark, cases.empty(spark), SF).count() == 0


def test_language_stage_rejects_only_what_has_no_language(spark):
    docs = cases.documents(spark)
    got = STAGES["language_id"](spark, docs, SF).collect()
    want = [r for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in want)
    assert all(r["lang"] for r in got)


def test_language_stage_corrects_labels_it_is_sure_of(spark):
    """A wrong label of a learned language goes, a label that nothing was
    learned of stays, and no clean document is lost."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang, some = F.col("lang"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 40
    other = F.when(lang == "en", "de").otherwise("en")
    docs = docs.withColumn("truth", lang)
    odd = docs.withColumn("lang", F.when(some == 2, other).when(some == 6, "xx").when(some == 10, None).otherwise(lang))
    got = STAGES["language_id"](spark, odd, SF).select("doc_id", "lang", "truth", some.alias("some")).collect()
    assert len(got) == docs.filter(F.col("text").rlike(r"\p{L}")).count()
    assert {r["lang"] for r in got if r["some"] == 6} == {"xx"}
    for kind in (2, 10):
        right = [r["lang"] == r["truth"] for r in got if r["some"] == kind]
        assert len(right) > 10 and sum(right) / len(right) > 0.9


def test_run_against_brute_force(spark):
    docs = cases.real_documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    found = brute(texts.items(), 5, 80)
    kept = {d: t for d, t in texts.items() if found[d][1] == d}
    grams = lambda t: {tuple(w[i:i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)}
    items = [grams(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    percent = decontaminate.PERCENT
    clean = {d: t for d, t in kept.items() if not any(g and len(g & grams(t)) * 100 >= percent * len(g) for g in items)}
    clean = {d: secret_scan.masked(t, secret_scan.find(t)) for d, t in clean.items()}
    want = spark.createDataFrame(list(clean.items()), "doc_id bigint, text string")
    assert public_tokenizers.path(corpus_pipeline.TOKENIZER)
    check_pieces(want, corpus_pipeline.run(spark, SF), 2048)
