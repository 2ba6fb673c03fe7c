import corpus_pipeline
from reviewlens.llm.langid import UNDETERMINED, op7_language_id
from reviewlens.llm.mixing import mix_sources

from .test_decontaminate import brute as contaminated
from .test_jaccard import brute as components
from .test_lines import brute as lines

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    told = {r.doc_id for r in op7_language_id(spark, SF).collect() if r.lang_pred != UNDETERMINED}
    kept = [r for r in rows if r[0] in told]
    texts = [(i, t) for i, t, _, _ in lines([r[:2] for r in kept])]
    alone = {i for i, _, c in components(texts) if i == c}
    texts = [x for x in texts if x[0] in alone]
    clean = {r[0] for r in contaminated(texts, items) if not r[5]}
    text = dict(texts)
    left = [(i, text[i], lang, source, len(text[i])) for i, _, lang, source, _ in kept if i in clean]
    assert 0 < len(left) < len(rows)
    want = {tuple(r) for r in mix_sources(spark.createDataFrame(left, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)).collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
