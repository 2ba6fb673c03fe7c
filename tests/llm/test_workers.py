"""Workers without the package: the operators run in a process whose workers cannot import it."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # the driver's path only: workers start from the environment
from reviewlens.session import build_session
spark = build_session("workers", "local[2]", spark_sql_shuffle_partitions="2", spark_ui_enabled="false")
spark.sparkContext.setLogLevel("ERROR")

def importable(rows):
    import importlib.util
    yield importlib.util.find_spec("reviewlens") is not None
assert not any(spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect())

from pyspark.sql import functions as F
import reviewlens.llm.queries
from reviewlens.llm import (collocation, decontaminate, jaccard, langid, lines, mainhtml, mixing, negatives, passages, quality, tokens,
                            toxicity, urls)
from reviewlens.operators.extract import explode_blocks, pick, step
SF = {sf!r}
docs = spark.read.parquet(SF + "/documents.parquet").limit(60)
labels = spark.read.parquet(SF + "/labels.parquet")
pages = spark.read.parquet(SF + "/pages.parquet").limit(10)
items = spark.read.parquet(SF + "/benchmark.parquet")
known = docs.join(labels, "doc_id").withColumn("held", F.col("doc_id") % 4 == 0)
ran = {{
    "html": mainhtml.QUERIES["op1_html_main_text"](spark, SF),
    "passages": passages.remove_passages(docs),
    "mix": mixing.mix_sources(docs),
    "lines": lines.dedup_lines(docs),
    "quality": quality.QUERIES["op5_quality_rules"](spark, SF),
    "urls": urls.QUERIES["op6_url_filter"](spark, SF),
    "language": langid.identify(docs, langid.fit(docs)),
    "benchmark": decontaminate.search(docs, items),
    "jaccard": jaccard.jaccard_classes(docs),
    "tokens": tokens.QUERIES["op10_token_counts"](spark, SF),
    "negatives": negatives.QUERIES["op11_hard_negatives"](spark, SF),
    "toxicity": toxicity.score(docs, toxicity.fit(known)),
    "phrases": collocation.collocations(docs, least=3),
    "blocks": explode_blocks(pages, step("a"), {{"text": pick()}}, ("page_id",)),
}}
for name, df in ran.items():
    assert df.count() > 0, name
print("RAN", len(ran))
"""


def test_operators_run_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=str(REPO), sf="/root/testdata/sf0.001")
    (tmp_path / "run.py").write_text(script)
    (tmp_path / "empty").mkdir()
    done = subprocess.run(
        ["timeout", "500", sys.executable, str(tmp_path / "run.py")], cwd=tmp_path / "empty", env=env, capture_output=True, text=True
    )
    assert "RAN 14" in done.stdout, done.stderr[-3000:]
