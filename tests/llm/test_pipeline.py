import corpus_pipeline as cp
import pytest
from ledgerfold.llm import decontaminate as dc
from pyspark.sql import functions as F

from tests.llm.test_near_dedup import brute
from tests.llm.test_text_filters import brute_lines
from ledgerfold.llm import line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(None, None, None, None, None), (None, "a b c d e f", "en", "src1", 11), (90001, "", "en", "src1", 0), (90002, None, "en", None, None), (0, "another text of the first id altogether", "en", "src1", 5), (90003, "very long text " * 20000, "en", "src2", 1)]
    return given.unionByName(spark.createDataFrame(extra, given.schema)).withColumn("kept", F.lit("clash")).withColumn("__n", F.lit(1))


def test_stages(spark, docs, tmp_path):
    for number, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if number < 4:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before, after = docs.collect(), out.collect()
        if name == "toxicity":
            gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert gone and not {i for i in gone if labels.get(i) == 0}
        elif name == "line_dedup":
            want = brute_lines([(r["doc_id"], r["source"], r["text"]) for r in before], line_dedup.RATIO, line_dedup.LEAST_PAGES)
            assert sorted((str(r["doc_id"]), str(r["text"])) for r in after) == sorted((str(i), str(t)) for i, _, _, t in want)
        elif name == "near_dedup":
            groups = brute([(r["doc_id"], r["text"]) for r in before])
            assert sorted(r["doc_id"] for r in after if r["doc_id"] is not None) == sorted(i for i, (_, c) in groups.items() if i == c)
            assert sum(r["doc_id"] is None for r in after) == 2
        elif name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            left = {r["doc_id"] for r in after}
            assert not any(t in (r["text"] or "") for r in after for t in items)
            assert {r["doc_id"] for r in before} - left == {r["doc_id"] for r in dc.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
        else:
            assert sum(r["doc_tokens"] for r in after if r["start"] == 0) == sum(r["length"] for r in after)
            assert sum(r["start"] == 0 for r in after) == len(before)
        docs = out


def test_run_and_query(spark):
    assert cp.run(spark, SF).count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
