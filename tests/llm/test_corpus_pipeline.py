import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import brute
from visitmap.llm.mixing import word_array
from visitmap.session import scratch_path

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = stages(spark, docs)
    for name in ("quality_rules", "near_duplicates", "personal_data", "source_mixing"):
        assert got[name].columns == docs.columns
    base = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in got["quality_rules"].collect()}
    for key, text in base.items():
        n, _, _, _, again = brute.counts(text)
        assert not (key in kept and (n < 20 or 100 * again > 30 * n))
    quality = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    clean = {k for k in quality & set(base) if brute.counts(base[k])[0] >= 20 and 100 * brute.counts(base[k])[4] <= 30 * brute.counts(base[k])[0]}
    assert len(clean & kept) >= 0.98 * len(clean)
    rows = [(k, base[k]) for k in sorted(kept)]
    assert sorted(r.doc_id for r in got["near_duplicates"].collect()) == sorted({c for _, _, c in brute.jaccard_components(rows, 5, 80)})
    masked = got["personal_data"].collect()
    assert len(masked) == got["near_duplicates"].count()
    for r in masked:
        assert not brute.personal_data(r.text) or not brute.personal_data(base[r.doc_id])
        assert r.n_chars == len(r.text)
    words = got["personal_data"].agg(F.sum(F.size(word_array(F.col("text"))))).first()[0]
    mixed = got["source_mixing"].agg(F.sum(F.size(word_array(F.col("text"))))).first()[0]
    assert words - got["personal_data"].select("source").distinct().count() <= mixed <= words
    last = got["bpe"]
    assert last.count() == got["source_mixing"].count() and last.where("n_tokens = 0 or octet_length(ids) != 4 * n_tokens").isEmpty()


def test_odd_and_empty_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, `row` int, spans int, kept int, ids int"
    text = " ".join(f"w{i}" for i in range(40)) + " x@y.com"
    rows = [(None, None, None, None, None, 1, 2, 3, 4), (1, "", None, None, 0, 1, 2, 3, 4), (None, text, "en", None, 0, 1, 2, 3, 4), (1, text, "en", "s", 0, 1, 2, 3, 4),
            (1, "v" * 50_000 + " " + text, None, "s", 0, 1, 2, 3, 4), (7, " ".join(f"z{i}" for i in range(40)), "en", "s", 0, 1, 2, 3, 4)]
    got = stages(spark, spark.createDataFrame(rows, schema))
    assert got["near_duplicates"].where("doc_id is null").isEmpty() and got["personal_data"].where("text like '%@%'").isEmpty()
    assert stages(spark, spark.createDataFrame([], schema))["bpe"].count() == 0


def test_what_goes_to_python_at_once_is_bounded(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        docs = spark.range(0, 20_000, 1, 1).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
        stage = corpus_pipeline.after_the_one_before(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long, bytes long"))
        got = stage(spark, docs, SF).collect()
        assert sum(r.n for r in got) == 20_000 and max(r.bytes for r in got) < 2 << 20
    finally:
        spark.conf.set(key, old)


def test_the_session_is_left_as_it_was(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "8m")
    try:
        spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.set(key, old)
