"""The pipeline stage by stage on a small table, and the SQL of the line dedup."""

import corpus_pipeline
import __spark_entry__ as entry
from pyspark.sql import functions as F
from wardmill.llm import registry


def test_stages(spark, tmp_path):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, root)
        out.write.parquet(str(tmp_path / str(k)))
        left, docs = docs.count(), spark.read.parquet(str(tmp_path / str(k)))
        assert 0 < docs.count() <= left, name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_take_an_empty_table(spark):
    root = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{root}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, root).count() == 0


def test_documents_without_any_label_stay(spark, odd):
    docs = odd.withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.identify_language(spark, docs, "")
    lettered = [(r["doc_id"], r["text"]) for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))]
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(lettered, key=str)


def test_registered():
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(n.split("_")[0] for n in registry.QUERIES) == sorted(f"op{k}" for k in range(1, 14))


def odd_rows(spark):
    a = " ".join(f"a{k}" for k in range(60))
    near = a + " z"
    b = " ".join(f"b{k}" for k in range(60))
    data = [(7, a), (7, a), (None, a), (3, near), (5, b), (5, a), (None, None), (None, None), (8, ""), (8, "one two"), (8, "one two")]
    schema = "doc_id long, text string, ROW int, n string"
    return spark.createDataFrame([(*r, 1, "x") for r in data], schema)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_near_duplicates_go_row_by_row(spark):
    docs = odd_rows(spark)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    a, near, b = (docs.collect()[k]["text"] for k in (0, 3, 4))
    # One row of the group of near copies, whatever their ids; one of the repeated short rows; the rest stays.
    assert a != near
    assert pairs(out) == sorted([(3, near), (5, b), (None, None), (None, None), (8, ""), (8, "one two")], key=str)


def test_contaminated_rows_go_row_by_row(spark, tmp_path):
    docs = odd_rows(spark)
    item = docs.collect()[0]["text"]
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    b = docs.collect()[4]["text"]
    assert pairs(out) == sorted([(5, b), (None, None), (None, None), (8, ""), (8, "one two"), (8, "one two")], key=str)


def test_texts_in_no_language_go(spark):
    rows = [(k, "the cat and the dog sat there with them", "en") for k in range(0, 200, 2)]
    rows += [(k, "der hund und die katze sitzen dort mit ihnen", "de") for k in range(1, 200, 2)]
    rows += [(900, "12 34 !!", None), (901, None, "en"), (902, "the dog and the cat", None), (None, "die katze und der hund", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.identify_language(spark, docs, "")
    assert {r["doc_id"] for r in out.collect()} == {r[0] for r in rows} - {900, 901}
