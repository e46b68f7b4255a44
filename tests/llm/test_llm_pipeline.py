"""The corpus pipeline, stage by stage, against brute force."""

import pyarrow as pa
import regex
from pyspark.sql import functions as F
from test_llm_near_texts import groups_of
from tokenizers import Tokenizer

import corpus_pipeline
from cuota.llm import bpe, langid

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = langid.fit_languages(docs, usable=~langid.held_out())
    stages = dict(corpus_pipeline.STAGES)

    named = stages["language_id"](spark, docs, SF)
    want = {i for i, r in rows.items() if not model.predict(r["text"])[2]}
    assert {r["doc_id"] for r in named.collect()} == want and named.columns == docs.columns

    single = stages["exact_dedup"](spark, named, SF)
    first = {}
    for i in sorted(want):
        first.setdefault(regex.sub(r"[\x20\x09-\x0D]+", " ", rows[i]["text"]), i)
    assert {r["doc_id"] for r in single.collect()} == set(first.values())

    apart = stages["near_dedup"](spark, single, SF)
    left = set(groups_of({i: rows[i]["text"] for i in first.values()}).values())
    assert {r["doc_id"] for r in apart.collect()} == left and apart.columns == docs.columns

    mixed = stages["mix_sources"](spark, apart, SF)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= left

    library = Tokenizer.from_file(bpe.VOCABULARY)
    result = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in result) == sorted(r["doc_id"] for r in mixed.collect())
    for row in result:
        assert row["exact"] and row["ids"] == library.encode(rows[row["doc_id"]]["text"], add_special_tokens=False).ids


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_repeated_and_missing_ids(spark):
    """Rows that repeat an id, have none, or clash in their columns go through all stages; of equal texts one row stays."""
    some = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(60).collect()]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], "k", "i") for r in some]
    rows += [(rows[0][0], *rows[0][1:])] * 5 + [(None, *rows[1][1:]), (None, "", "en", None, "k", "i")]
    rows += [(None, "another text " + rows[2][1], "en", None, "k", "i")] * 3 + [(rows[3][0], rows[4][1] + " end", "en", "hot", "k", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, ids string").repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    single = stages["exact_dedup"](spark, df, SF)
    texts = [regex.sub(r"[\x20\x09-\x0D]+", " ", r["text"]) for r in single.collect()]
    assert single.columns == df.columns and len(texts) == len(set(texts)) == len({
        regex.sub(r"[\x20\x09-\x0D]+", " ", r[1]) for r in rows})
    apart = stages["near_dedup"](spark, single, SF)
    owner = groups_of(dict(enumerate(sorted(texts))))
    assert apart.columns == df.columns and apart.count() == len(set(owner.values()))
    mixed = stages["mix_sources"](spark, apart, SF)
    assert mixed.columns == df.columns
    assert stages["bpe_encode"](spark, mixed, SF).where("exact").count() == mixed.count()


def test_batches_of_bounded_bytes(spark, monkeypatch):
    """Long texts reach Python in small batches in the first and the last stage, whoever uses their result; the setting
    is as before then."""
    @F.arrow_udf("boolean")
    def small(values: pa.Array) -> pa.Array:
        if values.nbytes > 2 * (1 << 21):
            raise ValueError(f"a batch of {values.nbytes} bytes")
        return pa.array([True] * len(values))

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    words = F.concat_ws(" ", F.lit("the house of the old man"), F.col("id"), F.repeat(F.lit("and there was a road "), 2500))
    docs = spark.range(0, 200, 1, 1).select(F.col("id").alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"),
                                            F.lit("s").alias("source"))
    stages = dict(corpus_pipeline.STAGES)
    with monkeypatch.context() as patch:
        find, decode = corpus_pipeline.identify_languages, corpus_pipeline.bpe_decode
        patch.setattr(corpus_pipeline, "identify_languages", lambda df, model: find(df.where(small("text")), model))
        patch.setattr(corpus_pipeline, "bpe_decode", lambda df: decode(df.where(small("ids"))))
        assert stages["language_id"](spark, docs, SF).count() == 200
        assert stages["bpe_encode"](spark, docs, SF).where("exact").count() == 200
    assert spark.conf.get(key) == before
