import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from llm.cases import frame
from llm.test_near_dedup import brute_classes
from llm.test_secrets import brute as secrets_of
from shopgrain.llm import language


def test_stages_take_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen, given = {}, docs
    for name, stage in C.STAGES:
        made = stage(spark, given, folder)
        made.write.parquet(str(tmp_path / name))
        given = spark.read.parquet(str(tmp_path / name))
        if name != C.STAGES[-1][0]:
            assert given.columns == docs.columns
        seen[name] = {r["doc_id"]: r for r in given.collect()}
        assert len(seen[name]) == given.count()
    before = {r["doc_id"]: r for r in docs.collect()}
    rejected = language.predict(docs, language.train_on_folds(docs)).where("rejected").count()
    assert len(before) - len(seen["language_id"]) == rejected
    classes = brute_classes([(i, r["text"]) for i, r in seen["language_id"].items()])
    assert set(seen["near_dedup"]) == set(classes.values())
    assert set(seen["secret_scan"]) == {
        i for i, r in seen["near_dedup"].items() if not secrets_of(r["text"])}
    assert 0 < len(seen["mixing"]) <= len(seen["secret_scan"])
    assert set(seen["bpe"]) == set(seen["mixing"]) <= set(seen["secret_scan"])
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in seen["bpe"].values():
        assert np.frombuffer(r["ids"], "<u4").tolist() == reference.encode(r["text"]).ids
    digests = {r["doc_id"]: r["ids_sha256"] for r in C.queries()["pipeline"](spark, folder).collect()}
    assert digests == {i: hashlib.sha256(r["ids"]).hexdigest() for i, r in seen["bpe"].items()}


def test_stages_cope_with_odd_rows(spark, folder):
    for rows in (None, []):
        for _, stage in C.STAGES:
            stage(spark, frame(spark, rows), folder).collect()


def test_columns_of_any_name_keep_their_values(spark, folder):
    """Each name that a stage adds or works with is present in the input, and stays as it was."""
    names = ["lang_pred", "score", "cross_entropy", "rejected", "held_out", "class_id", "n_in_class",
             "class_key", "class_label", "is_kept", "keep_id", "owner", "copies", "secret_spans",
             "secret_text_key", "text_key", "kinds", "body", "mix_topic", "mix_words", "inclusion",
             "fitted", "weight", "_value", "_cell_lang", "carried", "row", "none", "a.b"]
    docs = frame(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    clash = docs.select("*", *[F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names])
    quoted = [f"`{n}`" for n in names]
    for name, stage in C.STAGES:
        plain, found = (sorted(r["doc_id"] for r in stage(spark, d, folder).collect())
                        for d in (docs, clash))
        assert plain == found, name
        made = stage(spark, clash, folder)
        if name != "bpe":
            assert made.columns == clash.columns
        for r in made.select("doc_id", *quoted).collect():
            assert [*r[1:]] == [f"{n} of {r['doc_id']}" for n in names], name
