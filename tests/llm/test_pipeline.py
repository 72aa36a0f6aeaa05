"""The pipeline against its stages worked out directly."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from kinmaster.llm import decontaminate, huffman, near_dup
from kinmaster.session import materialise

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in seen.collect()}
        after = materialise(stage(spark, seen, SF), "stage")
        assert after.columns == docs.columns, name
        rows = after.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= set(before)
        if name == "language":
            assert len(ids) > 0.95 * len(before)
        if name == "near_duplicates":
            found = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(seen).collect()}
            assert ids == {i for i, c in found.items() if i == c}
        if name == "decontamination":
            judged = dict(zip(before, decontaminate.brute_force(list(before.values()), items), strict=True))
            assert ids == {i for i, j in judged.items() if not j[4]}
            assert all(r["text"] == before[r["doc_id"]] for r in rows if not judged[r["doc_id"]][1])
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "mixing":
            assert max(Counter(r["doc_id"] for r in rows).values()) <= 2
        seen = after
    mixed = sorted(((r["doc_id"], r["text"]) for r in seen.collect()), key=lambda r: r[0])
    plain = Tokenizer.from_file(public_tokenizers.path(huffman.TOKENIZER))
    want, start = [], 0
    for i, text in mixed:
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [huffman.END_ID], dtype="<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = corpus_pipeline.token_stage(spark, seen, SF).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == want


def test_nulls_and_odd_texts_pass(spark):
    rows = [(1, None, None, None, None), (None, "the and of the this that with from", "en", "a", 34), (2, "", "en", None, 0),
            (3, "und der die das nicht ein eine mit", "de", "b", 34), (3, "und der die das nicht ein eine mit", "de", "b", 34)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for data in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, data, SF).columns == docs.columns
        assert corpus_pipeline.token_stage(spark, data, SF).count() == data.count()
