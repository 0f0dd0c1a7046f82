import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stationflow.llm import langid
from stationflow.llm.queries import op8_language_id


def by_hand(train, text):
    """Code length of ``text`` by walking the context tree byte by byte."""
    counts = {}
    seen = set()
    for t in train:
        d = langid._LEAD + t
        for i in range(langid.ORDER, len(d)):
            seen.add(d[i])
            for k in range(langid.ORDER + 1):
                node = counts.setdefault(d[i - k: i], {})
                node[d[i]] = node.get(d[i], 0) + 1

    def cost(context, b):
        node = counts.get(context)
        if node is None:
            return cost(context[1:], b)
        t, n = sum(node.values()), len(node)
        if b in node:
            return -math.log2(node[b] / (t + n))
        escape = -math.log2(n / (t + n))
        return escape + (cost(context[1:], b) if context else math.log2(len(seen) + 1))

    d = langid._LEAD + text
    return sum(cost(d[i - langid.ORDER: i], d[i]) for i in range(langid.ORDER, len(d)))


def model_of(**texts):
    return {k: [(r.grams, r.n) for r in langid._count((k,), pd.DataFrame({"text": v})).itertuples()] for k, v in texts.items()}


def test_code_lengths_equal_a_walk_of_the_tree():
    train = ["abracadabra bra cad", "banana bandana"]
    trees = langid.Trees(model_of(x=train))
    for text in (b"abra", b"barn and crab", b"", b"cadabra banana" * 20):
        assert math.isclose(trees.code_lengths([text])[0, 0], by_hand([t.encode() for t in train], text), rel_tol=1e-5, abs_tol=1e-6)
    assert trees.code_lengths([b"zzz"])[0, 0] > trees.code_lengths([b"bra"])[0, 0]


def test_long_texts_are_scored_whole_in_slices(monkeypatch):
    trees = langid.Trees(model_of(x=["the quick brown fox " * 9], y=["der schnelle fuchs " * 9]))
    texts = [b"the fox der " * 700, b"", b"quick"]
    whole = trees.code_lengths(texts)
    monkeypatch.setattr(langid, "SLICE_BYTES", 97)
    assert np.allclose(whole, trees.code_lengths(texts), rtol=1e-9)


def test_held_out_accuracy(spark, sf_dir):
    got = op8_language_id(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    assert got.doc_id.is_unique and set(got.doc_id) == set(docs.index)
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred.values == docs.loc[held.doc_id].values).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_labels_of_the_held_out_fold_play_no_part(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lied = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, langid.identify_documents(d).collect())) for d in (docs, lied))
    assert a == b


def test_nulls_empties_and_no_labels(spark):
    en, fr = [i for i in range(10, 99) if zlib.crc32(str(i).encode()) % 4 != 2][:2]
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 %% 34", "en"), (en, "hello there", "en"), (None, "hello", None),
                                  (fr, "bonjour madame", "fr"), (fr, "bonjour madame", "fr"), (7, "bonjour " * 40000, None)],
                                 "doc_id long, text string, lang string").withColumn("score", F.lit("mine"))
    got = langid.identify_documents(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 8 and [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[7].lang_pred == "fr" and by[None].held_out is False
    none = langid.identify_documents(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.identify_documents(docs.limit(0)).count() == 0
