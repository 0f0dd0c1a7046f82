import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.llm import packing
from stationflow.llm.bpe import byte_bpe
from stationflow.llm.queries import op10_packing


@lru_cache
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(text):
    return reference().encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "a", " lead", "trail ", "two  spaces", "line\n next\nx", "tab\t x", "don't it's",
                                  "naïve £5 99% ok", "日本語 テキスト", "  nbsp x", "x" * 300 + " y", "a 　b", "<|endoftext|> z", "<|endoftext|>",
                                  "a <|endoftext|> b", "x<|endoftext|><|endoftext|>y", " <|endoftext|>\n z", "<|endoftext|", "<|endof text|>"])
def test_ids_equal_the_public_tokenizer(text):
    assert np.frombuffer(byte_bpe().pack(text), "<u4").tolist() == reference_ids(text)


def test_a_text_is_encoded_by_one_call_a_stretch(monkeypatch):
    import tiktoken

    calls, encode = [], tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: calls.append(text) or encode(self, text))
    words = byte_bpe.__wrapped__()
    text = " ".join(f"w{i}x" for i in range(2000))
    assert np.frombuffer(words.pack(text), "<u4").tolist() == reference_ids(text)
    assert calls == [text]
    calls.clear()
    assert np.frombuffer(words.pack(text + "<|endoftext|> z"), "<u4").tolist() == reference_ids(text + "<|endoftext|> z")
    assert calls == [text, " z"]


def test_the_encoder_keeps_nothing_of_the_texts():
    words = byte_bpe.__wrapped__()
    held = lambda: {k: len(v) for k, v in vars(words).items() if hasattr(v, "__len__")}
    before = held()
    for i in range(50):
        text = " ".join(f"v{i}x{j}" for j in range(100))
        assert np.frombuffer(words.pack(text), "<u4").tolist() == reference_ids(text)
    assert held() == before


def test_limits_hold_on_every_axis_and_every_example_is_placed():
    rng = np.random.default_rng(0)
    tokens = rng.integers(1, 101, 700)
    loss = (tokens * rng.random(700)).astype(int)
    seq, off = packing.dot_product_pack(tokens, loss, (100, 7, 40 + 60))
    df = pd.DataFrame({"s": seq, "o": off, "t": tokens, "l": loss}).sort_values(["s", "o"])
    g = df.groupby("s")
    assert g["t"].sum().max() <= 100 and g["l"].sum().max() <= 100 and g.size().max() <= 7
    assert (df["o"] == g["t"].cumsum() - df["t"]).all()          # gapless
    tight = packing.dot_product_pack([10] * 6, [10] * 6, (100, 6, 20))[0]
    assert np.bincount(tight).tolist() == [2, 2, 2]              # the loss axis binds
    with pytest.raises(ValueError):
        packing.dot_product_pack([101], [0], (100, 7, 100))


def test_query_covers_every_id_once(spark, sf_dir):
    got = op10_packing(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    want = {d: reference_ids(t) + [0] for d, t in zip(docs.doc_id, docs.text)}
    assert set(got.doc_id) == set(want)
    for d, rows in got.sort_values("start").groupby("doc_id"):
        ids, at = want[d], 0
        for r in rows.itertuples():
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.asarray(ids[at: at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert by["length"].sum().max() <= 1024
    got = got.sort_values(["sequence_id", "offset"])
    assert (got["offset"] == got.groupby("sequence_id")["length"].cumsum() - got["length"]).all()
    assert by["length"].sum().sum() / (1024 * len(by)) > 0.97    # little padding


def test_nulls_empties_repeats_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (4, "word " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x")) \
        .withColumn("sequence_id", F.lit(1)).withColumn("_group", F.lit(None).cast("int"))
    got = packing.pack_documents(docs).toPandas()
    assert got[got.doc_id == 1][["length", "doc_tokens"]].values.tolist() == [[1, 1]]
    assert got[got.doc_id == 2]["length"].tolist() == [1]
    assert len(got[got.doc_id == 3]) == 2 and got.doc_id.isna().sum() == 1
    assert got[got.doc_id == 4]["length"].sum() == got[got.doc_id == 4]["doc_tokens"].iloc[0]
    assert packing.pack_documents(docs.limit(0)).count() == 0
