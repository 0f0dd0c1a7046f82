import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import components, minhash, suffix_array, suffix_dedup
from stationflow.llm.queries import op3_suffix_dedup, op9_minhash


# ---------------------------------------------------------------- suffix arrays

@pytest.mark.parametrize("n, letters", [(0, 2), (1, 2), (7, 1), (300, 2), (2000, 3), (1500, 256)])
def test_suffix_array_orders_all_suffixes(n, letters):
    t = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    b = t.tobytes()
    sa = suffix_array.suffix_array(t, 50).tolist()
    assert sorted(sa) == list(range(n))
    assert all(b[i: i + 50] <= b[j: j + 50] for i, j in zip(sa[:-1], sa[1:]))
    s = suffix_array.smaller_than_next(t)
    assert s.tolist() == [b[i:] < b[i + 1:] for i in range(n)]


def removed_by_hand(docs, length):
    """{position in docs: (n_bytes, n_removed, n_spans, kept)}; docs: (doc_id, text)."""
    out, first = {}, {}
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    for i in order:
        doc_id, b = docs[i][0], (docs[i][1] or "").encode()
        gone = [False] * len(b)
        if doc_id is not None:
            for p in range(len(b) - length + 1):
                if first.setdefault(b[p: p + length], doc_id) < doc_id:
                    gone[p: p + length] = [True] * length
        out[i] = (len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)),
                  bytes(x for x, g in zip(b, gone) if not g))
    return out


def test_suffix_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {docs[i][0]: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for i, x in removed_by_hand(docs, 50).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op3_suffix_dedup(spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize("common", [1, 64])
def test_suffix_edges_over_many_chunks(spark, monkeypatch, common):
    monkeypatch.setattr(suffix_dedup, "COMMON_CHUNKS", common)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 700)
    rng = random.Random(common)
    word = lambda: "".join(rng.choices("abé", k=4))
    line = " ".join(word() for _ in range(16))
    rows = [(1, None), (2, ""), (3, "short"), (None, line), (4, "x" * 49), (5, "x" * 50), (6, "x" * 120), (7, "y" + "x" * 60)]
    rows += [(10 + i, " ".join(word() for _ in range(rng.randrange(30))) + line + " ".join(word() for _ in range(5))) for i in range(25)]
    rows += [(40, rows[9][1]), (41, rows[9][1][:-1] + "ê"), (41, "repeated id " + line), (42, line * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("_chunk", F.lit("k"))
    got = suffix_dedup.remove_repeats(docs, chunk_bytes=500)
    assert got.columns == ["doc_id", "_chunk", "n_bytes", "n_removed", "n_spans", "kept"]
    key = lambda x: tuple(map(repr, x))
    want = sorted(((rows[i][0], *x) for i, x in removed_by_hand(rows, 50).items()), key=key)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=key) == want
    assert suffix_dedup.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("strings", [2, 256])
def test_suffix_anchors_of_many_chunks_go_as_stretches(spark, monkeypatch, strings):
    """Only anchors with more strings than a bucket takes go window by window, however many
    chunks have them; a window costs about as many bytes as a stretch of some 14 windows."""
    sent, table = spark.sparkContext.accumulator(0), suffix_dedup._table

    def counted(rows, schema):
        sent.add(sum(len(r[2]) for r in rows) if " bytes binary" in schema else 0)
        return table(rows, schema)

    monkeypatch.setattr(suffix_dedup, "_table", counted)
    monkeypatch.setattr(suffix_dedup, "COMMON_CHUNKS", 4)
    monkeypatch.setattr(suffix_dedup, "CHUNK_STRINGS", strings, raising=False)
    rng = random.Random(7)
    line = "a line that very many of the documents have in common, at any place. "
    rows = [(i, "".join(rng.choices("abcdefgh ", k=60)) + line * (1 + i % 3) + "".join(rng.choices("abcdefgh ", k=60))) for i in range(40)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=300).collect()
    want = {rows[i][0]: x for i, x in removed_by_hand(rows, 50).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == want
    assert (sent.value < 2 * sum(len(t) for _, t in rows)) == (strings == 256)


def test_text_column_keeps_whole_characters(spark):
    same = "é" * 30
    docs = spark.createDataFrame([(1, "à" + same), (2, "è" + same), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, text_column=True).collect()}
    assert got[1].text == "à" + same and got[3].text is None
    assert got[2].text in ("è", "") and got[2].n_removed >= 60


# ---------------------------------------------------------------- components

def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, None), (800, 801), (801, 800)]
    names = list(range(100, 161))
    rng.shuffle(names)
    edges += [(1000 + names[i], 1000 + names[i + 1]) for i in range(60)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 560)} == {500}
    assert {got[1000 + i] for i in range(100, 161)} == {1100} and got[801] == 800 and got[7] == 7 and 9 not in got


# ---------------------------------------------------------------- MinHash

def set_of(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components_by_hand(docs, k, percent):
    sets = [set_of(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    held = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    pairs = {(i, j) for v in held.values() for i in v for j in v if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)].append(d)
    return [(d, len(sets[i]), min(ids[find(i)], default=None)) for i, (d, _) in enumerate(docs)]


def test_minhash_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op9_minhash(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(components_by_hand(docs, 3, 85))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_shingle_sets_have_the_size_of_the_words_in_sets():
    texts = ["", None, "a", "A b", "a  B\tc\n", "x y z x y z x", "é à é à é", " nbsp x", "w " * 5000]
    for k in (1, 3, 5):
        assert [len(s) for s in minhash.shingle_sets(texts, k)] == [len(set_of(t, k)) for t in texts]


def test_dense_groups_are_compared_in_blocks(spark, monkeypatch):
    """A large group of near copies of which only some are linked."""
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for d in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 8])):
            words[rng.randrange(120)] = f"z{rng.randrange(10**6)}"
        docs.append((d, " ".join(words)))
    docs += [(200, docs[3][1]), (201, docs[3][1].upper()), (None, docs[4][1]), (203, None), (204, "  "), (205, "one two"), (206, "ONE\ttwo")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("n", F.lit("x"))
    got = minhash.near_duplicates(df, words=3, percent=85).collect()
    key = lambda x: tuple(map(repr, x))
    want = [(d, n, d if n == 0 else c) for d, n, c in components_by_hand(docs, 3, 85)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
