import html
import itertools
import math
import pathlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationflow.llm import ann, grid_join, html_text, token_output, unigram
from stationflow.llm.queries import op2_nearest_neighbours, op4_token_output, op5_html_text, op6_embedding_dedup, op7_sentencepiece
from stationflow.session import ensure_checkpoint_dir

VECTORS = "vec_id long, embedding array<float>, label int"


# ---------------------------------------------------------------- epsilon grid join

def links_by_hand(rows):
    ok = [r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) and r[2] is not None for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
            a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
            if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.98:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        ids[find(i)] = min(r[0], ids.get(find(i), r[0]))
    return sorted((r[0], n[i], ids[find(i)], r[0] == ids[find(i)]) for i, r in enumerate(rows))


def test_grid_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "BLOCK", 24)
    monkeypatch.setattr(grid_join, "LEAF", 5)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 20))
    rows = []
    for i in range(260):
        v = centres[rng.integers(12)] + rng.normal(size=20) * rng.choice([0.02, 0.08, 0.15])
        rows.append((i, (v * rng.choice([1, 30])).astype(np.float32).tolist(), int(rng.integers(3))))
    rows += [(300, rows[5][1], rows[5][2]), (301, rows[5][1], rows[5][2]), (302, rows[5][1], None), (303, None, 1), (304, [], 1),
             (305, [0.0] * 20, 1), (306, [float("nan")] * 20, 1), (307, [float("inf")] + [1.0] * 19, 1), (308, [None] + [1.0] * 19, 1), (309, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("vector", F.lit(1)).withColumn("block", F.lit("x"))
    got = sorted(tuple(r) for r in grid_join.near_duplicates(df).collect())
    assert got == links_by_hand(rows)
    assert grid_join.near_duplicates(df.limit(0)).count() == 0


def test_grid_query_covers_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in op6_embedding_dedup(spark, sf_dir).collect()) == links_by_hand(rows)


# ---------------------------------------------------------------- nearest neighbours

def nearest_by_hand(rows, query, k=10):
    x = np.array(query[1], float)
    return sorted((math.sqrt(((np.array(v, float) - x) ** 2).sum()), i) for i, v in rows if i != query[0])[:k]


def test_ann_recall_scores_and_ranks(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in sorted(op2_nearest_neighbours(spark, sf_dir).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id, r.rank))
    queries = [r for r in rows if r[0] % 100 == 0]
    assert set(got) == {q[0] for q in queries}
    hits = 0
    for q in queries:
        want = nearest_by_hand(rows, q)
        assert [x[2] for x in got[q[0]]] == list(range(1, 11)) and [x[:2] for x in got[q[0]]] == sorted(x[:2] for x in got[q[0]])
        true = dict((i, d) for d, i in nearest_by_hand(rows, q, len(rows)))
        assert all(math.isclose(s, true[i], rel_tol=1e-12, abs_tol=1e-12) for s, i, _ in got[q[0]])
        hits += len({i for _, i in want} & {i for _, i, _ in got[q[0]]})
    assert hits / (10 * len(queries)) >= 0.9


def test_ann_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(30)] + [(100, [1.0, 0.1], 0), (101, [0.0, 1.0], 0), (102, None, 0), (200, [0.0, 0.0], 0),
                                                     (103, [float("nan"), 1.0], 0), (104, [1.0, 2.0, 3.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("x"))
    got = {}
    for r in sorted(ann.search_embeddings(df).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got[0] == [(i, 0.0) for i in range(1, 11)]
    assert [v for v, _ in got[100]] == list(range(10)) and 200 not in got
    few = spark.createDataFrame(rows[:1] + rows[30:32], VECTORS)
    assert {r.vec_id for r in ann.search_embeddings(few).filter("query_id = 0").collect()} == {100, 101}
    assert ann.search_embeddings(df.limit(0)).count() == 0


def test_ann_searches_of_a_leaf_come_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist(), 0) for i in range(1500)], VECTORS)
    want = sorted(tuple(r) for r in ann.search(df, df, k=3).collect())
    nearest = ann.nearest_in

    def bounded(queries, x, k):
        if len(queries) > 200:
            raise ValueError(f"{len(queries)} searches in one group")
        return nearest(queries, x, k)

    monkeypatch.setattr(ann, "QUERY_BLOCK", 100, raising=False)
    monkeypatch.setattr(ann, "nearest_in", bounded)
    assert sorted(tuple(r) for r in ann.search(df, df, k=3).collect()) == want and len(want) == 4500


# ---------------------------------------------------------------- main text

def test_html_query_keeps_the_articles(spark, sf_dir):
    got = {r.page_id: r for r in op5_html_text(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        m = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        body = re.sub(r"<[^>]*(>|$)", " ", re.sub(r"</?b>", "", m[1] if m else ""))
        want = " ".join(html.unescape(body).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


LONG = "A long paragraph of running text that says something about the matter at hand, and then some more of it."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain", "plain"), ("<p>a<br>b</p>", "a b"), ("<p>a<b>b</b>c &amp; d&nbsp;\n e", "abc & d e"),
    (f"<nav>Home</nav><div><p>{LONG}</p><p>Short.</p></div><footer>x</footer>", f"{LONG} Short."),
    (f"<header><h1>Site</h1></header><main><h1>T</h1><p>x</p></main><aside>y</aside>", "T x"),
    (f"<article><p>a</p><div class='ad'>buy</div><p>b</p><section id='comments'><p>c</p></section></article>", "a b"),
    (f"<div class=cookie-notice>ok</div><article>t<script>if (a<b) '</p>'</script><style>p{{}}</style>u</article>", "tu"),
    (f"<nav><ul><li>x<article><p>unclosed nav</p>", "unclosed nav"), ("<article><p>cut &am", "cut &am"), ("<article>x<p", "x"),
    (f"<p>{LONG}</p>" + "<p class=ad>ad</p>" * 4 + f"<p>{LONG}</p>", f"{LONG} {LONG}"),
    ("<article><form>f<input></form><p>1 &lt;p&gt; 2</p><!-- c --></article>", "1 <p> 2")])
def test_main_text_of_small_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ('<article><p>A</p><p class="notice">N<p>B</p><p>C</p></article>', "A B C"),
    ("<article><p>A<p class=notice>N<div>B</div><p>C</article>", "A B C"),
    ("<article><p>A<p class=ad>N</article>", "A"), ("<article><div><p>A<p class=ad>N</div><p>B</article>", "A B"),
    ("<article><p>A<p class=ad>N <b>b<hr>B</article>", "A B"), ("<article><p>A<p class=ad>N<p class=ad>M<p>B</article>", "A B"),
    ("<article><ul><li>A<li class=promo>N<li>B</ul>C</article>", "A B C"), ("<article><ul><li class=ad>N<ul><li>M</ul><li>B</ul></article>", "B"),
    ("<article><ul><li>A<li class=ad>N</ul>C</article>", "A C"), ("<article><ul><li>A<li class=ad><p>N</ul>C</article>", "A C"),
    ("<article><dl><dt class=ad>N<dd>A<dd class=ad>M<dt>B</dl>C</article>", "A B C"),
    ("<article>A<select><option>N<option>M</select>B</article>", "A B"), ("<article>A<datalist><option>N</datalist>B</article>", "A B"),
    ("<article>A<option>N<option>M<p>B</article>C", "A"),
    ("<article><table><tr><td>A<td class=ad>N<td>B<tr class=ad><td>M<tr><td>C</table>D</article>", "A B C D"),
    ("<html><head><title>T</title><meta charset=utf-8><script>x</script><body><p>A<p>B</body></html>", "A B"),
    ("<head><title>T</title><link rel=x><p>A</p>", "A"), ("<head><style>x</style>A <p>B", "A B"), ("<head><title>T</title></head>A", "A"),
    ("<article><section><aside>N</section>B</article>", "B"), ("<article><div><nav><ul><li>N</div>B</article>", "B"),
    ("<article><div class=ad><div>N</div></article>", ""), ("<div><span class=ad>N</div><p>B", "B"),
    ("<article>A<div class=ad><p>N<div>M</p></div>O</div>B</article>", "A B"), ("<article>A<b class=ad>N<p>M</b>B</article>", "A B"),
    ("<article><div>A<nav><a href=/x/>N</a><div title=/y/>M</div>O</nav>B</div></article>", "A B"),
    ("<article><div><nav><table><tr><td>N</div>M</table></nav>B</div></article>", "B")])
def test_main_text_after_an_omitted_end_tag(page, text):
    assert html_text.main_text(page) == text


def test_many_open_elements_take_linear_time():
    page = "<p><table><tr><td>" + "<b><i class=x>" * 40000 + "<div></p></u>" * 40000 + "end"
    assert html_text.main_text(page) == "end"


def test_html_other_columns_and_long_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<article>" + f"<p>{LONG}</p>" * 3000, 5), (1, "u", None, 6)], "page_id long, url string, html string, n_chars int")
    got = html_text.extract(pages).collect()
    assert sorted(r.n_chars for r in got) == [0, 3000 * len(LONG) + 2999] and len(got[0]) == 4
    assert html_text.extract(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- unigram pieces

def best_score(codec, word):
    vocab = {p: i for i, p in enumerate(codec.pieces) if p and i not in set(codec.byte_id)}
    w = word.encode()
    best = [0.0] + [-math.inf] * len(w)
    for i in range(len(w)):
        if best[i] == -math.inf:
            continue
        char = 1 + (w[i] >= 0xC0) + (w[i] >= 0xE0) + (w[i] >= 0xF0)
        if w[i: i + char] not in vocab:
            best[i + char] = max(best[i + char], best[i] + codec.unknown)
        for j in range(i + 1, min(len(w), i + codec.deepest) + 1):
            if w[i:j] in vocab:
                best[j] = max(best[j], best[i] + codec.scores[vocab[w[i:j]]])
    return best[-1]


def score_of(codec, ids):
    total, i, byte = 0.0, 0, set(codec.byte_id)
    while i < len(ids):
        if ids[i] in byte:
            b = codec.pieces[ids[i]][0]
            total, i = total + codec.unknown, i + 1 + (b >= 0xC0) + (b >= 0xE0) + (b >= 0xF0)
        else:
            total, i = total + codec.scores[ids[i]], i + 1
    return total


TEXTS = ["Hello world", "", " ", "  two  spaces ", "naïve café 日本語 😀 x", "line\nbreak\ttab", "a" * 200, "þorn ẞ " * 5, "Ünïcödé" * 30, "x▁y"]


def test_segmentation_is_the_best_one_and_decodes_to_the_text():
    codec = unigram.codec()
    for text, packed in zip(TEXTS, codec.encode(TEXTS)):
        ids = np.frombuffer(packed, "<u4").tolist()
        if text:
            assert math.isclose(score_of(codec, ids), best_score(codec, unigram.MARK + text.replace(" ", unigram.MARK)), rel_tol=1e-9)
        assert codec.decode(packed) == text.replace("▁", " ")


def test_trie_holds_exactly_its_words():
    words = [(b, i) for i, b in enumerate([b"a", b"ab", b"abc", b"b", b"\xff\x00", b"ba"])]
    trie = unigram.Trie(words)

    def find(word):
        s = 0
        for b in word:
            t = int(trie.base[s]) + b + 1
            if trie.check[t] != s:
                return -1
            s = t
        return int(trie.leaf[s])

    assert [find(w) for w, _ in words] == list(range(6)) and find(b"ac") == -1 and find(b"\xff") == -1 and find(b"c") == -1


def test_sentencepiece_query_round_trips(spark, sf_dir):
    got = op7_sentencepiece(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and all(r.round_trip for r in got)
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "a b"), (2, "w " * 30000)], "doc_id long, text string").withColumn("ids", F.lit(1))
    rows = unigram.encode_documents(docs).collect()
    assert sorted(r.n_ids for r in rows)[:2] == [0, 0] and all(r.round_trip and len(r.ids) == r.n_ids for r in rows)
    assert unigram.encode_documents(docs.limit(0)).count() == 0


def test_sentencepiece_query_returns_the_ids(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    codec = unigram.codec()
    for r in op7_sentencepiece(spark, sf_dir).collect():
        packed = np.array(r.ids, "<u4").tobytes()
        assert len(r.ids) == r.n_ids and zlib.crc32(packed) == r.ids_crc32
        assert codec.decode(packed) == texts[r.doc_id].replace(unigram.MARK, " ")


# ---------------------------------------------------------------- training order

@pytest.mark.parametrize("count", [1, 2, 3, 10, 1000, 4097])
def test_permutation_is_a_keyed_bijection(count):
    slots = token_output.permute(np.arange(count), count)
    assert sorted(slots.tolist()) == list(range(count))
    if count > 100:
        assert (slots != token_output.permute(np.arange(count), count, key=1)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(count), slots)[0, 1]) < 0.2


def test_shards_round_trip_and_resume(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ordered = token_output.training_order(docs, shard=16)
    rows = sorted(ordered.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.shard == r.slot // 16 and r.byte_offset == r.slot % 16 * 2048 for r in rows)
    total = sum(len(token_output.byte_bpe().pack(r.text or "")) // 4 + 1 for r in docs.select("text").collect())
    assert sum(r.n_ids for r in rows) == total
    assert all(zlib.crc32(r.record[: 2 * r.n_ids]) == r.ids_crc32 for r in rows)
    told = token_output.write_shards(ordered, str(tmp_path), shard=16).collect()
    assert sum(r.n_records for r in told) == len(rows)
    again = list(token_output.read_records(str(tmp_path), 21, len(rows), shard=16))
    assert [s for s, _ in again] == list(range(21, len(rows)))
    assert all(ids.tobytes() == rows[s].record for s, ids in again)


def test_token_output_edges(spark, sf_dir):
    docs = spark.createDataFrame([(1, None), (None, "a"), (1, "b " * 3000)], "doc_id long, text string").withColumn("slot", F.lit(1))
    rows = token_output.training_order(docs.coalesce(1)).collect()
    assert sum(r.n_ids for r in rows) == 3 + 1 + len(token_output.byte_bpe().pack("b " * 3000)) // 4
    assert token_output.training_order(docs.limit(0)).count() == 0
    assert op4_token_output(spark, sf_dir).count() > 0


def test_token_query_writes_its_shards(spark, sf_dir):
    root = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.glob("token-shards-*/shard-*.bin"))
    rows = sorted(op4_token_output(spark, sf_dir).collect(), key=lambda r: r.slot)
    files = sorted(set(root.glob("token-shards-*/shard-*.bin")) - before)
    assert [f.name for f in files] == [f"shard-{n:08d}.bin" for n in range(-(-len(rows) // token_output.SHARD))]
    data = [f.read_bytes() for f in files]
    assert sum(map(len, data)) == 2048 * len(rows)
    assert all(data[r.shard][r.byte_offset: r.byte_offset + 2048] == r.record for r in rows)


def test_written_rows_are_the_training_order(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted(tuple(r) for r in token_output.training_order(docs, shard=16).collect())
    got = token_output.written_order(docs, str(tmp_path), shard=16)
    assert len(list(tmp_path.iterdir())) == -(-len(want) // 16)               # written before any row is asked for
    assert sorted(tuple(r) for r in got.collect()) == want
    (tmp_path / "shard-00000000.bin").write_bytes(b"x" * 16 * 2048)
    with pytest.raises(Exception, match="does not hold what was written"):
        got.collect()
    wide = token_output.written_order(docs.limit(3), shard=2, end_id=70000).collect()
    assert all(len(r.record) == 4096 and r.byte_offset == r.slot % 2 * 4096 for r in wide)
    assert token_output.written_order(docs.limit(0)).count() == 0


def test_shards_are_written_pass_by_pass(spark, sf_dir, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before, was, seen, write = set(root.glob("token-sequences-*")), spark.conf.get(token_output.RELEASE), [], token_output.write_shards

    def noted(ordered, *args):
        seen.append(({r.shard for r in ordered.select("shard").collect()}, spark.conf.get(token_output.RELEASE)))
        return write(ordered, *args)

    monkeypatch.setattr(token_output, "write_shards", noted)
    n = token_output.written_order(docs, str(tmp_path), shard=16).select("slot").distinct().count()
    shards = -(-n // 16)
    assert [s for s, _ in seen] == [set(range(shards // 2)), set(range(shards // 2, shards))]       # each pass shuffles half
    assert [r for _, r in seen] == ["true", "true"] and spark.conf.get(token_output.RELEASE) == was
    kept, = set(root.glob("token-sequences-*")) - before
    assert all(f.name.endswith(".zstd.parquet") for f in kept.glob("part-*"))
