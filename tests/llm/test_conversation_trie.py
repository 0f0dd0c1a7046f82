import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from stationflow.llm import conversation_trie as T
from stationflow.llm.queries import op11_prefix_trie

from .helpers import duck, rows

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(data, heads=4):
    """The trie by plain loops over ``(conv_id, turn, role, text)``."""
    convs = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, sha(sha(role or "") + sha(text or "")), role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        turns = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)

    def below(k):
        leaves, saved = 0 if children[k] else 1, (len(nodes[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
        for child in children[k]:
            a, b = below(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(children[k]), *below(k),
                    sha(",".join(map(str, sorted(ends[k]))))) for k, m in list(nodes.items())), key=str)


def test_query_equals_sql_and_loops(spark, sf_dir):
    got = rows(op11_prefix_trie(spark, sf_dir).select(*COLUMNS))
    assert got == sorted(duck(sf_dir, T.trie_sql()), key=str)
    assert got == brute([tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def edge_rows():
    data = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 3}") for c in range(100, 160) for t in range(c % 5)]
    data += [(c, t, "user", "same words here\tnow") for c in range(200, 300) for t in range(3)]     # a third are copies
    data += [(7, None, "user", "null turn first"), (7, 0, None, None), (7, 1, "", ""), (None, 0, "user", "no id"), (27, 5, "a", "tie"), (27, 5, "a", "tie"),
             (27, 5, "b", "tie"), (-25, 0, "user", "x"), (-20, 0, "user", "y"), (-20, 1, "user", "z"), (-3, 0, "u", "w " * 20_000)]
    return data


@pytest.mark.parametrize("bits", [(10, 12), (1, 2)])
def test_edge_rows_with_any_block_size(spark, monkeypatch, bits):
    monkeypatch.setattr(T, "BLOCK_BITS", bits[0])
    monkeypatch.setattr(T, "CHUNK_BITS", bits[1])
    data = edge_rows()
    df = spark.createDataFrame(data, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS depth", "2 AS k1", "'x' AS words", "3 AS block")
    assert rows(T.prefix_trie(df.repartition(9)).select(*COLUMNS)) == brute(data)


def test_hot_parents_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(T, "HOT_PARENTS", 4)
    data = [(c, t, "u", "hello" if t == 0 else f"{c} {t}") for c in range(0, 400, 20) for t in range(2)]
    assert rows(T.prefix_trie(spark.createDataFrame(data, "conv_id long, turn int, role string, text string")).select(*COLUMNS)) == brute(data)


def test_one_long_conversation_and_plain_sequences(spark):
    data = [(0, t, "u", str(t)) for t in range(3000)] + [(20, t, "u", str(t)) for t in range(10)] + [(40, 0, "u", "0")]
    df = spark.createDataFrame(data, "conv_id int, turn long, role string, text string")
    got = T.prefix_trie(df, heads=1).filter("depth in (0, 1, 10, 11, 3000)").select(*COLUMNS)
    assert rows(got) == sorted([
        (0, 0, None, 3, 1, 1, 2 + 9, sha("")), (0, 1, 0, 3, 1, 1, 2 + 9, sha("40")), (0, 10, 0, 2, 1, 1, 1, sha("20")),
        (0, 11, 0, 1, 1, 1, 0, sha("")), (0, 3000, 0, 1, 0, 1, 0, sha("0"))], key=str)


def test_only_turnless_and_no_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 1)
    assert rows(T.prefix_trie(spark.createDataFrame([(lone, 0, "u", "x")], schema)).select(*COLUMNS)) == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]
    none = T.prefix_trie(spark.createDataFrame([], schema))
    assert none.collect() == [] and none.columns == COLUMNS
