import hashlib

import pytest
from pyspark.sql import functions as F

from stationflow.llm import exact_dedup as X
from stationflow.llm.queries import op13_exact_dedup

from .helpers import duck, rows

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(pairs, best=max):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, left = best(known) if known else None, 1
        for i in ids:
            out.append((i, keep, len(ids), bool(i == keep and left), hashlib.sha256(t.encode()).hexdigest()))
            left -= i == keep and left
    return sorted(out, key=str)


def test_query_equals_sql(spark, sf_dir):
    assert rows(op13_exact_dedup(spark, sf_dir).select(*COLUMNS)) == sorted(duck(sf_dir, X.duplicates_sql()), key=str)


@pytest.mark.parametrize("keep, best, parts, run_rows, fan", [("largest", max, 9, 7, 2), ("smallest", min, 5, 3, 3), ("largest", max, 1, 100, 16)])
def test_edge_rows_in_every_tree(spark, keep, best, parts, run_rows, fan):
    """A hot text with a third of all rows, nulls, empties, null and repeated ids, long texts."""
    pairs = [(i, "hot") for i in range(60)] + [(None, "no id"), (None, "no id"), (1000, None), (1001, ""), (5, "hot"), (7, "seven"), (7, "seven"), (7, "other")]
    pairs += [(2000 + i, f"text {i % 40}") for i in range(90)] + [(9999, "x" * 300_000), (-4, "x" * 300_000), (-4, "été\n"), (3, "ete\n"), (8, "a\x00"), (9, "a")]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(parts)
    got = X.exact_duplicates(df, keep=keep, run_rows=run_rows, fan=fan)
    assert rows(got) == brute(pairs, best)
    assert got.filter("kept").count() == len({t or "" for _, t in pairs})


def test_clashing_columns_and_normalised_texts(spark):
    df = spark.createDataFrame([(1, " A b ", 1, "x"), (2, "a b", 2, "y")], "doc_id int, text string, kept int, node string") \
        .withColumns({"keys": F.lit(1), "group_size": F.lit("z"), "text_sha256": F.lit("w")})
    got = X.exact_duplicates(df, normalise=lambda t: F.lower(F.trim(t)))
    assert rows(got.select("doc_id", "keep_id", "kept")) == [(1, 2, False), (2, 2, True)]
    assert {r[0] for r in got.select("text_sha256").collect()} == {hashlib.sha256(b"a b").hexdigest()}


def test_no_rows(spark):
    got = X.exact_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert got.collect() == [] and tuple(got.columns) == COLUMNS


def test_a_round_changes_one_digit():
    tree = X.Tree(20, 3)
    assert (tree.depth, tree.fan) == (3, 3) and X.Tree(1).fan == 1 and X.Tree(17, 16).fan == 5
    assert [tree.digit(14, r) for r in (1, 2, 3)] == [1, 1, 2]
