"""Conversation prefix trie by whole-sequence collapse.

Identical rebuilt conversations become one weighted sequence, its identifiers kept as an
end list in chunks; only the least identifier of a sequence (its representative) brings its
turns along, one row per prefix. Sequences that are proper prefixes of others fall to an
anti-join, which leaves the leaves; the weighted prefixes are then added up by node.

* A prefix is named by its depth and 128 bits: the XOR over its turns of hashes of (place,
  SHA-256 of role and text), a running XOR along the conversation.
* Rows are narrow (no text is shuffled). Order numbers and running values along a
  conversation are taken block by block of turns, with the blocks' totals beside them, so a
  conversation of any length is spread over many tasks. Hot nodes are added up map side.
* A sum over a subtree needs no row per ancestor: each node hands its value to one leaf
  sequence through it, values are summed from the end of each leaf sequence backwards, and a
  node adds up the leaf sequences through it.
* The digest of an end list streams the chunks of at most 4096 identifiers in order.
* The parent of very many nodes is looked up from a broadcast of the (at most 512) parents
  that have more than 1/512 of all nodes; the others by a shuffle join.

Defined results: turns without ``conv_id`` play no part; null role or text is empty; a null
turn comes first; turns of equal number are ordered by the SHA-256 of (SHA-256 of role,
SHA-256 of text), repeated rows are turns of their own; other columns play no part; no
conversations give no rows (not even a root).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

GROUP, HEADS = 20, 4                    # conversations of a group; heads are crc32 % HEADS turns
BLOCK_BITS = 10                         # turns of a block
CHUNK_BITS = 12                         # identifiers of an end-list chunk
HOT_PARENTS = 512                       # bound on the parents that are broadcast
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "k1", "k2"]
_FIRST = -(2**63)


def _mark() -> Column:
    part = [F.sha2(F.coalesce(F.col(c).cast("string"), F.lit("")), 256) for c in ("role", "text")]
    return F.unhex(F.sha2(F.concat(*part), 256))


def _totals_before(blocks: DataFrame, sums: dict[str, Column], order) -> DataFrame:
    """Per conversation, the aggregate of the blocks before (``order``: the block, or descending)."""
    w = Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumns({name: F.coalesce(agg.over(w), F.lit(0)) for name, agg in sums.items()})


def ordered_turns(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``turns(conv_id, place, mark, words, moved)``, places from 1, ``moved`` the turn's place
    in its rebuilt conversation (null for those that the group's first turns replace), and
    ``convs(conv_id, base, h)``. Both are written."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text") \
        .filter("conv_id IS NOT NULL")
    block = F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(_FIRST)).alias("block")
    blocks = rows.groupBy("conv_id", block).agg(F.count(F.lit(1)).alias("n"))
    blocks = stored(_totals_before(blocks, {"before": F.sum("n")}, F.col("block")), "turn-blocks")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    convs = blocks.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group})
    base = convs.filter("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = stored(convs.join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))), "conversations")
    blocks = blocks.join(convs.select("conv_id", "h", "head"), "conv_id")
    inner = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "mark")
    turns = rows.select("conv_id", block, "turn", _mark().alias("mark"),
                        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("words")) \
        .join(blocks, ["conv_id", "block"]).withColumn("place", F.col("before") + F.row_number().over(inner))
    moved = F.when(F.col("place") > F.col("h"), F.col("head") + F.col("place") - F.col("h"))
    return stored(turns.select("conv_id", "place", "mark", "words", moved.alias("moved")), "turns"), convs


def rebuilt(turns: DataFrame, convs: DataFrame, heads: int = HEADS) -> DataFrame:
    """Every conversation's turns after its head is replaced: ``conv_id, depth, l1, l2, words``
    (the two lanes of the turn's hash)."""
    own = turns.filter("moved IS NOT NULL").select("conv_id", F.col("moved").alias("depth"), "mark", "words")
    first = turns.filter(F.col("place") < heads).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "mark", "words")
    head = convs.filter("h > 0").select("conv_id", "base", "h").join(first, "base").filter("depth <= h")
    return own.unionByName(head.select("conv_id", "depth", "mark", "words")).select(
        "conv_id", "depth", *[F.xxhash64(F.lit(i), "depth", "mark").alias(f"l{i}") for i in (1, 2)], "words")


def end_digests(whole: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's identifiers, ascending and joined by commas: chunks of
    neighbouring identifiers are strings of bounded size, streamed through the hash."""
    chunk = whole.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")) \
        .agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids"))

    def stream(batches):
        now, state = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if key != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield _batch(out)
        if now is not None:
            yield _batch([(*now, state.hexdigest())])

    return chunk.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids") \
        .mapInArrow(stream, "depth long, k1 long, k2 long, ends_sha256 string")


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_pydict({**{n: pa.array(c, pa.int64()) for n, c in zip(KEY, columns)}, "ends_sha256": pa.array(columns[3], pa.string())})


def _prefixes(rows: DataFrame) -> DataFrame:
    """``rows`` with the names of the prefix that a turn ends (``k1, k2``) and of the one
    before it (``p1, p2``): a running XOR, block by block."""
    rows = rows.withColumn("block", F.shiftright("depth", BLOCK_BITS))
    sums = {f"b{i}": F.bit_xor(f"t{i}") for i in (1, 2)}
    blocks = _totals_before(rows.groupBy("conv_id", "block").agg(*[F.bit_xor(f"l{i}").alias(f"t{i}") for i in (1, 2)]), sums, F.col("block"))
    inner = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(blocks.drop("t1", "t2"), ["conv_id", "block"])
    out = out.withColumns({f"k{i}": F.col(f"b{i}").bitwiseXOR(F.bit_xor(f"l{i}").over(inner)) for i in (1, 2)})
    return out.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"l{i}")) for i in (1, 2)}).drop("block", "b1", "b2", "l1", "l2")


def _sums_to_the_end(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over its turn and all later ones, block by block."""
    rows = rows.withColumn("block", F.shiftright("depth", BLOCK_BITS))
    blocks = _totals_before(rows.groupBy("conv_id", "block").agg(F.sum(value).alias("t")), {"b": F.sum("t")}, F.col("block").desc())
    inner = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(blocks.drop("t"), ["conv_id", "block"]).withColumn(name, F.col("b") + F.sum(value).over(inner)).drop("block", "b")


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    return left.join(right, KEY, how)


def prefix_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. ``heads=1`` leaves the
    conversations as they are."""
    prepare(conversations.sparkSession)
    turns, convs = ordered_turns(conversations, group, heads)
    rows = stored(rebuilt(turns, convs, heads), "rebuilt-turns")
    whole = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("depth"), *[F.bit_xor(f"l{i}").alias(f"k{i}") for i in (1, 2)])
    whole = stored(convs.select("conv_id").join(whole, "conv_id", "left").na.fill(0, KEY), "whole")   # turnless ones too
    top = whole.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    sequences = stored(whole.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")

    # a row per prefix of every distinct sequence
    prefixes = stored(_prefixes(rows.join(sequences.select("conv_id", "weight"), "conv_id")), "prefixes")
    nodes = stored(prefixes.groupBy(*KEY).agg(F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
                                              F.min("p1").alias("p1"), F.min("p2").alias("p2")), "nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = stored(nodes.groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children")), "children")

    # leaves: sequences that are no proper prefix; then sums over subtrees
    leaves = _same(sequences, children.select(*KEY), "left_anti").filter("depth > 0").select("conv_id")
    through = stored(prefixes.select("conv_id", *KEY).join(leaves, "conv_id", "left_semi"), "leaf-prefixes")
    counted = stored(_same(nodes, through.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_leaves"), F.min("conv_id").alias("owner")), "inner"), "counted-nodes")
    value = counted.select(F.col("owner").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("value"))
    along = through.join(value, ["conv_id", "depth"], "left").na.fill(0, ["value"])
    saved = _sums_to_the_end(along, "value", "saved").groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"))

    # the parent's least member
    total = counted.count()
    names = counted.select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    hot = _same(names, children.filter(F.col("n_children") * HOT_PARENTS > total).select(*KEY), "left_semi")
    up = ["p_depth", "p1", "p2"]
    as_parent = [F.col(a).alias(b) for a, b in zip(KEY, up)]
    below = counted.withColumn("p_depth", F.col("depth") - 1).join(F.broadcast(hot.select(*as_parent, F.col("parent_conv_id").alias("hot_parent"))), up, "left")
    first = F.col("depth") == 1
    known = below.filter(first | F.col("hot_parent").isNotNull()).withColumn("parent_conv_id", F.when(first, F.lit(top[1])).otherwise(F.col("hot_parent")))
    others = below.filter(~first & F.col("hot_parent").isNull()).join(names.select(*as_parent, "parent_conv_id"), up)
    made = ["conv_id", *KEY, "parent_conv_id", "n_convs", "n_leaves"]
    found = _same(known.select(*made).unionByName(others.select(*made)), saved, "inner")

    # the root: all conversations; its sums are those of its children
    if not top[0]:
        return found.select("conv_id", "depth", "parent_conv_id", "n_convs", F.lit(0).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                            F.lit("").alias("ends_sha256"))
    root = found.filter(first).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).select(
        F.lit(top[1]).cast("long").alias("conv_id"), *[F.lit(0).cast("long").alias(c) for c in KEY], F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(top[0]).cast("long").alias("n_convs"), F.coalesce("l", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("s", F.lit(0)).cast("long").alias("saved_tokens"))
    full = _same(_same(found.unionByName(root, allowMissingColumns=True), children, "left"), end_digests(whole), "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                       "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def trie_sql() -> str:
    """DuckDB SQL for the rows of :func:`prefix_trie` on ``conversations``."""
    bit = "lambda c, i: xor(c >> 1, 3988292384 * (c & 1))"
    crc = f"""xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(conv_id::VARCHAR)::BIGINT + 1), lambda j: ascii(substr(conv_id::VARCHAR, j, 1))::BIGINT),
                  lambda s, b: list_reduce([xor(s, b)] || range(8), {bit})), 4294967295)"""
    return f"""
        WITH t AS (SELECT conv_id, turn, sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS mark,
                          len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words FROM conversations WHERE conv_id IS NOT NULL),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS p FROM t),
        c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {crc} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
        r AS (SELECT c.conv_id, 0 AS own, o.p, mark, words FROM c JOIN o ON o.conv_id = c.base AND o.p <= c.h
              UNION ALL SELECT c.conv_id, 1, o.p, mark, words FROM c JOIN o ON o.conv_id = c.conv_id AND o.p > c.h),
        x AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(mark, '') OVER w AS k, left(k, -64) AS pk, words FROM r
              WINDOW w AS (PARTITION BY conv_id ORDER BY own, p ROWS UNBOUNDED PRECEDING)
              UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM c),
        n AS (SELECT depth, k, pk, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM x GROUP BY ALL),
        b AS (SELECT pk, count(*) AS n_children FROM n WHERE pk IS NOT NULL GROUP BY pk),
        m AS (SELECT n.*, b.n_children FROM n LEFT JOIN b ON b.pk = n.k),
        s AS (SELECT n.k, count(*) FILTER (m.n_children IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved_tokens
              FROM n JOIN m ON starts_with(m.k, n.k) GROUP BY n.k),
        e AS (SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
              FROM (SELECT conv_id, arg_max(k, depth) AS k FROM x GROUP BY conv_id) GROUP BY k)
        SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, coalesce(m.n_children, 0) AS n_children, s.n_leaves::BIGINT AS n_leaves,
               s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
        FROM m JOIN s ON s.k = m.k LEFT JOIN n AS up ON up.k = m.pk LEFT JOIN e ON e.k = m.k"""
