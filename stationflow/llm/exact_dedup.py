"""Exact dedup: sorted digest runs, merged along a tree of binomial exchange rounds.

Every partition turns its texts into runs: the sorted distinct digests, each with how many
rows carry it and the identifier that stays. The runs are nodes numbered in base ``fan``.
In round ``r`` the nodes that differ in digit ``r`` only exchange: each sends every partner
the piece of its run whose digests belong there and merges the pieces it receives, so that
equal digests become one entry with the better identifier. After ``log(nodes, fan)`` rounds
a digest is in one place, whatever number of rows has it; a node never holds more entries
than distinct digests fell to it, since copies are merged at every level. The answers go
back the same way, piece by piece, so a hot digest is told once per run and not per row.

A digest is the SHA-256 of the text, verified at every level against the text's length
and CRC-32: entries merge only when all three agree.

Defined results: null text counts as empty; a null identifier is worse than any other;
of rows with equal text and equal identifiers, one stays (the first in the lowest run);
columns other than the two named ones play no part; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

RUN_ROWS = 32_768       # rows of a run: a few MB
FAN = 16                # partners of a round at most
KEY = np.dtype("S40")   # SHA-256, CRC-32, length; equal lengths, so the type's padding plays no part

RUNS = "node long, keys binary, counts binary, ids binary, known binary"
PIECES = "node long, src long, keys binary, counts binary, ids binary, known binary, origin binary"
ANSWERS = "node long, src long, counts binary, ids binary, known binary, origin binary"


class Entries:
    """Digests in order, each with its rows, its best identifier and the run that has it."""

    FIELDS = (("keys", KEY), ("counts", np.int64), ("ids", np.int64), ("known", np.uint8), ("origin", np.int64))

    def __init__(self, keys, counts, ids, known, origin):
        self.keys, self.counts, self.ids, self.known, self.origin = keys, counts, ids, known, origin

    @classmethod
    def read(cls, rows: list[dict]) -> Entries:
        return cls(*(np.concatenate([np.zeros(0, t), *(np.frombuffer(r[n], t) for r in rows if n in r)]) for n, t in cls.FIELDS))

    def __getitem__(self, at) -> Entries:
        return Entries(*(getattr(self, n)[at] if len(getattr(self, n)) else getattr(self, n) for n, _ in self.FIELDS))

    def packed(self, *names: str) -> tuple:
        return tuple(getattr(self, n).tobytes() for n in names)

    def merged(self, largest: bool) -> Entries:
        """One entry a digest: sums of rows, the best identifier and the lowest run that has it."""
        if not len(self.keys):
            return self
        own = self[np.argsort(self.keys, kind="stable")]           # merges the sorted runs
        edge = np.flatnonzero(np.append(True, own.keys[1:] != own.keys[:-1]))
        of = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(own.keys))))
        known = np.maximum.reduceat(own.known, edge)
        bound = np.iinfo(np.int64)
        pick, worst = (np.maximum, bound.min) if largest else (np.minimum, bound.max)
        ids = pick.reduceat(np.where(own.known == 1, own.ids, worst), edge)
        best = (own.known == known[of]) & ((own.known == 0) | (own.ids == ids[of]))
        origin = np.minimum.reduceat(np.where(best, own.origin, bound.max), edge)
        return Entries(own.keys[edge], np.add.reduceat(own.counts, edge), ids, known, origin)


class Tree:
    """The rounds: ``depth`` digits in base ``fan``, the first one changed first."""

    def __init__(self, nodes: int, fan: int = FAN):
        self.depth = 1
        while fan ** self.depth < nodes:
            self.depth += 1
        self.fan = 1
        while self.fan ** self.depth < nodes:
            self.fan += 1

    def unit(self, level: int) -> int:
        return self.fan ** (self.depth - level)

    def digit(self, node: int, level: int) -> int:
        return node // self.unit(level) % self.fan

    def pieces(self, node: int, entries: Entries, level: int):
        """What a node sends in round ``level``: ``(partner, entries)``."""
        head = entries.keys.view(np.uint8).reshape(-1, KEY.itemsize)[:, :4].copy().view(">u4").ravel().astype(np.uint64)
        home = (head * np.uint64(self.fan ** self.depth)) >> np.uint64(32)      # the node a digest ends at; follows the order
        to = (home // np.uint64(self.unit(level)) % np.uint64(self.fan)).astype(np.int64)
        own = self.digit(node, level)
        ends = np.searchsorted(to, np.arange(self.fan + 1))
        for d, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            if a < b:
                yield node + (d - own) * self.unit(level), entries[a:b]


def _rows(table: pa.Table) -> list[dict]:
    return table.to_pylist()


def _table(rows, schema: str) -> pa.Table:
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64() if t == "long" else pa.binary()) for (n, t), c in zip(names, columns)})


def _make_runs(run_rows: int):
    def pack(keys, ids, known, part, seq):
        order = np.argsort(keys, kind="stable")
        _, counts = np.unique(keys, return_counts=True)
        return pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int64()), "seq": pa.array([seq], pa.int64()),
            **{n: pa.array([v.tobytes()], pa.binary()) for n, v in (
                ("keys", np.unique(keys)), ("counts", counts.astype(np.int64)), ("ids", ids[order]), ("known", known[order]))}})

    def runs(batches):
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            digest, check, size, ids = (batch.column(i) for i in range(4))
            raw = np.zeros((batch.num_rows, KEY.itemsize), np.uint8)
            raw[:, :32] = np.frombuffer(b"".join(digest.to_pylist()), np.uint8).reshape(-1, 32)
            raw[:, 32:36] = check.to_numpy(zero_copy_only=False).astype(">u4").view(np.uint8).reshape(-1, 4)
            raw[:, 36:] = size.to_numpy(zero_copy_only=False).astype(">u4").view(np.uint8).reshape(-1, 4)
            known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
            held.append((raw.view(KEY).ravel(), ids.fill_null(0).to_numpy(zero_copy_only=False), known))
            n += batch.num_rows
            if n >= run_rows:
                yield pack(*(np.concatenate(c) for c in zip(*held)), part, seq)
                seq, held, n = seq + 1, [], 0
        if n:
            yield pack(*(np.concatenate(c) for c in zip(*held)), part, seq)

    return runs


def _run_entries(row: dict, largest: bool) -> Entries:
    """A run's distinct digests with the best identifier of each."""
    keys, counts = np.frombuffer(row["keys"], KEY), np.frombuffer(row["counts"], np.int64)
    ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], np.uint8)
    n = len(ids)
    return Entries(np.repeat(keys, counts), np.ones(n, np.int64), ids, known, np.full(n, row["node"], np.int64)).merged(largest)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                     normalise=None, run_rows: int = RUN_ROWS, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (long), ``keep_id`` (identifier of the row that
    stays), ``group_size`` (rows with the same text), ``kept``, ``text_sha256`` (of the
    normalised text). ``keep`` is ``"largest"`` or ``"smallest"`` identifier; ``normalise``
    maps the text column to the one compared (default: no change)."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    largest = keep == "largest"
    prepare(docs.sparkSession)
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if normalise is not None:
        text = F.coalesce(normalise(text), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    digests = named.select(F.unhex(F.sha2("text", 256)).alias("digest"), F.crc32(F.col("text").cast("binary")).alias("check"),
                           F.octet_length("text").cast("long").alias("size"), "id")
    runs = stored(digests.mapInArrow(_make_runs(run_rows), RUNS.replace("node long", "part long, seq long")), "digest-runs")
    ends = runs.agg(F.max("part"), F.max("seq")).first()
    parts, most = (ends[0] or 0) + 1, (ends[1] or 0) + 1
    runs = runs.withColumn("node", F.col("seq") * parts + F.col("part")).drop("part", "seq")
    tree = Tree(parts * most, fan)

    def send_first(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = [(to, row["node"], *e.packed("keys", "counts", "ids", "known", "origin"))
                       for to, e in tree.pieces(row["node"], _run_entries(row, largest), 1)]
                yield from _table(out, PIECES).to_batches()

    def merge_and_send(level):
        def send(key, table):
            node = key[0].as_py()
            own = Entries.read(_rows(table)).merged(largest)
            return _table([(to, node, *e.packed("keys", "counts", "ids", "known", "origin"))
                           for to, e in tree.pieces(node, own, level)], PIECES)
        return send

    def answer(rows: list[dict], own: Entries) -> list[tuple]:
        """For each piece a node received, what became of its digests."""
        found = []
        for r in rows:
            e = own[np.searchsorted(own.keys, np.frombuffer(r["keys"], KEY))]
            found.append((r["src"], r["node"], *e.packed("counts", "ids", "known", "origin")))
        return found

    def answer_last(key, table):
        rows = _rows(table)
        return _table(answer(rows, Entries.read(rows).merged(largest)), ANSWERS)

    def answer_back(key, table, told):
        rows = _rows(table)
        own = Entries.read(rows).merged(largest)
        back = Entries.read(sorted(_rows(told), key=lambda r: r["src"]))       # partners in the order of their digests
        return _table(answer(rows, Entries(own.keys, back.counts, back.ids, back.known, back.origin)), ANSWERS)

    # up: pieces of round 1, 2, ... by the node that receives them; each level is written, so that
    # the way back and a lost executor read it instead of merging again
    sent = [stored(runs.mapInArrow(send_first, PIECES), "digest-pieces")]
    for level in range(2, tree.depth + 1):
        sent.append(stored(sent[-1].groupBy("node").applyInArrow(merge_and_send(level), PIECES), "digest-pieces"))
    told = sent[-1].groupBy("node").applyInArrow(answer_last, ANSWERS)
    for pieces in reversed(sent[:-1]):
        told = pieces.groupBy("node").cogroup(told.groupBy("node")).applyInArrow(answer_back, ANSWERS)

    def decide(key, table, told):
        row = _rows(table)[0]
        keys, n = np.frombuffer(row["keys"], KEY), np.frombuffer(row["counts"], np.int64)
        ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], np.uint8)
        back = Entries.read(sorted(_rows(told), key=lambda r: r["src"]))
        of = np.repeat(np.arange(len(keys)), n)
        match = (back.origin[of] == row["node"]) & (known == back.known[of]) & ((known == 0) | (ids == back.ids[of]))
        at = np.flatnonzero(match)
        stays = np.zeros(len(ids), bool)
        stays[at[np.unique(of[at], return_index=True)[1]]] = True              # one row of a digest, once
        digest = [k.tobytes() for k in keys.view(np.uint8).reshape(-1, KEY.itemsize)[:, :32]]
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=known == 0), "keep_id": pa.array(back.ids[of], pa.int64(), mask=back.known[of] == 0),
            "group_size": pa.array(back.counts[of]), "kept": pa.array(stays), "digest": pa.array(digest, pa.binary()).take(pa.array(of))})

    found = runs.groupBy("node").cogroup(told.groupBy("node")) \
        .applyInArrow(decide, "doc_id long, keep_id long, group_size long, kept boolean, digest binary")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def duplicates_sql() -> str:
    """DuckDB SQL for the rows of :func:`exact_duplicates` on ``documents``."""
    return """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
