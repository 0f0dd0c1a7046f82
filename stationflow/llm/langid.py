"""Language identification by partial matching: per language a variable-order context
tree over bytes, whose escape probabilities make every text's exact code length.

The code length of a byte in its longest known context (up to ``ORDER`` bytes) is
``-log2(c / (T + D))`` if the byte was seen there ``c`` times among ``T`` (``D`` distinct
bytes), else the escape cost ``-log2(D / (T + D))`` plus its code length one context
shorter, down to a uniform code. Statistics are frozen after training, so that a tree
becomes two lookup tables (context -> node, node x byte -> code length) and a whole text
is scored by array lookups. The language with the shortest code wins; ``score`` is its
share of the probability the codes stand for.

Training reads a bounded sample of labelled rows (``SAMPLE_ROWS`` per language, drawn by a
hash of ``doc_id``); counting runs as one group per language, and what is broadcast is
bounded by ``MAX_CONTEXTS`` per language and order. Every text is scored whole.

Defined results: ``und`` with score 0 for null texts and texts without a letter (or if
there is no labelled row); ties go to the first language by name; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored. A null
``doc_id`` is neither held out nor learned from.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, slices

ORDER = 3
SAMPLE_ROWS = 400
MAX_CONTEXTS = 40_000     # per language and order, the most frequent
SYMBOLS = 128             # distinct bytes of the model; rarer ones share symbol 0
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
_LEAD = bytes(ORDER)      # what stands before a text


def _trim(text: str) -> bytes:
    return text.encode("utf-8", "replace").lower()


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows a language, at most ``rows``: a hash threshold per language is
    applied in the scan, the rest of the cut on what is left."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return labelled
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1_000_000, 1 + 1_250_000 * rows // n)))])
    few = labelled.filter(draw < share[F.col("lang")])
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "doc_id", "text"))
    return few.withColumn("_turn", turn).filter(F.col("_turn") <= rows).drop("_turn")


def _count(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Counts of every byte after every context of 0..ORDER bytes, for one language. A
    context of k bytes and the byte after it are one integer of k + 1 bytes."""
    data = np.frombuffer(b"".join(_LEAD + _trim(t) for t in rows["text"]), np.uint8).astype(np.int64)
    sizes = np.array([len(_trim(t)) for t in rows["text"]])
    real = np.ones(len(data), bool)
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]])
    for i in range(ORDER):
        real[starts + i] = False
    at = np.flatnonzero(real)
    out = []
    for k in range(ORDER + 1):
        gram = np.zeros(len(at), np.int64)
        for i in range(k, -1, -1):
            gram = gram << 8 | data[at - i]
        grams, n = np.unique(gram, return_counts=True)
        if k:
            contexts, of = np.unique(grams >> 8, return_inverse=True)
            total = np.bincount(of, n)
            if len(contexts) > MAX_CONTEXTS:
                kept = np.zeros(len(contexts), bool)
                kept[np.argsort(-total, kind="stable")[:MAX_CONTEXTS]] = True
                grams, n = grams[kept[of]], n[kept[of]]
        out.append((key[0], k, grams.astype("<i4").tobytes(), n.astype("<i4").tobytes()))
    return pd.DataFrame(out, columns=["lang", "k", "grams", "n"])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Frozen counts ``{lang: [(grams, counts) per order]}`` from ``docs(doc_id, text,
    lang)``; rows without text or label are not used."""
    labelled = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = _sample(labelled, sample_rows).groupBy("lang").applyInPandas(_count, "lang string, k int, grams binary, n binary").collect()
    model: dict = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["k"])):
        model.setdefault(r["lang"], []).append((bytes(r["grams"]), bytes(r["n"])))
    return model


class Trees:
    """The lookup tables of a model."""

    def __init__(self, model: dict):
        self.langs = sorted(model)
        counts = {k: [(np.frombuffer(g, "<i4").astype(np.int64) & 0xFFFFFFFF, np.frombuffer(n, "<i4").astype(np.float64))
                      for g, n in orders] for k, orders in model.items()}
        seen = np.zeros(256)
        for orders in counts.values():
            np.add.at(seen, orders[0][0], orders[0][1] / orders[0][1].sum())
        seen[0] = 0
        top = [b for b in np.argsort(-seen, kind="stable")[:SYMBOLS - 1] if seen[b]]
        self.symbol = np.zeros(256, np.int32)
        self.symbol[top] = np.arange(1, len(top) + 1)
        self.a = len(top) + 1
        self.tables = [self._tables(counts[k]) for k in self.langs]

    def _tables(self, orders):
        a, order = self.a, len(orders) - 1
        cost = np.full((1, a), np.log2(a), np.float32)           # the uniform code
        node_of = np.zeros(1, np.int32)                           # by the last k symbols
        all_costs = [cost]
        for k, (grams, n) in enumerate(orders):
            syms = np.zeros(len(grams), np.int64)
            for i in range(k, -1, -1):
                syms = syms * a + self.symbol[(grams >> (8 * i)) & 255]
            syms, of = np.unique(syms, return_inverse=True)       # bytes that share symbol 0 add up
            n = np.bincount(of, n)
            contexts, ctx = np.unique(syms // a, return_inverse=True)
            total = np.bincount(ctx, n) + np.bincount(ctx)        # T + D
            escape = np.log2(total / np.bincount(ctx))
            if k:
                prior, prior_of = self._lookup(all_costs, node_of, contexts % (a ** (k - 1)))
            else:
                prior, prior_of = all_costs[0], np.zeros(len(contexts), np.int64)
            cost = prior[prior_of] + escape[:, None].astype(np.float32)
            cost[ctx, syms % a] = np.log2(total[ctx] / n)
            base = sum(map(len, all_costs))
            longer = np.tile(node_of, a) if k else node_of        # the shorter context's node, unless known
            longer = longer.copy()
            longer[contexts] = base + np.arange(len(contexts))
            node_of = longer
            all_costs.append(cost.astype(np.float32))
        return node_of, np.concatenate(all_costs).ravel(), order

    @staticmethod
    def _lookup(all_costs, node_of, context):
        return np.concatenate(all_costs), node_of[context]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language's tree."""
        pieces, owner = [], []
        for i, t in enumerate(texts):
            for at in range(0, len(t), SLICE_BYTES):              # each piece with what stands before it
                pieces.append((t[at - ORDER: at] if at else _LEAD) + t[at: at + SLICE_BYTES])
                owner.append(i)
        bits = np.zeros((len(texts), len(self.langs)))
        for lo, hi in slices([len(p) for p in pieces], SLICE_BYTES):
            sizes = np.array([len(p) for p in pieces[lo:hi]])
            s = self.symbol[np.frombuffer(b"".join(pieces[lo:hi]), np.uint8)]
            ends = np.cumsum(sizes)
            edges = np.column_stack([ends - sizes + ORDER, ends]).ravel()
            context = (s[:-3] * self.a + s[1:-2]) * self.a + s[2:-1]
            for j, (node_of, cost, _) in enumerate(self.tables):
                each = np.zeros(len(s) + 1)
                each[ORDER:-1] = cost[node_of[context].astype(np.int64) * self.a + s[ORDER:]]
                np.add.at(bits[:, j], owner[lo:hi], np.add.reduceat(each, edges)[::2])
        return bits


@lru_cache(maxsize=2)
def _trees(frozen: tuple) -> Trees:
    return Trees({k: list(v) for k, v in frozen})


def predict(docs: DataFrame, model: dict, names=("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and the score added under ``names``; its other columns pass
    through."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple((k, tuple(v)) for k, v in sorted(model.items())))
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{names[0]}` string, `{names[1]}` double"

    def score(batches):
        import pyarrow as pa

        trees = _trees(shared.value) if shared.value else None
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            known = np.array([trees is not None and any(map(str.isalpha, t)) for t in texts], bool)
            pred, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known.any():
                at = np.flatnonzero(known)
                bits = trees.code_lengths([_trim(texts[i]) for i in at])
                best = bits.argmin(axis=1)
                value[at] = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
                for i, b in zip(at, best):
                    pred[i] = trees.langs[b]
            columns = [batch.column(f.name) for f in kept] + [pa.array(pred, pa.string()), pa.array(value)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + list(names))

    return docs.select([f.name for f in kept]).mapInArrow(score, schema)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, names=("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and the score, by trees learned from its own labelled rows
    outside the held-out fold."""
    prepare(docs.sparkSession)
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("doc_id").isNotNull() & ~held_out())
    return predict(docs, train(labelled, sample_rows), names)


def identify_documents(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    prepare(docs.sparkSession)
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("doc_id").isNotNull() & ~held_out())
    found = predict(docs.select("doc_id", "text"), train(labelled, sample_rows))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
