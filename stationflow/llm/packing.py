"""Vector bin packing of examples into training sequences.

Each example has three sizes: tokens, one segment, and loss-bearing tokens; a sequence
has a limit on each. The dot-product heuristic fills one sequence at a time: among the
examples that still fit on every axis it takes the one whose size vector has the largest
weighted dot product with what is left of the sequence, the weights being the total
demand per axis. Examples of equal sizes are interchangeable, so a step looks at the
distinct size vectors only.

At scale the examples are dealt into groups of about ``group_rows`` by a hash, and each
group is packed by itself: one shuffle of narrow rows (no text or ids), a bounded group,
and at most one sequence per group that is left unfilled for want of partners.

Defined results: null or empty texts hold the closing id only; a null ``doc_id`` stays
null; repeated rows are packed as rows of their own; an empty table gives no rows; other
columns are ignored. Examples above a limit raise an error (``cut`` documents first).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_bpe
from .common import groups_for, prepare

CAPACITY = 1024
MAX_SEGMENTS = 256
GROUP_ROWS = 8192

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def dot_product_pack(tokens, loss, capacity=(CAPACITY, MAX_SEGMENTS, CAPACITY)):
    """Sequence number and token offset of each example, for limits ``(tokens, segments,
    loss-bearing tokens)``."""
    sizes = np.column_stack([np.asarray(tokens), np.ones(len(tokens), int), np.asarray(loss)]).astype(np.int64)
    cap = np.asarray(capacity, dtype=np.int64)
    if len(sizes) and (sizes > cap).any():
        raise ValueError("an example is larger than a sequence")
    kinds, of = np.unique(sizes, axis=0, return_inverse=True)
    of = of.reshape(-1)
    order = np.argsort(of, kind="stable")
    left = np.bincount(of, minlength=len(kinds))
    nxt = np.concatenate([[0], np.cumsum(left)[:-1]]).astype(np.int64)
    share = kinds / cap
    weight = (share * left[:, None]).sum(axis=0)
    weighted = share * (weight / max(weight.sum(), 1e-12))
    seq = np.zeros(len(sizes), np.int64)
    offset = np.zeros(len(sizes), np.int64)
    bin_no, todo = 0, len(sizes)
    while todo:
        room = cap.copy()
        while True:
            fits = (left > 0) & (kinds <= room).all(axis=1)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, weighted @ (room / cap), -1.0)))
            # as many of this kind as stay the best choice would cost a re-scan; one at a time
            row = order[nxt[k]]
            nxt[k] += 1
            left[k] -= 1
            todo -= 1
            seq[row], offset[row] = bin_no, cap[0] - room[0]
            room = room - kinds[k]
        bin_no += 1
    return seq, offset


def pack_examples(examples: DataFrame, tokens: str = "length", loss: str = "loss_tokens", group: str = "_group",
                  capacity=(CAPACITY, MAX_SEGMENTS, CAPACITY)) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``examples``, packing each value of ``group``
    by itself. ``sequence_id`` is unique over all groups."""
    fields = [f for f in examples.schema.fields if f.name != group]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"

    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        # a fixed order, so that a repeated task gives the same sequences
        rows = rows.sort_values(names, kind="stable", ignore_index=True)
        seq, offset = dot_product_pack(rows[tokens], rows[loss], capacity)
        return rows[names].assign(sequence_id=(int(key[0]) << 32) + seq, offset=offset)

    return examples.groupBy(group).applyInPandas(pack, schema)


def cut_documents(docs: DataFrame, groups: int, capacity: int = CAPACITY, end_id: int = 0,
                  ranks_file: str | None = None) -> DataFrame:
    """Token counts of every document, cut into pieces of ``capacity`` ids and a rest,
    with the packing group of each piece. Ids never leave the map task."""

    def cut(batches):
        bpe, tail, row = byte_bpe(ranks_file), int(end_id).to_bytes(4, "little"), 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = bpe.pack(text or "") + tail
                n = len(ids) // 4
                row += 1
                # the row number spreads repeated ids; a document's pieces share a group
                g = zlib.crc32(f"{doc_id}:{row}".encode()) % groups
                for start in range(0, n, capacity):
                    part = ids[4 * start: 4 * (start + capacity)]
                    out.append((doc_id, start, len(part) // 4, zlib.crc32(part), n, g))
            df = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_group"])
            yield df.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut, PIECES + ", _group long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS,
                   max_loss: int | None = None, group_rows: int = GROUP_ROWS,
                   ranks_file: str | None = None) -> DataFrame:
    """One row per piece: where its ids lie in the document, and in which sequence and at
    which offset they go. In plain documents every token bears loss."""
    prepare(docs.sparkSession)
    groups = groups_for(docs.count(), group_rows)
    pieces = cut_documents(docs, groups, capacity, ranks_file=ranks_file).withColumn("loss_tokens", F.col("length"))
    return pack_examples(pieces, capacity=(capacity, max_segments, max_loss or capacity)).drop("loss_tokens")
