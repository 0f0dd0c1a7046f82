"""Suffix-array dedup: remove every byte that lies in a string of ``min_len`` bytes which
also starts in a document with a smaller ``doc_id``.

How equal strings meet without shuffling every suffix:

1. Anchors. Of the ``W = min_len - K + 1`` grams of K bytes inside a window of ``min_len``
   bytes, the one of least hash is the window's anchor. Equal windows have equal anchors,
   and windows in a row mostly share one (about one anchor per ``(W + 1) / 2`` bytes).
2. Documents lie in chunks of about ``CHUNK_BYTES`` (a hash of ``doc_id``). Each chunk sends
   its distinct anchors as packed 32-bit fingerprints, by buckets of the hash, each with a
   hash of the stretch of text whose windows belong to it. A bucket answers with bits: does
   another chunk have the anchor, and is the stretch the same string everywhere?
3. Equal strings are one: for a stretch that is the same everywhere, chunks send its
   fingerprint and smallest ``doc_id`` only. Where stretches differ, they send the strings,
   once for each distinct one, with its smallest ``doc_id``. Anchors with more strings than a
   bucket can sort in bounded memory go window by window instead, dealt by the window's hash,
   so that no bucket gathers all surroundings of a common phrase.
4. Each bucket builds the suffix array of its distinct strings (two-stage sorting), reads
   groups of equal windows off the adjacent common prefixes, and answers with one bit per
   window: does it start in a smaller document?
5. Chunks mark the covered bytes.

The text is shuffled once (the three uses share one exchange); answers are bits. Groups are
bounded by bytes, not by keys, and their number follows the input.

Defined results: null or empty texts have 0 bytes; a row with a null ``doc_id`` keeps its
text and removes nothing elsewhere; rows with the same ``doc_id`` do not remove each other's
text; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import zlib

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, groups_for, mix64, odd_constants, prepare, total_bytes
from .suffix_array import shares_prefix, suffix_array

MIN_LEN = 50
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20      # text per bucket of anchors
SORT_BYTES = 1 << 19        # stretches sorted in one suffix array, unless one anchor has more
COMMON_CHUNKS = 256         # anchors with more strings than CHUNK_STRINGS in each of so many chunks
CHUNK_STRINGS = 256         # (65,536, about 4 MB) go window by window: it bounds what one sort takes
PIECE_BYTES = 1 << 16       # text hashed at once: its arrays stay in the processor's cache
_AT = 22                    # bits of a position within a piece buffer


_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(n: int):
    """Powers of the hash base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64), dtype=np.uint64)])
                 for x in (_BASE, inverse))


def _string_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32-bit hashes of the strings ``start .. end`` of the buffer."""
    power, inverse = _powers(1 << max(17, len(buf).bit_length()))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(byte_table(12)[buf] * power[: len(buf)], dtype=np.uint64, out=total[1:])
    return (mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes from each position on, by doubling. Only its high bits
    are mixed well."""
    mul = odd_constants(80, 41)
    power, size, level = byte_table()[buf], 1, 0
    out, done = None, 0
    while True:
        if k & size:
            if out is None:
                out, done = power, size
            else:
                n = len(buf) - done - size + 1
                out = out[:n] * mul[40 + level] + power[done: done + n]
                done += size
        if done == k:
            out = out ^ out >> np.uint64(32)                      # the high bits, which choose anchors, follow all others
            out *= np.uint64(_BASE)
            return out
        n = len(power) - size
        power = power[:n] * mul[level] + power[size:]
        size, level = size * 2, level + 1


def window_anchors(pieces: list[bytes], min_len: int, k: int):
    """Runs of windows with one anchor: ``(anchor hash, first window, windows, hash of the
    stretch)`` with positions in the joined pieces. Windows do not cross pieces."""
    buf = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(buf) - min_len + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    hashes = gram_hashes(buf, k)
    low = np.uint64((1 << _AT) - 1)
    v = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)   # least hash, leftmost of ties
    w, size = min_len - k + 1, 1
    while size * 2 <= w:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < w:
        v = np.minimum(v[: n], v[w - size: w - size + n])
    anchor = (v & low).astype(np.int64)
    valid = np.ones(n, bool)
    ends = np.cumsum([len(p) for p in pieces])[:-1]
    if len(ends):
        crossing = (ends[:, None] - np.arange(1, min_len)).ravel()
        valid[crossing[(crossing >= 0) & (crossing < n)]] = False
    new = np.append(True, anchor[1:] != anchor[:-1]) & valid
    new[1:] |= valid[1:] & ~valid[:-1]
    stop = ~valid
    cut = np.flatnonzero(new | np.append(False, stop[1:] & ~stop[:-1]))
    length = np.diff(np.append(cut, n))
    start = new[cut]
    first, count = cut[start], length[start]
    return mix64(hashes[anchor[first]]), first, count, _string_hashes(buf, first, first + count + min_len - 1)


class Chunk:
    """The documents of a chunk in order of ``doc_id``, and their anchors."""

    def __init__(self, table: pa.Table, buckets: int, min_len: int):
        ids = table.column("doc_id").to_pylist()
        data = [(t or "").encode("utf-8", "replace") for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, data[i]))
        self.order, self.min_len, self.buckets = order, min_len, buckets
        self.data = [data[i] for i in order]
        self.null = np.array([ids[i] is None for i in order], bool)
        self.ids = np.array([ids[i] or 0 for i in order], np.int64)
        self.base = np.concatenate([[0], np.cumsum([len(d) for d in self.data])]).astype(np.int64)
        self.buf = b"".join(self.data)
        k = max(1, (min_len - 2) // 2)
        batch, size, found = [], 0, []

        def flush():
            h, first, count, string = window_anchors([p for _, p in batch], min_len, k)
            begin = np.cumsum([0] + [len(p) for _, p in batch])
            of = np.searchsorted(begin, first, side="right") - 1
            found.append((h, first - begin[of] + np.array([a for a, _ in batch], np.int64)[of], count, string))

        for d, (text, base) in enumerate(zip(self.data, self.base)):
            if self.null[d]:
                continue
            for at in range(0, max(0, len(text) - min_len + 1), PIECE_BYTES):   # every window lies in one piece
                piece = text[at: at + PIECE_BYTES + min_len - 1]
                if batch and size + len(piece) > PIECE_BYTES:
                    flush()
                    batch, size = [], 0
                batch.append((int(base) + at, piece))
                size += len(piece)
        if batch:
            flush()
        if found:
            self.hash, self.first, self.count, self.string = (np.concatenate(x) for x in zip(*found))
        else:
            self.hash, self.first, self.count, self.string = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.uint32))
        self.doc = np.searchsorted(self.base, self.first, side="right") - 1
        bucket = (self.hash >> np.uint64(40)) % np.uint64(buckets)
        self.mark = bucket << np.uint64(32) | self.hash & np.uint64(0xFFFFFFFF)
        # by anchor: its runs of windows, smallest and largest document, string
        by = np.argsort(self.mark)
        edge = np.flatnonzero(np.append(True, np.diff(self.mark[by]) > 0)) if len(by) else np.zeros(0, np.int64)
        self.marks = self.mark[by[edge]]
        self.of = np.empty(len(by), np.int64)
        self.of[by] = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(by))))
        own = self.ids[self.doc[by]]
        reduce = (lambda f, x: f.reduceat(x, edge)) if len(edge) else (lambda f, x: x)
        self.least, self.several = reduce(np.minimum, own), reduce(np.minimum, own) < reduce(np.maximum, own)
        self.text = reduce(np.minimum, self.string[by])
        self.varied = self.text < reduce(np.maximum, self.string[by])

    def strings_of_varied(self) -> np.ndarray:
        """How many strings each anchor has in this chunk: one unless ``varied``."""
        rows = np.flatnonzero(self.varied[self.of])
        pairs = np.unique(self.of[rows].astype(np.uint64) << np.uint64(32) | self.string[rows])
        n = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(self.marks))
        return np.clip(n, 1, 65535).astype(np.uint16)

    def by_bucket(self, *columns):
        """``(bucket, part of each column)`` of the distinct anchors, in ascending order."""
        bucket = (self.marks >> np.uint64(32)).astype(np.int64)
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for a, b in zip(edge, [*edge[1:], len(bucket)]):
            yield (int(bucket[a]), *(c[a:b] for c in columns))

    def items(self, answers: dict):
        """What to send, given each bucket's answer ``(elsewhere, common, same)``: the anchors
        ``shared`` whose stretch is the same everywhere (as a mask), and the distinct strings
        of the others. Sets ``alike`` (anchors settled without a string), ``runs`` (of the
        other repeated anchors), ``entry`` (of each run) and ``windows_of``."""
        told = [np.zeros(len(self.marks), bool) for _ in range(3)]
        at = 0
        for bucket, marks in self.by_bucket(self.marks):
            for mask, bits in zip(told, answers.get(bucket, ())):
                mask[at: at + len(marks)] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(marks))
            at += len(marks)
        elsewhere, common, same = told
        repeated = elsewhere | self.several
        self.alike = repeated & same
        self.shared = elsewhere & same
        self.runs = np.flatnonzero((repeated & ~same)[self.of])
        strings: dict[bytes, int] = {}
        entry, docs, marks, hot = [], [], [], []
        more = self.min_len - 1
        for a, c, d, m in zip(self.first[self.runs].tolist(), self.count[self.runs].tolist(),
                              self.doc[self.runs].tolist(), self.of[self.runs].tolist()):
            s = self.buf[a: a + c + more]
            e = strings.setdefault(s, len(strings))
            if e == len(docs):                                    # documents come in order: the smallest
                docs.append(d)
                marks.append(m)
                hot.append(common[m])
            entry.append(e)
        self.entry, self.entry_doc = np.array(entry, np.int64), np.array(docs, np.int64)
        windows: dict[bytes, int] = {}
        out, window_doc, self.windows_of = [], [], {}
        for e, s in enumerate(strings):
            if hot[e]:
                self.windows_of[e] = []
                for i in range(len(s) - more):
                    w = windows.setdefault(s[i: i + self.min_len], len(windows))
                    if w == len(window_doc):
                        window_doc.append(docs[e])
                    window_doc[w] = min(window_doc[w], docs[e])
                    self.windows_of[e].append(w)
            else:
                mark = int(self.marks[marks[e]])
                out.append((mark >> 32, mark & 0xFFFF, e, s, self.ids[docs[e]]))
        self.window_ids = self.ids[np.array(window_doc, np.int64)]
        for s, w in windows.items():
            h = zlib.crc32(s)
            out.append(((h >> 16) % self.buckets, h & 0xFFFF, ~w, s, self.ids[window_doc[w]]))
        out.sort(key=lambda x: x[:3])
        return out


def _answers(table: pa.Table, *columns: str) -> dict:
    """By bucket, the answers in these columns."""
    rows = zip(*(table.column(c).to_pylist() for c in ("bucket", *columns)))
    return {b: x for b, *x in rows if x[0] is not None}


def _by_bucket(items):
    a = 0
    while a < len(items):
        b = a
        while b < len(items) and items[b][0] == items[a][0]:
            b += 1
        yield items[a][0], items[a:b]
        a = b


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``begin .. begin + size`` of each pair, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(begin - before, sizes) + np.arange(sizes.sum())


def earlier_windows(strings: list[bytes], docs: np.ndarray, min_len: int) -> np.ndarray:
    """For every window of ``min_len`` bytes of the strings, in order: is it also in a string
    of a smaller document? ``docs`` has a document per string."""
    sizes = np.array([len(s) for s in strings])
    t = np.frombuffer(b"\xff".join(strings), np.uint8)            # a byte that UTF-8 never has
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    valid = np.zeros(len(t), bool)
    valid[_ranges(begin, sizes - min_len + 1)] = True
    doc = np.repeat(docs, sizes + 1)[: len(t)]
    sa = suffix_array(t, min_len)
    sa = sa[valid[sa]]
    group = np.append(True, ~shares_prefix(t, sa[:-1], sa[1:], min_len))
    least = np.minimum.reduceat(doc[sa], np.flatnonzero(group))
    out = np.zeros(len(t), bool)
    out[sa] = least[np.cumsum(group) - 1] < doc[sa]
    return out[valid]


def remove_repeats(docs: DataFrame, min_len: int = MIN_LEN, chunk_bytes: int = CHUNK_BYTES, text_column: bool = False) -> DataFrame:
    """``docs`` (with ``doc_id, text``) without ``text``, and ``n_bytes, n_removed, n_spans``
    and ``kept`` (the remaining bytes) added. With ``text_column``, ``text`` instead of
    ``kept``: the remaining whole characters (null stays null)."""
    if min_len < 4:
        raise ValueError("min_len below 4")
    prepare(docs.sparkSession)
    size = total_bytes(docs, "text")
    chunks, buckets = groups_for(size, chunk_bytes), groups_for(size, BUCKET_BYTES)
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept").withColumn("doc_id", F.col("doc_id").cast("long"))
    rest = [f for f in docs.schema.fields if f.name != "text"]
    chunk = "_chunk"
    while chunk in docs.columns:
        chunk += "_"
    cut = docs.withColumn(chunk, F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("long")).groupBy(chunk)

    def send_marks(key, table):
        own = Chunk(table, buckets, min_len)
        rows = [(b, key[0].as_py(), m.astype(np.uint32).tobytes(), t.tobytes(), np.packbits(v).tobytes(), n[v].tobytes())
                for b, m, t, v, n in own.by_bucket(own.marks, own.text, own.varied, own.strings_of_varied())]
        return _table(rows, marks)

    def answer_marks(table):
        own = [np.frombuffer(m, np.uint32) for m in table.column("marks").to_pylist()]
        text = np.concatenate([np.frombuffer(t, np.uint32) for t in table.column("text").to_pylist()])
        varied = np.concatenate([np.unpackbits(np.frombuffer(v, np.uint8), count=len(m)).astype(bool)
                                 for v, m in zip(table.column("varied").to_pylist(), own)])
        held = np.ones(len(text), np.int64)
        held[varied] = np.concatenate([np.frombuffer(n, np.uint16) for n in table.column("strings").to_pylist()])
        values = np.concatenate(own)                              # distinct within a chunk
        by = np.argsort(values)
        edge = np.flatnonzero(np.append(True, np.diff(values[by]) > 0))
        n = np.diff(np.append(edge, len(by)))
        same = (np.minimum.reduceat(text[by], edge) == np.maximum.reduceat(text[by], edge)) & ~np.logical_or.reduceat(varied[by], edge)
        common = np.add.reduceat(held[by], edge) > COMMON_CHUNKS * CHUNK_STRINGS
        ends = np.cumsum([len(m) for m in own])[:-1]
        columns = {"chunk": table.column("chunk"), "bucket": table.column("bucket")}
        for name, mask in (("elsewhere", n > 1), ("common", common), ("same", same)):
            told = np.empty(len(by), bool)
            told[by] = np.repeat(mask, n)
            columns[name] = pa.array([np.packbits(x).tobytes() for x in np.split(told, ends)], pa.binary())
        return pa.table(columns)

    def send_strings(key, table, told):
        rows = {}
        if table.num_rows:
            own = Chunk(table, buckets, min_len)
            empty = (b"",) * 4
            for b, part in _by_bucket(own.items(_answers(told, *bits))):
                rows[b] = (b"".join(x[3] for x in part), np.array([len(x[3]) for x in part], np.int32).tobytes(),
                           np.array([x[4] for x in part], np.int64).tobytes(), np.array([x[1] for x in part], np.uint16).tobytes())
            same = {b: (m[s].astype(np.uint32).tobytes(), d[s].tobytes()) for b, m, d, s in own.by_bucket(own.marks, own.least, own.shared) if s.any()}
            rows = [(b, key[0].as_py(), *rows.get(b, empty), *same.get(b, empty[:2])) for b in sorted({*rows, *same})]
        return _table(rows, strings)

    def sort_strings(table):
        data = b"".join(table.column("bytes").to_pylist())
        sizes, docs_of, part = (np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()])
                                for c, kind in (("sizes", np.int32), ("docs", np.int64), ("part", np.uint16)))
        ends = np.cumsum(sizes, dtype=np.int64).tolist()
        seen: dict[bytes, int] = {}                               # many chunks send the same string
        of = np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip([0, *ends], ends)], np.int64)
        text = list(seen)
        least, parts = np.full(len(text), np.iinfo(np.int64).max), np.zeros(len(text), np.uint16)
        np.minimum.at(least, of, docs_of)
        parts[of] = part
        windows = np.array([len(s) - min_len + 1 for s in text], np.int64)
        order = np.argsort(parts, kind="stable")                  # strings of one anchor stay together
        found, a = [np.zeros(0, bool)], 0
        while a < len(order):
            b, size = a, 0
            while b < len(order) and (size < SORT_BYTES or parts[order[b]] == parts[order[b - 1]]):
                size += len(text[order[b]]) + 1
                b += 1
            found.append(earlier_windows([text[i] for i in order[a:b]], least[order[a:b]], min_len))
            a = b
        begin = np.empty(len(text), np.int64)                     # of each string's windows among all found
        begin[order] = np.cumsum(windows[order]) - windows[order]
        n = windows[of]
        earlier = np.concatenate(found)[_ranges(begin[of], n)] | np.repeat(docs_of > least[of], n)
        edge = np.cumsum([0] + [len(x) // 4 for x in table.column("sizes").to_pylist()])
        cut_at = np.append(0, np.cumsum(n))[edge]
        packed = [np.packbits(earlier[x:y]).tobytes() for x, y in zip(cut_at[:-1], cut_at[1:])]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "earlier": pa.array(packed, pa.binary()),
                         "same_earlier": pa.array(_first_seen(table), pa.binary())})

    marks = "bucket long, chunk long, marks binary, text binary, varied binary, strings binary"
    bits = ("elsewhere", "common", "same")
    strings = "bucket long, chunk long, bytes binary, sizes binary, docs binary, part binary, same_marks binary, same_docs binary"
    answers = cut.applyInArrow(send_marks, marks).groupBy("bucket") \
        .applyInArrow(answer_marks, "chunk long, bucket long, " + ", ".join(f"{c} binary" for c in bits))
    earlier = cut.cogroup(answers.groupBy("chunk")).applyInArrow(send_strings, strings).groupBy("bucket") \
        .applyInArrow(sort_strings, "chunk long, bucket long, earlier binary, same_earlier binary")
    void = F.lit(None).cast("binary")
    told = answers.withColumns({"earlier": void, "same_earlier": void}).unionByName(earlier.withColumns({c: void for c in bits}))

    def mark_bytes(key, table, told):
        names = [f.name for f in rest]
        own = Chunk(table, buckets, min_len)
        covered = _covered(own, _answers(told, *bits), _answers(told, "earlier", "same_earlier"))
        n_removed, n_spans, kept = [], [], []
        for a, b in zip(own.base[:-1], own.base[1:]):
            gone = covered[a:b]
            n_removed.append(int(gone.sum()))
            n_spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            kept.append(np.frombuffer(own.buf, np.uint8)[a:b][~gone].tobytes() if n_removed[-1] else own.buf[a:b])
        table = table.take(own.order)
        last = ("kept", kept, pa.binary())
        if text_column:
            last = ("text", [None if t is None else k.decode("utf-8", "ignore") for t, k in zip(table.column("text").to_pylist(), kept)], pa.string())
        table = table.select(names)
        for name, values, kind in (("n_bytes", np.diff(own.base), pa.int64()), ("n_removed", n_removed, pa.int64()),
                                   ("n_spans", n_spans, pa.int64()), last):
            table = table.append_column(name, pa.array(values, kind))
        return table

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", n_bytes long, n_removed long, n_spans long, " \
        + ("text string" if text_column else "kept binary")
    return cut.cogroup(told.groupBy("chunk")).applyInArrow(mark_bytes, schema)


def _table(rows, schema: str) -> pa.Table:
    names = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64() if t == "long" else pa.binary()) for (n, t), c in zip(names, columns)})


def _first_seen(table: pa.Table) -> list[bytes]:
    """Per row of a bucket, a bit per fingerprint: has a smaller document the same stretch?"""
    marks = [np.frombuffer(m, np.uint32) for m in table.column("same_marks").to_pylist()]
    docs = np.concatenate([np.frombuffer(d, np.int64) for d in table.column("same_docs").to_pylist()])
    if not len(docs):
        return [b""] * len(marks)
    values = np.concatenate(marks)
    by = np.argsort(values)
    edge = np.flatnonzero(np.append(True, np.diff(values[by]) > 0))
    later = np.empty(len(by), bool)
    later[by] = np.repeat(np.minimum.reduceat(docs[by], edge), np.diff(np.append(edge, len(by)))) < docs[by]
    return [np.packbits(x).tobytes() for x in np.split(later, np.cumsum([len(m) for m in marks])[:-1])]


def _covered(own: Chunk, answers: dict, earlier: dict) -> np.ndarray:
    """Which bytes of the chunk are removed."""
    items = own.items(answers)
    later = np.zeros(len(own.marks), bool)                        # of the anchors with one string everywhere
    at = 0
    for bucket, shared in own.by_bucket(own.shared):
        rows = at + np.flatnonzero(shared)
        if len(rows):
            later[rows] = np.unpackbits(np.frombuffer(earlier[bucket][1], np.uint8), count=len(rows))
        at += len(shared)
    gone = np.zeros(len(own.buf) + own.min_len + 1, np.int32)     # edges of the stretches whose windows go
    whole = own.alike[own.of] & (later[own.of] | (own.ids[own.doc] > own.least[own.of]))
    np.add.at(gone, own.first[whole], 1)
    np.add.at(gone, (own.first + own.count)[whole], -1)
    gone = np.cumsum(gone)
    found, begin, at = [np.zeros(0, bool)], {}, 0                 # where each item's windows are among all found
    for bucket, part in _by_bucket(items):
        sizes = [len(x[3]) - own.min_len + 1 for x in part]
        found.append(np.unpackbits(np.frombuffer(earlier[bucket][0], np.uint8), count=sum(sizes)).astype(bool))
        for x, n in zip(part, sizes):
            begin[x[2]] = at
            at += n
    found = np.concatenate(found)
    first, count, docs = own.first[own.runs], own.count[own.runs], own.ids[own.doc[own.runs]]
    if len(docs):
        gone[_ranges(first, count)] = np.repeat(docs > own.ids[own.entry_doc[own.entry]], count)
        by_window = np.isin(own.entry, list(own.windows_of))
        rows = np.flatnonzero(~by_window)
        of = np.array([begin.get(e, 0) for e in range(len(own.entry_doc))], np.int64)[own.entry[rows]]
        gone[_ranges(first[rows], count[rows])] |= found[_ranges(of, count[rows])]
        for i in np.flatnonzero(by_window):                       # the window may be in an earlier document of this chunk
            windows = own.windows_of[own.entry[i]]
            gone[first[i]: first[i] + count[i]] |= found[[begin[~w] for w in windows]] | (own.window_ids[windows] < docs[i])
    edge = np.diff((gone > 0).astype(np.int8), prepend=0)
    cover = np.zeros(len(gone) + own.min_len, np.int32)
    np.add.at(cover, np.flatnonzero(edge == 1), 1)
    np.add.at(cover, np.flatnonzero(edge == -1) + own.min_len - 1, -1)
    return (np.cumsum(cover) > 0)[: len(own.buf)]


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
