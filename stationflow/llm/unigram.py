"""SentencePiece encoding and decoding: the best segmentation of a text into pieces.

The pieces of a model file lie in a double-array trie over their bytes; a Viterbi pass takes
the segmentation with the largest sum of log scores. A character that no piece covers falls
back to one byte piece per byte. White space is written as a marker (U+2581), with one marker
before the text; decoding turns markers into spaces, drops the first and joins byte pieces
into characters.

Scores: a unigram model's own. A merge-ordered (BPE) model file holds ranks instead of log
scores; there a piece of rank ``r`` gets ``-ln(r + 1)`` (up to a constant, Zipf's law).

No piece has a marker after another character, so the best segmentation of a text is that of
its marker-led words in a row (this is checked; otherwise texts are taken whole). Words not
seen before by a worker are segmented together, one array step per position and trie depth;
very long ones one by one. The trie is built once and broadcast: its size is that of the
model file, whatever the corpus.

Defined results: null and empty texts have no ids; any text decodes to itself, but for
U+2581, which decodes to a space; repeated rows give repeated results; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

MARK = "▁"
CACHE_WORDS = 500_000
LONG_WORD = 40            # bytes; longer words are segmented one by one and not kept
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _fields(data: bytes):
    """Fields of a protobuf message: ``(number, value)``."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at: at + size]
            at += size


@dataclass
class Model:
    pieces: list            # bytes of each id (None: control or unknown)
    scores: np.ndarray
    kinds: np.ndarray
    dummy_prefix: bool = True

    @classmethod
    def load(cls, path: str) -> Model:
        with open(path, "rb") as f:
            data = f.read()
        rows, unigram, prefix = [], True, True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                rows.append((piece.get(1, b""), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, _NORMAL)))
            elif number == 2:
                unigram = dict(_fields(value)).get(3, 1) == 1
            elif number == 3:
                spec = dict(_fields(value))
                prefix = bool(spec.get(3, 1))
                if spec.get(2):
                    raise ValueError("models with a character map are not supported")
        kinds = np.array([k for _, _, k in rows])
        scores = np.array([s for _, s, _ in rows])
        if not unigram:
            normal = np.flatnonzero(kinds == _NORMAL)
            scores[normal[np.argsort(-scores[normal], kind="stable")]] = -np.log(np.arange(len(normal)) + 1.0)
        pieces = [bytes([int(p[3:5], 16)]) if k == _BYTE else p if k in (_NORMAL, _USER) else None for p, _, k in rows]
        return cls(pieces, scores, kinds, prefix)


class Trie:
    """A double array: from state ``s``, byte ``b`` leads to ``t = base[s] + b + 1`` if
    ``check[t] == s``; ``leaf[t]`` is the piece that ends there, or -1."""

    def __init__(self, words: list[tuple[bytes, int]]):
        tree: list[dict] = [{}]
        ends: dict[int, int] = {}
        for word, number in words:
            node = 0
            for b in word:
                if b not in tree[node]:
                    tree[node][b] = len(tree)
                    tree.append({})
                node = tree[node][b]
            ends.setdefault(node, number)
        base, check, leaf = {0: 0}, [-1] * (len(tree) * 2 + 1024), {}
        free, wide, todo = 300, 0, [(0, 0)]
        while todo:
            node, state = todo.pop()
            leaf[state] = ends.get(node, -1)
            children = sorted(tree[node])
            if not children:
                continue
            if len(children) == 1:                            # fills the gaps
                while check[free] >= 0:
                    free += 1
                start = free - children[0] - 1
            else:                                             # goes on from the last wide node
                start = wide
                while any(check[start + b + 1] >= 0 for b in children):
                    start += 1
                wide = start
            base[state] = start
            for b in children:
                check[start + b + 1] = state
                todo.append((tree[node][b], start + b + 1))
            if max(start, free) + 1024 > len(check):
                check += [-1] * len(check)
        self.check = np.array(check + [-1] * 300, np.int32)
        self.base, self.leaf = np.zeros(len(self.check), np.int32), np.full(len(self.check), -1, np.int32)
        for array, values in ((self.base, base), (self.leaf, leaf)):
            array[list(values)] = list(values.values())


def _char_bytes(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


class Codec:
    def __init__(self, model: Model):
        self.pieces, self.scores, self.prefix = model.pieces, model.scores, model.dummy_prefix
        normal = [(p, i) for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (_NORMAL, _USER) and p]
        self.trie = Trie(normal)
        self.byte_id = np.zeros(256, np.int64)
        for i in np.flatnonzero(model.kinds == _BYTE):
            self.byte_id[model.pieces[i][0]] = i
        if (model.kinds == _BYTE).sum() != 256:
            raise ValueError("the model has no byte pieces to fall back to")
        self.unknown = float(min(self.scores[i] for _, i in normal)) - 10.0
        self.deepest = max(len(p) for p, _ in normal)
        mark = MARK.encode()
        self.by_word = not any(mark in p.lstrip(mark) for p, _ in normal if p.decode("utf-8", "ignore").lstrip(MARK).find(MARK) >= 0)
        self.seen: dict[str, bytes] = {}
        self.text_of = [b"" if p is None else p if k == _BYTE else p.replace(mark, b" ") for p, k in zip(model.pieces, model.kinds)]

    # ------------------------------------------------------------ encoding

    def _step(self, best, back, length, m, data, size):
        """Extend the best segmentations that end at byte ``m`` of each row."""
        rows = np.flatnonzero((m < size) & np.isfinite(best[:, m]))
        rows = rows[(data[rows, m] & 0xC0) != 0x80]
        if not len(rows):
            return
        state, here = np.zeros(len(rows), np.int64), best[rows, m].copy()
        char = m + _char_bytes(data[rows, m])
        single = np.zeros(len(rows), bool)
        alive = np.arange(len(rows))
        t = self.trie
        for d in range(m, min(data.shape[1], m + self.deepest)):
            nxt = t.base[state[alive]] + data[rows[alive], d].astype(np.int64) + 1
            ok = (t.check[nxt] == state[alive]) & (d < size[rows[alive]])
            alive, nxt = alive[ok], nxt[ok]
            if not len(alive):
                break
            state[alive] = nxt
            piece = t.leaf[nxt]
            at, piece = alive[piece >= 0], piece[piece >= 0]
            single[at[char[at] == d + 1]] = True
            value = here[at] + self.scores[piece]
            better = value > best[rows[at], d + 1]
            at, piece = at[better], piece[better]
            best[rows[at], d + 1] = value[better]
            back[rows[at], d + 1], length[rows[at], d + 1] = piece, d + 1 - m
        at = np.flatnonzero(~single)
        end = np.minimum(char[at], size[rows[at]])
        better = here[at] + self.unknown > best[rows[at], end]
        at, end = at[better], end[better]
        best[rows[at], end], back[rows[at], end], length[rows[at], end] = here[at] + self.unknown, -1, end - m

    def segment(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of the best segmentation of each word."""
        size = np.array([len(w) for w in words])
        widest = int(size.max())
        data = np.frombuffer(b"".join(w.ljust(widest, b"\0") for w in words), np.uint8).reshape(len(words), widest)
        best = np.full((len(words), widest + 1), -np.inf)
        best[:, 0] = 0
        back, length = np.full(best.shape, -2, np.int32), np.zeros(best.shape, np.int32)
        for m in range(widest):
            self._step(best, back, length, m, data, size)
        out = []
        for w, row, b, n in zip(words, range(len(words)), back.tolist(), length.tolist()):
            ids, at = [], len(w)
            while at:
                if b[at] >= 0:
                    ids.append(b[at])
                else:
                    ids += [int(self.byte_id[x]) for x in reversed(w[at - n[at]: at])]
                at -= n[at]
            out.append(struct.pack(f"<{len(ids)}I", *reversed(ids)))
        return out

    def segment_long(self, word: bytes) -> bytes:
        """The same for one long word, position by position."""
        t, n = self.trie, len(word)
        base, check, leaf, scores = t.base, t.check, t.leaf, self.scores
        best, back = [-math.inf] * (n + 1), [(0, 0)] * (n + 1)
        best[0] = 0.0
        for m in range(n):
            if word[m] & 0xC0 == 0x80 or best[m] == -math.inf:
                continue
            char = min(n, m + int(_char_bytes(np.array([word[m]]))[0]) if word[m] >= 0xC0 else m + 1)
            state, single = 0, False
            for d in range(m, min(n, m + self.deepest)):
                nxt = int(base[state]) + word[d] + 1
                if check[nxt] != state:
                    break
                state = nxt
                piece = int(leaf[state])
                if piece >= 0:
                    single |= d + 1 == char
                    value = best[m] + scores[piece]
                    if value > best[d + 1]:
                        best[d + 1], back[d + 1] = value, (piece, m)
            if not single and best[m] + self.unknown > best[char]:
                best[char], back[char] = best[m] + self.unknown, (-1, m)
        ids, at = [], n
        while at:
            piece, m = back[at]
            ids += [piece] if piece >= 0 else [int(self.byte_id[x]) for x in reversed(word[m:at])]
            at = m
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return _WORD.findall(text) if self.by_word else [text]

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as unsigned little-endian 32-bit integers."""
        split = [self.words(t) for t in texts]
        new: dict = {}
        for words in split:
            for w in words:
                if w not in self.seen and w not in new:
                    new[w] = None
        if len(self.seen) + len(new) > CACHE_WORDS:
            self.seen = {w: self.seen[w] for words in split for w in words if w in self.seen}
        by_size: dict[int, list] = {}
        for w in new:
            b = w.encode("utf-8", "replace")
            if len(b) > LONG_WORD:
                new[w] = self.segment_long(b)
            else:
                by_size.setdefault(-(-len(b) // 8), []).append((w, b))
        for group in by_size.values():
            for a in range(0, len(group), 20000):
                part = group[a: a + 20000]
                for (w, _), ids in zip(part, self.segment([b for _, b in part])):
                    new[w] = ids
        look = {**self.seen, **new} if len(new) > len(self.seen) else None
        if look is None:
            self.seen.update(new)
            look = self.seen
        out = [b"".join([look[w] for w in words]) for words in split]
        self.seen = look if len(look) <= CACHE_WORDS else {}
        return out

    # ------------------------------------------------------------ decoding

    def decode(self, ids) -> str:
        text = b"".join(map(self.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else ids))
        text = text.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_CODECS: dict = {}


def codec(model_file: str | None = None) -> Codec:
    import public_tokenizers

    path = model_file or public_tokenizers.path("piece_bpe_32k.model")
    if path not in _CODECS:
        _CODECS[path] = Codec(Model.load(path))
    return _CODECS[path]


def encode_documents(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, ids`` (array), ``n_ids, n_byte_ids, ids_crc32`` and ``round_trip`` (the ids decode to the text)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(codec(model_file))       # bounded by the model file
    schema = "doc_id long, ids array<int>, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean"

    def run(batches):
        import pyarrow as pa

        c = shared.value
        is_byte = np.zeros(len(c.pieces), bool)
        is_byte[c.byte_id] = True
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            packed = c.encode(texts)
            ids = [np.frombuffer(p, "<u4") for p in packed]
            same = [c.decode(p) == t.replace(MARK, " ").encode("utf-8", "replace").decode() for p, t in zip(packed, texts)]
            ends = np.cumsum([0, *map(len, ids)])
            columns = {"doc_id": batch.column("doc_id"),
                       "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4"))),
                       "n_ids": pa.array(np.diff(ends)), "n_byte_ids": pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(p) for p in packed], pa.int64()), "round_trip": pa.array(same, pa.bool_())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
