"""Token-ID output in training order.

Documents become one stream of ids per input partition (each document closed by the end id),
cut into sequences of ``LENGTH`` ids; only the last one of a partition is padded. Sequences
are numbered densely, and a keyed Feistel permutation gives each its global slot: the number
is split in two halves that are mixed in turn with a keyed hash, over the smallest even number
of bits that holds the count; a result beyond the count is permuted again until it falls
inside (cycle-walking). No shuffle table, no sort by random keys, and the order of any run can
be told from ``(key, count)`` alone.

Range partitions of the slots are written as shards of ``SHARD`` records of a fixed stride, so
that slot ``s`` starts at byte ``s % SHARD * stride`` of shard ``s // SHARD``: a reader goes on
at any slot by one seek, and reads on sequentially.

:func:`written_order` does all of it: it writes the shards and reads its rows back from them.

Ids are computed once and kept in the shared folder (16 bits an id for vocabularies below
65,536, else 32; zstd). The shards are written in ``PASSES`` passes over the kept sequences, each
for its range of shards, and the shuffle files of a pass are released before the next one, so
that no more than that share of the sequences lies in shuffle files beside the shards. Only one
number per partition comes to the driver.

Defined results: null and empty texts are an end id; a null ``doc_id`` stays null; repeated
rows are written as often as they occur; an empty table gives no sequences and no shards;
other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .bpe import byte_bpe
from .common import mix64, prepare, stored

LENGTH = 1024
END_ID = 50256
SHARD = 4096             # sequences
KEY = 20240229
ROUNDS = 6
PASSES = 2               # over the kept sequences, to write the shards
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def permute(index: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """The slot of each of ``count`` numbers: a bijection of 0 .. count - 1."""
    half = max(1, (max(1, count - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % 2**64))
    out = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= np.uint64(count)]                # walk on along the cycle
    return out.astype(np.int64)


def sequences(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, ranks_file: str | None = None) -> DataFrame:
    """``part, number`` (within the partition), ``doc_id`` (whose ids come first), ``n_ids``
    and ``record`` (``length`` packed ids, padded with the end id)."""
    kind = np.dtype("<u2" if end_id < 65536 else "<u4")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        bpe, part, number = byte_bpe(ranks_file), TaskContext.get().partitionId(), 0
        names = ["part", "number", "doc_id", "n_ids", "record"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        rest, owner = np.zeros(0, kind), None

        def cut(ids, first, last):
            nonlocal number
            out = []
            for a in range(0, len(ids), length):
                own = ids[a: a + length]
                if len(own) < length and not last:
                    break
                padded = own if len(own) == length else np.concatenate([own, np.full(length - len(own), end_id, kind)])
                out.append((part, number, first(a), len(own), padded.tobytes()))
                number += 1
            return out

        for batch in batches:
            ids = [rest] if len(rest) else []
            begin, owners = ([0], [owner]) if len(rest) else ([], [])
            total = len(rest)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                one = np.append(np.frombuffer(bpe.pack(text or ""), "<u4"), np.uint32(end_id)).astype(kind)
                begin.append(total)
                owners.append(doc_id)
                ids.append(one)
                total += len(one)
            if not ids:
                continue
            flat = np.concatenate(ids)
            at = np.array(begin)
            first = lambda a: owners[int(np.searchsorted(at, a, side="right")) - 1]
            rows = cut(flat, first, False)
            whole = len(flat) // length * length
            rest, owner = flat[whole:], first(whole) if whole < len(flat) else None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if len(rest):
            rows = cut(rest, lambda a: owner, True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, "part long, number long, doc_id long, n_ids int, record binary")


def training_order(docs: DataFrame, length: int = LENGTH, shard: int = SHARD, key: int = KEY, end_id: int = END_ID,
                   ranks_file: str | None = None) -> DataFrame:
    """All sequences in slot order, by range partitions: ``slot, shard, byte_offset, doc_id,
    n_ids, ids_crc32, record``."""
    return _ordered_passes(docs, 1, length, shard, key, end_id, ranks_file)[0]


def _ordered_passes(docs: DataFrame, passes: int, length: int, shard: int, key: int, end_id: int, ranks_file: str | None) -> list[DataFrame]:
    """:func:`training_order` in ``passes`` frames (fewer, if there are fewer shards), each with
    the next shards; all read the sequences kept once."""
    spark = prepare(docs.sparkSession)
    rows = stored(sequences(docs, length, end_id, ranks_file), "token-sequences", "zstd")
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    count, offset = 0, {}
    for part in sorted(counts):
        offset[part], count = count, count + counts[part]
    offsets = spark.sparkContext.broadcast(offset)
    stride = length * (2 if end_id < 65536 else 4)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-count // shard))

    def ordered(lo: int, hi: int) -> DataFrame:
        def place(batches):
            import pyarrow as pa

            for batch in batches:
                index = [offsets.value[p] + n for p, n in zip(batch.column("part").to_pylist(), batch.column("number").to_pylist())]
                slot = permute(np.array(index, np.int64), count, key)
                if (lo, hi) != (0, shards):
                    mine = (slot >= lo * shard) & (slot < hi * shard)
                    slot, batch = slot[mine], batch.filter(pa.array(mine))
                size = stride // length
                crc = [zlib.crc32(r[: n * size]) for r, n in zip(batch.column("record").to_pylist(), batch.column("n_ids").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(slot // shard), pa.array(slot % shard * stride), batch.column("doc_id"), batch.column("n_ids"),
                     pa.array(crc, pa.int64()), batch.column("record")],
                    names=["slot", "shard", "byte_offset", "doc_id", "n_ids", "ids_crc32", "record"])

        kind = "slot long, shard long, byte_offset long, doc_id long, n_ids int, ids_crc32 long, record binary"
        # slots are dense: equal ranges of shards need no sampling pass
        ranges = min(parts, hi - lo)
        return rows.mapInArrow(place, kind).withColumn("_range", F.floor((F.col("shard") - lo) * ranges / (hi - lo)).cast("int")) \
            .repartition(ranges, "_range").sortWithinPartitions("slot").drop("_range")

    passes = min(passes, shards)
    cuts = [shards * i // passes for i in range(passes + 1)]
    return [ordered(lo, hi) for lo, hi in zip(cuts, cuts[1:])]


def _place(folder: str):
    """The file system of a URI or path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def write_shards(ordered: DataFrame, folder: str, shard: int = SHARD, length: int = LENGTH) -> DataFrame:
    """Write the records of :func:`training_order`, each range partition its own shards, as
    ``shard-<number>.bin`` below ``folder`` (a URI or path that all executors reach) and return
    ``shard, n_records, n_bytes, crc32`` and the ``doc_ids`` and ``n_ids`` of the records. A shard
    is written under another name and then renamed, so that a repeated task is harmless."""

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        store, path = _place(folder)
        store.create_dir(path, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        number, file, crc, size, doc_ids, n_ids = -1, None, 0, 0, [], []

        def done():
            file.close()
            name = f"{path}/shard-{number:08d}.bin"
            store.move(f"{name}.{attempt}", name)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((number, len(n_ids), size, crc, doc_ids, n_ids), kinds)],
                                              names=["shard", "n_records", "n_bytes", "crc32", "doc_ids", "n_ids"])

        for batch in batches:
            slots, of = batch.column("slot").to_numpy(), batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if of[a] != number:
                    if file is not None:
                        yield done()
                    number, crc, size, doc_ids, n_ids = int(of[a]), 0, 0, [], []
                    file = store.open_output_stream(f"{path}/shard-{number:08d}.bin.{attempt}")
                if not np.array_equal(slots[a:b], number * shard + len(n_ids) + np.arange(b - a)):
                    raise ValueError(f"shard {number} is not whole or not in slot order")
                data = b"".join(batch.column("record").slice(a, b - a).to_pylist())
                file.write(data)
                crc, size = zlib.crc32(data, crc), size + len(data)
                doc_ids += batch.column("doc_id").slice(a, b - a).to_pylist()
                n_ids += batch.column("n_ids").slice(a, b - a).to_pylist()
        if file is not None:
            yield done()

    return ordered.select("slot", "shard", "doc_id", "n_ids", "record") \
        .mapInArrow(write, "shard long, n_records long, n_bytes long, crc32 long, doc_ids array<long>, n_ids array<int>")


def written_order(docs: DataFrame, folder: str | None = None, length: int = LENGTH, shard: int = SHARD, key: int = KEY, end_id: int = END_ID,
                  ranks_file: str | None = None) -> DataFrame:
    """Write all shards below ``folder`` (by default a new one below ``spark.checkpoint.dir``) and
    return the rows of :func:`training_order` as the files hold them."""
    spark = prepare(docs.sparkSession)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-shards-{uuid.uuid4().hex}"
    ordered = _ordered_passes(docs, PASSES, length, shard, key, end_id, ranks_file)
    was = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")          # a pass is written when its shuffle files go
    try:
        each = [stored(write_shards(x, folder, shard, length), "token-shards-told") for x in ordered]
    finally:
        spark.conf.set(RELEASE, was)
    told = reduce(DataFrame.unionByName, each)
    size = 2 if end_id < 65536 else 4
    stride = length * size

    def read(batches):
        import pyarrow as pa

        store, path = _place(folder)
        for batch in batches:
            for number, n, crc, doc_ids, n_ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "n_records", "crc32", "doc_ids", "n_ids"))):
                found = 0
                with store.open_input_stream(f"{path}/shard-{number:08d}.bin") as f:
                    for a in range(0, n, 512):
                        b = min(n, a + 512)
                        data = f.read((b - a) * stride)
                        if len(data) != (b - a) * stride:
                            raise ValueError(f"shard {number} is cut off")
                        found = zlib.crc32(data, found)
                        records = [data[i * stride: (i + 1) * stride] for i in range(b - a)]
                        at = np.arange(a, b)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(number * shard + at), pa.array(np.full(b - a, number)), pa.array(at * stride), pa.array(doc_ids[a:b], pa.int64()),
                             pa.array(n_ids[a:b], pa.int32()), pa.array([zlib.crc32(r[: m * size]) for r, m in zip(records, n_ids[a:b])], pa.int64()),
                             pa.array(records, pa.binary())],
                            names=["slot", "shard", "byte_offset", "doc_id", "n_ids", "ids_crc32", "record"])
                    if f.read(1) or found != crc:
                        raise ValueError(f"shard {number} does not hold what was written")

    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), told.count()))
    return told.repartitionByRange(parts, "shard").sortWithinPartitions("shard") \
        .mapInArrow(read, "slot long, shard long, byte_offset long, doc_id long, n_ids int, ids_crc32 long, record binary")


def read_records(folder: str, from_slot: int, count: int, shard: int = SHARD, length: int = LENGTH, dtype: str = "<u2"):
    """Sequences from a slot on, in order: one seek, then sequential reads."""
    stride = length * np.dtype(dtype).itemsize
    slot = from_slot
    while slot < count:
        with open(f"{folder}/shard-{slot // shard:08d}.bin", "rb") as f:
            f.seek(slot % shard * stride)
            while data := f.read(stride):
                yield slot, np.frombuffer(data, dtype)
                slot += 1
