"""Token ids in training order (operator 4).

Texts become token ids plus an end id, cut into sequences of ``seq_len``.  The sequences are stored
once; each has an ordinal (rows before its file, plus its row in the file), so ordinals are dense
without a sort.  A keyed Feistel network over the smallest even number of bits that holds them, walked
until the value is below their number, maps ordinals one to one to global slots: no slot is drawn
twice, none is left out, and no table of the permutation exists.

Sequences are partitioned by ranges of slots, a shard each, and sorted by slot.  A shard is ``shard_rows`` neighbouring slots of
``stride`` bytes each, so a slot's shard and offset are arithmetic, and a reader resumes anywhere.

``materialise`` gives the rows in training order, payload included; ``write_shards`` writes them as
binary files (temporary name, then rename: a task that runs again replaces its own file), and
``read_slots`` reads any range of slots.  ``training_order`` does the whole: the partitions write their
shards, and the rows it gives take their payload from the files again, held against its checksum.

Defined cases: a null or empty text is its end id alone; repeated rows are sequences of their own; a
null ``doc_id`` stays null; an empty table gives no rows and no files; a vocabulary with ids of ``pad_id``
or more is refused when one turns up (ids are stored in 16 bits).
"""

from __future__ import annotations

import uuid
import zlib
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import map_texts, mix
from rillet.llm.packing import WordTokenizer
from rillet.session import materialize, scratch_path


@dataclass(frozen=True)
class OrderOptions:
    tokenizer: str                    # path of a tokenizers JSON file, readable on every executor
    seq_len: int = 512
    end_id: int = 0
    pad_id: int = 65535               # fills a last sequence; ids are stored in 16 bits
    key: int = 20240229
    rounds: int = 6
    shard_rows: int = 16_384
    cached_words: int = 350_000       # per Python worker
    passes: int = 2                   # parts of the shuffle of the sequences

    @property
    def stride(self) -> int:
        return 2 * self.seq_len


_U = np.uint64


def feistel(x: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """A keyed permutation of 0..n-1, applied to each of ``x``."""
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    mask = _U((1 << half) - 1)
    keys = mix((np.arange(1, rounds + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) ^ _U(key & ((1 << 64) - 1)))

    def once(v):
        left, right = v >> _U(half), v & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << _U(half)) | right

    out = once(np.asarray(x).astype(np.uint64))
    far = np.flatnonzero(out >= n)
    while len(far):                                  # cycle-walking: at most 4 values per slot
        out[far] = once(out[far])
        far = far[out[far] >= n]
    return out.astype(np.int64)


@lru_cache(maxsize=1)
def _tokenizer(path: str, cached_words: int) -> WordTokenizer:
    """The tokenizer of a Python worker: its tasks share the words it has met."""
    return WordTokenizer(path, cached_words)


def _sequences(options: OrderOptions):
    end = np.array([options.end_id], "<u4").tobytes()

    def run(batches):
        tokenizer = _tokenizer(options.tokenizer, options.cached_words)
        for batch in batches:
            bodies = [tokenizer.encode(t) + end for t in batch.column("text").to_pylist()]
            ids = np.frombuffer(b"".join(bodies), "<u4")
            if len(ids) and ids.max() >= options.pad_id:
                raise ValueError(f"id {ids.max()} does not fit below the padding {options.pad_id}: ids are stored in 16 bits")
            narrow = ids.astype("<u2").tobytes()
            out, first = [], 0
            for doc, body in zip(batch.column("doc_id").to_pylist(), bodies):
                last = first + len(body) // 2
                out += [(doc, k, narrow[at:min(at + options.stride, last)])
                        for k, at in enumerate(range(first, last, options.stride))]
                first = last
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
                names=["doc_id", "piece", "ids"])
    return run


_PLACE = "slot long, shard long, byte_offset long, doc_id long, piece int, n_tokens int, ids_crc32 long"
_PLACED = f"{_PLACE}, ids binary"


def _stored(docs: DataFrame, options: OrderOptions):
    """The sequences, stored, and ``placed(first, last)``: those of some shards, with their slots, a shard a partition.

    Also the number of shards (1 at least).
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "ordering")
    map_texts(docs.select("doc_id", "text"), _sequences(options), "doc_id long, piece int, ids binary") \
        .write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"),
                                             F.col("_metadata.row_index").alias("row"))
    files = stored.groupBy("file").count().orderBy("file").collect()      # one row per file of the store
    before, total = {}, 0
    for r in files:
        before[r["file"]] = total
        total += r["count"]

    def placed(first_shard: int, last_shard: int) -> DataFrame:
        def place(batches):
            for batch in batches:
                file = batch.column("file").dictionary_encode()
                first = np.array([before[f] for f in file.dictionary.to_pylist()], np.int64)[file.indices.to_numpy()]
                slot = feistel(first + batch.column("row").to_numpy(), total, options.key, options.rounds)
                shard = slot // options.shard_rows
                batch = pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(shard), *map(batch.column, ("doc_id", "piece", "ids"))],
                    names=["slot", "shard", "doc_id", "piece", "ids"])
                yield batch.filter(pa.array((shard >= first_shard) & (shard < last_shard)))

        rows = stored.mapInArrow(place, "slot long, shard long, doc_id long, piece int, ids binary")
        return rows.repartitionById(last_shard - first_shard, (F.col("shard") - first_shard).cast("int")) \
            .sortWithinPartitions("slot")

    return placed, max(1, -(-total // options.shard_rows))


def _described(batch, options: OrderOptions):
    """The columns of ``_PLACED`` for sequences with their slots."""
    slot, ids = batch.column("slot").to_numpy(), batch.column("ids")
    body = ids.to_pylist()
    return pa.RecordBatch.from_arrays(
        [batch.column("slot"), batch.column("shard"), pa.array(slot % options.shard_rows * options.stride),
         batch.column("doc_id"), batch.column("piece"), pa.array([len(x) // 2 for x in body], pa.int32()),
         pa.array([zlib.crc32(x) for x in body], pa.int64()), ids],
        names=["slot", "shard", "byte_offset", "doc_id", "piece", "n_tokens", "ids_crc32", "ids"])


def materialise(docs: DataFrame, options: OrderOptions) -> DataFrame:
    """``slot, shard, byte_offset, doc_id, piece, n_tokens, ids_crc32, ids`` in training order.

    ``ids`` are little-endian unsigned 16-bit, unpadded.
    """
    placed, shards = _stored(docs, options)
    return placed(0, shards).mapInArrow(lambda batches: (_described(b, options) for b in batches), _PLACED)


def training_order(docs: DataFrame, options: OrderOptions, path: str | None = None) -> DataFrame:
    """The rows of ``materialise``, after their shards are written below ``path`` and with ``ids`` read from them.

    Without ``path`` the shards go to a fresh folder in the shared one.  The sequences are shuffled
    once, in ``passes`` parts, so that a part's shuffle files can go before the next is dealt; what is
    put in order after the writing are the rows without payload.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    placed, shards = _stored(docs, options)

    def write(batches):
        sink = _Shards(path, options)
        for batch in batches:
            sink.add(batch)
            yield _described(batch, options).drop_columns(["ids"])
        sink.close()

    def read(batches):
        for batch in batches:
            if batch.num_rows:
                slot = batch.column("slot").to_numpy()
                first = int(slot[0])
                held = read_slots(path, first, int(slot[-1]) - first + 1, options)
                ids = [held[s, :n].tobytes() for s, n in zip(slot - first, batch.column("n_tokens").to_pylist())]
                if [zlib.crc32(x) for x in ids] != batch.column("ids_crc32").to_pylist():
                    raise ValueError(f"shards below {path} don't hold slots {first} to {slot[-1]} as written")
                yield batch.append_column("ids", pa.array(ids, pa.binary()))

    cuts = [shards * k // options.passes for k in range(options.passes + 1)]
    with _clean_shuffles(spark):
        written = [materialize(placed(a, b).mapInArrow(write, _PLACE), "ordering") for a, b in zip(cuts, cuts[1:]) if a < b]
    return reduce(DataFrame.union, written).repartitionById(shards, F.col("shard").cast("int")) \
        .sortWithinPartitions("slot").mapInArrow(read, _PLACED)


@contextmanager
def _clean_shuffles(spark):
    """Shuffle files of the queries run within go when their query ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def _files(path: str):
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Shards:
    """Writes the shards whose rows come in order; ``out`` holds ``shard, rows, bytes, crc32`` of each closed one."""

    def __init__(self, path: str, options: OrderOptions):
        self._fs, self._root = _files(path)
        self._fs.create_dir(self._root, recursive=True)
        self._stride = options.stride
        self._pad = np.array([options.pad_id], "<u2").tobytes()
        self._sink = None
        self.out = []

    def add(self, batch) -> None:
        for s, body in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
            if self._sink is None or s != self._shard:
                self.close()
                self._shard, self._rows, self._crc = s, 0, 0
                self._temp = f"{self._root}/.{uuid.uuid4().hex}.tmp"
                self._sink = self._fs.open_output_stream(self._temp)
            body += self._pad * ((self._stride - len(body)) // 2)
            self._sink.write(body)
            self._rows, self._crc = self._rows + 1, zlib.crc32(body, self._crc)

    def close(self) -> None:
        if self._sink is not None:
            self._sink.close()
            target = f"{self._root}/shard-{self._shard:06d}.bin"
            if self._fs.get_file_info(target).is_file:         # of an attempt before; not all file systems rename over it
                self._fs.delete_file(target)
            self._fs.move(self._temp, target)
            self.out.append((self._shard, self._rows, self._rows * self._stride, self._crc))
            self._sink = None


def write_shards(ordered: DataFrame, path: str, options: OrderOptions) -> DataFrame:
    """Write ``shard-NNNNNN.bin`` files below the shared folder ``path``; ``shard, rows, bytes, crc32`` of each.

    A shard's rows meet in one partition (``shard_rows`` of them at most) and stream to its file.
    """
    whole = ordered.select("slot", "shard", "ids").repartitionByRange("shard").sortWithinPartitions("slot")

    def run(batches):
        sink = _Shards(path, options)
        for batch in batches:
            sink.add(batch)
        sink.close()
        cols = list(zip(*sink.out)) if sink.out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                         names=["shard", "rows", "bytes", "crc32"])
    return whole.mapInArrow(run, "shard long, rows long, bytes long, crc32 long")


def read_slots(path: str, first: int, count: int, options: OrderOptions) -> np.ndarray:
    """The padded ids of ``count`` slots from ``first`` on, read in sequence from the shard files."""
    fs, root = _files(path)
    parts = []
    while count > 0:
        shard, row = divmod(first, options.shard_rows)
        take = min(count, options.shard_rows - row)
        with fs.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek(row * options.stride)
            parts.append(f.read(take * options.stride))
        first, count = first + take, count - take
    return np.frombuffer(b"".join(parts), "<u2").reshape(-1, options.seq_len)
