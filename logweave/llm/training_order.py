"""Training-order materialisation of token ids in fixed-stride shard files.

Texts are tokenised and packed into sequences of a fixed number of ids. A
sequence's number is made of its task and its place there; a keyed Feistel
network permutes the numbers, walking its cycle until it is back in their
range. The permuted numbers are cut into equal ranges, one exchange brings each
range to one task, which sorts it and writes it as one file of fixed-stride
records. Files follow each other in the order of the ranges, so a sequence's
rank in the permuted order is its global slot: training reads files from front
to back, and to resume at a slot is a seek.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import settle
from .textual import mix, small

#: Ids in a sequence, and bytes of text for which a shard file is planned.
SEQUENCE, SHARD_TEXT = 1024, 32 << 20
#: A task's share of the numbers: it can have so many sequences.
PLACES = 1 << 26
#: Rounds of the Feistel network.
ROUNDS = 6
#: The pattern that splits text before merges: a fixed value of the vocabulary.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
_U = np.uint64


def permuted(numbers: np.ndarray, domain: int, key: int) -> np.ndarray:
    """A permutation of ``0 .. domain - 1``, chosen by the key."""
    half = max(1, (max(domain - 1, 1).bit_length() + 1) // 2)
    mask, shift = _U((1 << half) - 1), _U(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(key))

    def network(x):
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return left << shift | right

    out = network(numbers.astype(_U))
    while (outside := out >= _U(domain)).any():
        out[outside] = network(out[outside])
    return out.astype(np.int64)


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary's byte strings and ids, read once on the driver."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if
                                                         line.strip())}


_HELD: list = []


def _encoding(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """The vocabulary's encoder. It is kept with the very ranks it was made from: as
    long as they are held, no other vocabulary can be taken for them."""
    if not _HELD or _HELD[0] is not ranks:
        _HELD[:] = [ranks, tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})]
    return _HELD[1]


def _packed(shared, length: int, domain: int, shards: int, key: int):
    """Tokenise and pack a task's texts; each ends with the id after the last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value)
        end = np.array([len(shared.value)], np.uint16)
        part, nth = TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=1).compress
        held: list[np.ndarray] = []
        count = 0

        def records(stream: np.ndarray, filled: int) -> pa.RecordBatch:
            nonlocal nth
            rows = stream.reshape(-1, length)
            numbers = np.arange(nth, nth + len(rows), dtype=np.int64) * parts + part
            nth += len(rows)
            if nth > PLACES:
                raise ValueError("a task has more sequences than it has numbers")
            order = permuted(numbers, domain, key)
            # floor(order * shards / domain), in whole numbers.
            shard = np.array([o * shards // domain for o in order.tolist()], np.int32)
            used = np.full(len(rows), length, np.int32)
            used[-1] = filled
            return pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(order), pa.array([part] * len(rows), pa.int32()),
                 pa.array(np.arange(nth - len(rows), nth)), pa.array(used),
                 pa.array([press(r.tobytes()) for r in rows], pa.binary())],
                ["shard", "order", "part", "nth", "n_tokens", "record"])

        parts = domain // PLACES
        if part >= parts:
            raise ValueError("more tasks than the plan announced")
        for batch in small(batches):
            for text in batch.column("text").to_pylist():
                if text is not None:
                    held += [np.array(encoding.encode_ordinary(text), np.uint16), end]
                    count += len(held[-2]) + 1
                if count >= 256 * length:
                    stream = np.concatenate(held)
                    whole = count // length * length
                    yield records(stream[:whole], length)
                    held, count = [stream[whole:]], count - whole
        if count:
            stream = np.concatenate(held)
            padded = np.full(-(-count // length) * length, end[0], np.uint16)
            padded[:count] = stream
            yield records(padded, count - (len(padded) - length))
    return run


def _file(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}.bin"


def _written(folder: str):
    """Write each shard of a task's sorted rows under a new name, then rename:
    a task that runs again replaces whole files by equal ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        unpress = zstandard.ZstdDecompressor().decompress
        shard, rank, stream, name = None, 0, None, ""

        def close():
            if stream is not None:
                stream.close()
                store.move(name, _file(root, shard))

        for batch in small(batches):
            ranks, sums = [], []
            for row_shard, record in zip(batch.column("shard").to_pylist(),
                                         batch.column("record").to_pylist(), strict=True):
                if row_shard != shard:
                    close()
                    shard, rank = row_shard, 0
                    name = f"{_file(root, shard)}.{uuid.uuid4().hex}"
                    stream = store.open_output_stream(name)
                raw = unpress(record)
                stream.write(raw)
                ranks.append(rank)
                sums.append(zlib.crc32(raw))
                rank += 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("shard", "part", "nth", "n_tokens")),
                 pa.array(ranks, pa.int64()), pa.array(sums, pa.int64())],
                ["shard", "part", "nth", "n_tokens", "rank", "crc32"])
        close()
    return run


def write_training_order(docs: DataFrame, folder: str, ranks_path: str,
                         text_col: str = "text", length: int = SEQUENCE, key: int = 17,
                         shards: int | None = None) -> DataFrame:
    """Write shard files into ``folder`` (a URI all executors reach) and return
    the manifest: a row ``slot, shard, byte_offset, n_tokens, crc32, part, nth``
    for each sequence.

    ``slot`` counts from 0 without gaps; ``byte_offset`` is the record's place in
    its file, a multiple of the stride of ``2 * length`` bytes. Sequences in the
    order (part, nth) are the input's texts in turn, each closed by the id
    behind the vocabulary's last, which also fills a part's last record behind
    ``n_tokens``. A null text is left out, an empty one is its end mark alone.
    Repeated texts are repeated; other columns are ignored; an empty table
    writes no file. The job runs at once. ``docs`` must give a repeated task the
    same rows in the same order, as scans of files do.
    """
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    if len(ranks) >= 1 << 16:
        raise ValueError("ids of more than two bytes")
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    if shards is None:
        size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
        shards = max(1, -(-size // SHARD_TEXT))
    domain = max(1, texts.rdd.getNumPartitions()) * PLACES
    rows = texts.mapInArrow(
        _packed(spark.sparkContext.broadcast(ranks), length, domain, shards, key),
        "shard int, order bigint, part int, nth bigint, n_tokens int, record binary")
    written = settle(rows.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "order").mapInArrow(
            _written(folder), "shard int, part int, nth bigint, n_tokens int, "
                              "rank bigint, crc32 bigint"), "manifest")
    sizes = written.groupBy("shard").agg(F.count("*").alias("n"))
    # One row for each shard file.
    first = sizes.select("shard", (F.sum("n").over(Window.orderBy("shard"))
                                   - F.col("n")).alias("first"))
    return written.join(F.broadcast(first), "shard").select(
        (F.col("first") + F.col("rank")).alias("slot"), "shard",
        (F.col("rank") * 2 * length).alias("byte_offset"), "n_tokens", "crc32", "part", "nth")


def read_sequences(spark: SparkSession, folder: str, manifest: DataFrame, first: int,
                   count: int, length: int = SEQUENCE) -> DataFrame:
    """``slot, ids`` of ``count`` slots from ``first`` on: each file that holds
    some is opened once and read from the first of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        stream, opened, at = None, None, 0
        for batch in small(batches):
            out = []
            for shard, offset in zip(batch.column("shard").to_pylist(),
                                     batch.column("byte_offset").to_pylist(), strict=True):
                if shard != opened:
                    if stream is not None:
                        stream.close()
                    stream, opened, at = store.open_input_file(_file(root, shard)), shard, -1
                if offset != at:
                    stream.seek(offset)
                out.append(np.frombuffer(stream.read(2 * length), np.uint16).tolist())
                at = offset + 2 * length
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(out, pa.list_(pa.int32()))], ["slot", "ids"])

    wanted = manifest.where((F.col("slot") >= first) & (F.col("slot") < first + count))
    return wanted.select("slot", "shard", "byte_offset").repartition("shard").sortWithinPartitions(
        "shard", "byte_offset").mapInArrow(run, "slot bigint, ids array<int>")
