"""Token ids in training order: a keyed Feistel permutation gives every sequence a slot of fixed-stride shards."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm.common import materialise, passing

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Id that ends every document and fills the last sequence; free in the vocabulary.
END = 50256
MANIFEST = "_MANIFEST.json"
FIELDS = "slot long, shard int, sequence long, file string, n_tokens int, sha256 string"


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding(f"own-{len(ranks)}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(vocabulary: bytes, text: str | None) -> bytes:
    """Little-endian 16-bit token ids of a whole text; none for null and empty."""
    return array("H", _encoding(vocabulary).encode_ordinary(text)).tobytes() if text else b""


class Feistel:
    """Keyed permutation of 0 to n - 1: a balanced Feistel network over the next even number of bits, walked until below n."""

    def __init__(self, n: int, key: int, rounds: int = 6):
        self.n = n
        self.half = max(1, (max(2, n - 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        seed = hashlib.blake2b(key.to_bytes(16, "little", signed=True), digest_size=8 * rounds).digest()
        self.keys = np.frombuffer(seed, np.uint64)

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self._mix(left, key), left
            else:
                left, right = right, left ^ self._mix(right, key)
        return (left << np.uint64(self.half)) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        x = np.atleast_1d(np.asarray(x)).astype(np.uint64)
        x = self._once(x, back)
        while (out := x >= self.n).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slot(self, sequence) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot) -> np.ndarray:
        return self._walk(slot, True)


def number_to_slot(number: np.ndarray, total: int, window: int | None, key: int) -> np.ndarray:
    """Global slots of sequence numbers below total: the keyed permutation of all, or of each window of so many numbers."""
    if window is None or window >= total:
        return Feistel(max(1, total), key).slot(number) if len(number) else number
    out = np.empty(len(number), np.int64)
    for w in np.unique(number // window):
        mine, start = number // window == w, int(w) * window
        out[mine] = start + Feistel(min(window, total - start), key + int(w)).slot(number[mine] - start)
    return out


def packing(texts: DataFrame, vocabulary: bytes, stride: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for compressing single sequences on their way, from the beginnings of at most 300 texts; None if they are too few."""
    some = texts.where("text IS NOT NULL").select(F.substring("text", 1, 20_000).alias("text")).limit(300).collect()
    ids = b"".join(encode(vocabulary, r.text) for r in some)
    parts = [ids[i : i + stride] for i in range(0, len(ids) - stride + 1, stride)]
    try:
        return zstandard.train_dictionary(1 << 16, parts) if len(parts) >= 20 else None
    except zstandard.ZstdError:
        return None


def write_shards(
    docs: DataFrame, path: str, seq_len: int = 2048, shard_sequences: int = 4096, key: int = 20_24, vocabulary: str = VOCABULARY, text_col: str = "text",
    stream_col: str | None = None, window: int | None = None,
) -> DataFrame:
    """Tokenise whole texts, cut the stream into sequences, and write them in permuted order as binary shards under path.

    Each document's ids are followed by END; a stream is cut every seq_len ids and its last sequence filled with END. An
    input partition is a stream, or with stream_col each run of rows with the same string in it, which must stand together
    in one partition. Sequences are numbered in the order of the streams' names and in each as they come. A keyed Feistel
    permutation gives number i its slot: of all numbers, or with ``window`` of each window of so many, so that an order of
    the input (a schedule of sources) holds from window to window. Shard j is the range of slots from j * shard_sequences:
    one file of as many records of 2 * seq_len bytes (the last of fewer), in slot order, so a reader can start or resume at
    any slot, and which sequence is at a slot follows from the key alone.

    Returns (slot, shard, offset, sequence, n_tokens, sha256), a row for each sequence; n_tokens leaves out the filling.
    Null and empty texts are END alone; an empty table writes no shard. Other columns are ignored.

    Texts are encoded once, into the shared folder, each sequence compressed; so the numbers are exact before the one
    shuffle, in which task j receives shard j. The driver holds a count for each stream and a name for each shard. Tasks
    name their files anew at each attempt and only those of finished tasks enter the manifest, so lost executors leave
    nothing behind.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        vocab = spark.sparkContext.broadcast(f.read())  # about 1 MB
    stride = 2 * seq_len
    stream = F.col(stream_col) if stream_col else F.lpad(F.spark_partition_id().cast("string"), 12, "0")
    texts = docs.select(stream.cast("string").alias("stream"), F.col(text_col).cast("string").alias("text"))

    made = packing(texts, vocab.value, stride)
    common = spark.sparkContext.broadcast(made.as_bytes() if made else None)  # 64 KB

    def dictionary() -> dict:
        return {"dict_data": zstandard.ZstdCompressionDict(common.value)} if common.value else {}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"stream": pa.string(), "place": pa.int64(), "ids": pa.binary()}
        pack, end = zstandard.ZstdCompressor(level=6, **dictionary()), np.uint16(END).tobytes()
        held, own, done = bytearray(), None, 0

        def ready(last: bool) -> pa.RecordBatch:
            nonlocal done
            n = -(-len(held) // stride) if last else len(held) // stride
            ids = [pack.compress(bytes(held[i * stride : (i + 1) * stride])) for i in range(n)]
            del held[: n * stride]
            columns = ([own] * n, range(done, done + n), ids)
            done += n
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if name != own:
                    if held:
                        yield ready(True)
                    own, done = name, 0
                held += encode(vocab.value, t.as_py()) + end
                if len(held) > 4 << 20:
                    yield ready(False)
        yield ready(True)

    with passing(spark):
        staged = materialise(texts.mapInArrow(cut, "stream string, place long, ids binary"), "sequences")
        sizes = {r.stream: r.n for r in staged.groupBy("stream").agg(F.count("*").alias("n")).collect()}  # a row for each stream
        first, total = {}, 0
        for name in sorted(sizes, key=lambda x: (x is not None, x)):
            first[name], total = total, total + sizes[name]
        n_shards = max(1, -(-total // shard_sequences))
        starts = spark.sparkContext.broadcast(first)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                number = np.array([starts.value[s] for s in b.column(0).to_pylist()], np.int64) + b.column(1).to_numpy()
                slot = number_to_slot(number, total, window, key)
                yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(number, pa.int64()), b.column(2)], names=["slot", "sequence", "ids"])

        def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = {"slot": pa.int64(), "shard": pa.int32(), "sequence": pa.int64(), "file": pa.string(), "n_tokens": pa.int32(), "sha256": pa.string()}
            target, root = fs.FileSystem.from_uri(path)
            unpack, filling = zstandard.ZstdDecompressor(**dictionary()), np.uint16(END).tobytes() * seq_len
            out, shard, name = None, None, None
            for b in batches:
                done = []
                for slot, own, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    if slot // shard_sequences != shard:
                        if out:
                            out.close()
                        shard = slot // shard_sequences
                        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bin"
                        target.create_dir(root, recursive=True)
                        out = target.open_output_stream(f"{root}/{name}", compression=None)
                    ids = unpack.decompress(ids.as_py())
                    record = ids + filling[len(ids) :]
                    out.write(record)
                    done.append((slot, shard, own, name, len(ids) // 2, hashlib.sha256(record).hexdigest()))
                columns = zip(*done, strict=True) if done else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))
            if out:
                out.close()

        placed = staged.mapInArrow(place, "slot long, sequence long, ids binary")
        dealt = placed.repartitionById(n_shards, F.floor(F.col("slot") / shard_sequences).cast("int")).sortWithinPartitions("slot")
        written = materialise(dealt.mapInArrow(store, FIELDS), "slots", keep=True)
    shards = [(r.shard, r.file, r.shard * shard_sequences, r.n) for r in written.groupBy("shard", "file").agg(F.count("*").alias("n")).orderBy("shard").collect()]  # a row for each shard
    target, root = fs.FileSystem.from_uri(path)
    target.create_dir(root, recursive=True)
    meta = {"seq_len": seq_len, "stride": stride, "n_sequences": total, "window": window, "key": key, "shards": shards}
    with target.open_output_stream(f"{root}/{MANIFEST}", compression=None) as f:
        f.write(json.dumps(meta).encode())
    return written.select("slot", "shard", (F.col("slot") % shard_sequences * stride).alias("offset"), "sequence", "n_tokens", "sha256")


def read_manifest(path: str) -> dict:
    target, root = fs.FileSystem.from_uri(path)
    with target.open_input_stream(f"{root}/{MANIFEST}", compression=None) as f:
        return json.loads(f.read())


def read_slots(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """(slot, ids array<int>) of the slots from start up to stop: each shard in a task of its own, read in sequence from the first slot wanted."""
    meta = read_manifest(path)
    stop = meta["n_sequences"] if stop is None else stop
    wanted = [(name, max(start, at) - at, min(stop, at + n) - at, at) for _, name, at, n in meta["shards"] if at < stop and at + n > start]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(path)
        for b in batches:
            for name, low, high, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with target.open_input_file(f"{root}/{name}") as f:
                    f.seek(low * meta["stride"])
                    for place in range(low, high):
                        ids = np.frombuffer(f.read(meta["stride"]), np.uint16)
                        yield pa.RecordBatch.from_arrays([pa.array([at + place], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], names=["slot", "ids"])

    shards = spark.createDataFrame(wanted, "name string, low long, high long, at long").repartition(max(1, len(wanted)))
    return shards.mapInArrow(read, "slot long, ids array<int>")
