"""Token-id binary output (operator 5): one zstandard dictionary, a frame per document.

File format, a folder of three Parquet tables (Spark's committer makes each
write atomic, so lost executors and repeated tasks leave no part files):

* ``dictionary``: one row with the shared zstandard dictionary, its SHA-256,
  the width of an id in bytes and the end id;
* ``blocks``: documents in ascending doc_id order. A block holds about
  ``BLOCK_BYTES`` of frames laid end to end (each document's little-endian
  ids, compressed alone with the dictionary) and its offset index: doc ids,
  end offset and id count per document, ids before the block in its shard,
  least and greatest doc id, and the dictionary's hash;
* ``shards``: per shard (a range of doc ids) the number of ids before it.

One document is read by pruning blocks on their doc id range and
decompressing its frame alone.

Each text is tokenized once, where its row is read; only compressed frames
are shuffled, straight to the shard of their doc id range. The dictionary is
trained on at most ``SAMPLE_DOCS`` documents (those of the least hashes) and
``SAMPLE_BYTES`` of their ids; tables too small to train on use the sample
itself as raw dictionary.

Defined cases: NULL text is read as empty and yields the end id alone; NULL
ids come first; rows that share an id are kept and ordered by a hash of their
text; an empty table writes no block; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickroll.llm.chunks import ChunkCache
from tickroll.llm.common import large_batches, small_batches, whole_text
from tickroll.session import shared_dir

SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 1 << 20
LEVEL = 3
SPACE = "\u0120"    # how byte-level vocabularies write a space

BLOCKS = ("shard int, block int, before long, first_doc long, last_doc long, doc_ids array<long>, ends array<long>, "
          "n_tokens array<long>, payload binary, dictionary_sha256 string")


class CachedTokenizer:
    """A ``tokenizers`` tokenizer that encodes each distinct chunk of the texts once."""

    def __init__(self, definition: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._type = np.dtype(f"<u{width}")
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self._begins[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self._cache = ChunkCache(self._chunks, self._type)

    def _chunks(self, parts: list[str], spaced: bool) -> list[bytes]:
        """Ids of chunks. Those after a space are encoded as one text, and told apart by their spaces."""
        if not spaced:
            return [np.array(e.ids, self._type).tobytes() for e in self._tokenizer.encode_batch(parts, add_special_tokens=False)]
        out: list[bytes] = []
        for first in range(0, len(parts), 2000):
            text = " " + " ".join(parts[first:first + 2000])
            ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            # a chunk holds one space, its first character: the tokens that begin with one begin the chunks
            cuts = (np.flatnonzero(self._begins[ids]) * self._type.itemsize).tolist()
            data = ids.astype(self._type).tobytes()
            out += [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialized ids of each text."""
        return self._cache.encoded(texts)


_WORKER: dict[tuple, CachedTokenizer] = {}


def _task_tokenizer(definition: str, width: int) -> CachedTokenizer:
    """The worker's tokenizer; a worker process keeps it, and its cache, from task to task."""
    key = (hash(definition), width)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = CachedTokenizer(definition, width)
    return _WORKER[key]


def _train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """The shared dictionary; None without any sample."""
    kept, size = [], 0
    for sample in samples:
        if size >= SAMPLE_BYTES:
            break
        kept.append(sample)
        size += len(sample)
    if not size:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, kept)
    except zstandard.ZstdError:   # too few samples
        return zstandard.ZstdCompressionDict(b"".join(kept)[-DICTIONARY_BYTES:],
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, width: int = 2, doc_id: str = "doc_id",
                 text: str = "text", path: str | None = None) -> str:
    """Encode every text and write the files; returns their folder.

    ``width`` is the bytes of an id (2 holds vocabularies up to 65,536).
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or shared_dir(spark, "token-files")
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())   # a vocabulary: its size is fixed
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), whole_text(text).alias("t"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _task_tokenizer(definition.value, width)
        for batch in large_batches(batches, "t"):
            yield pa.RecordBatch.from_arrays([pa.array(tokenizer.encode(batch.column("t")), pa.binary())], names=["ids"])

    chosen = [r[0] for r in rows.select("d").distinct().orderBy(F.xxhash64("d"), "d").limit(SAMPLE_DOCS).collect()]
    sampled = rows.filter(F.col("d").isin([c for c in chosen if c is not None])) if any(
        c is not None for c in chosen) else rows.limit(0)
    taken, size = [], 0
    for row in sampled.mapInArrow(sample, "ids binary").toLocalIterator():
        taken.append(bytes(row[0]))
        size += len(row[0])
        if size >= SAMPLE_BYTES:
            break
    trained = _train(taken)
    raw = trained.as_bytes() if trained else b""
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw), width, end_id)],
                          "sha256 string, bytes binary, width int, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")

    # shards: ranges of doc ids of about equal size, from the id column alone
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.select(F.percentile_approx("d", [(i + 1) / shards for i in range(shards - 1)] or [1.0], 20 * shards)).first()[0]
    bounds = np.array(cuts or [], np.int64)[:shards - 1]

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = _task_tokenizer(definition.value, width), np.array([end_id], f"<u{width}").tobytes()
        shared = {"dict_data": zstandard.ZstdCompressionDict(raw, dict_type=kind)} if raw else {}
        packer = zstandard.ZstdCompressor(level=LEVEL, **shared)
        for batch in large_batches(batches, "t"):
            ids = [x + end for x in tokenizer.encode(batch.column("t"))]
            keys = batch.column("d").fill_null(-2**63).to_numpy()
            ties = batch.column("k").to_numpy()
            # an id that fills several ranges is spread over them by its rows' text hashes
            low, high = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
            span = (high - low).astype(np.float64) + 1
            share = (ties.astype(np.float64) / 2**64 + 0.5).clip(0, 1 - 1e-9)
            shard = np.where(high > low, low + np.floor(share * span), low).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), batch.column("d"), batch.column("k"),
                 pa.array([len(x) // width for x in ids], pa.int64()),
                 pa.array([packer.compress(x) for x in ids], pa.binary())], names=["shard", "d", "k", "n", "frame"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        block = before = size = 0
        shard = None

        def close() -> pa.RecordBatch:
            ids = [h[0] for h in held if h[0] is not None]
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "before": before, "first_doc": min(ids, default=None),
                "last_doc": max(ids, default=None), "doc_ids": [h[0] for h in held],
                "ends": np.cumsum([len(h[2]) for h in held]).tolist(), "n_tokens": [h[1] for h in held],
                "payload": b"".join(h[2] for h in held), "dictionary_sha256": digest}], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("first_doc", pa.int64()),
                            ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                            ("n_tokens", pa.list_(pa.int64())), ("payload", pa.binary()), ("dictionary_sha256", pa.string())])
        for batch in batches:
            for number, doc, n, frame in zip(*(batch.column(c).to_pylist() for c in ("shard", "d", "n", "frame"))):
                if held and (size >= BLOCK_BYTES or number != shard):
                    yield close()
                    block, before = block + 1, before + sum(h[1] for h in held)
                    held, size = [], 0
                if number != shard:
                    shard, block, before = number, 0, 0
                held.append((doc, n, frame))
                size += len(frame)
        if held:
            yield close()

    (rows.withColumn("k", F.xxhash64("t")).mapInArrow(compress, "shard int, d long, k long, n long, frame binary")
     .repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "d", "k")
     .mapInArrow(pack, BLOCKS).write.parquet(f"{path}/blocks"))

    # ids before each shard: one row per shard
    totals = (spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
              .select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
              .groupBy("shard").agg(F.sum("n").alias("n")))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("shard", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start")).coalesce(1).write.parquet(f"{path}/shards")
    return path


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(row["bytes"])
    if hashlib.sha256(raw).hexdigest() != row["sha256"]:
        raise ValueError(f"{path}: the dictionary does not match its hash")
    return row["sha256"], raw, row["width"]


def read_tokens(spark: SparkSession, path: str, doc_id: int | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ids are little-endian unsigned 32-bit integers.

    With ``doc_id``, only that document: its block is found by the doc id
    ranges and its frame alone is decompressed.
    """
    digest, raw, width = _dictionary(spark, path)
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    if doc_id is not None:
        blocks = blocks.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    shards = spark.read.schema("shard int, start long").parquet(f"{path}/shards")   # a row per shuffle partition

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = {"dict_data": zstandard.ZstdCompressionDict(raw, dict_type=kind)} if raw else {}
        reader = zstandard.ZstdDecompressor(**shared)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                docs, starts, counts, ids, at, first = [], [], [], [], row["start"] + row["before"], 0
                for doc, end, n in zip(row["doc_ids"], row["ends"], row["n_tokens"]):
                    if doc_id is None or doc == doc_id:
                        docs.append(doc)
                        starts.append(at)
                        counts.append(n)
                        ids.append(np.frombuffer(reader.decompress(row["payload"][first:end]), f"<u{width}").astype("<u4").tobytes())
                    at, first = at + n, end
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()),
                                                  pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                                                 names=["doc_id", "start", "n_tokens", "ids"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")   # blocks of about 1 MB
    return (blocks.join(F.broadcast(shards), "shard")
            .select("start", "before", "doc_ids", "ends", "n_tokens", "payload", "dictionary_sha256")
            .mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary"))
