"""Benchmark decontamination (operator 2): a distributed positional inverted index.

The training texts are cut into bounded *segments*. A segment is one row: the
documents it holds and, per term, the sorted token positions of that term in
the segment (a document's words are numbered on from the previous document's,
with one unused position between them, so no phrase can cross documents).
Segments are written once to the shared folder, so phrase look-ups read the
index and not the texts, and need no shuffle: a look-up touches one segment
at a time.

Test items are read in bounded blocks. Within a segment each window of an
item is looked up from its rarest term: that term's positions, shifted to the
window's start, are intersected with the shifted positions of the next rarest
term, and so on. ``slop`` 0 gives exact phrases; a larger one (proximity)
accepts terms of one document of which no two lie more than ``slop`` positions
nearer or farther than in the phrase, whichever of them is the rarest.

Only the terms that test items use are stored. They are recognised by a Bloom
filter of fixed size, so that what is sent to executors is bounded however
large the benchmark is; a falsely stored term costs space, never a result.

Defined cases: NULL text has no words; an item or a document without words
matches nothing; repeated rows and NULL ids are judged row by row; extra
columns are ignored; an empty table gives an empty (or unmatched) result; a
document longer than a segment makes a segment of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickroll.llm.common import small_batches, stage, text_batches

WINDOW = 13              # words of a window
SEGMENT_WORDS = 400_000  # words after which a segment is closed
ITEM_BLOCK = 2_000       # test items looked up per pass over the index
BLOOM_BITS = 1 << 23     # fixed size of the term filter: 1 MB
BLOOM_HASHES = 4
CACHE_TERMS = 300_000    # words whose numbers a task keeps from one segment to the next

# A-Z to lower case; every byte outside [0-9A-Za-z\x80-\xFF] to a space.
WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SEGMENT_SCHEMA = ("segment long, doc_ids array<long>, text_keys array<long>, starts array<long>, n_words array<long>, "
                  "terms array<binary>, counts array<int>, positions binary")
MATCH_SCHEMA = "segment long, doc int, item_id long, begin long, stop long"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


def _bits(term: bytes) -> list[int]:
    h = xxhash.xxh3_128_intdigest(term)
    a, b = h & (2**64 - 1), h >> 64
    return [(a + k * b) % BLOOM_BITS for k in range(BLOOM_HASHES)]


def term_filter(items: DataFrame, text: str = "text") -> bytes:
    """Bloom filter of the terms of all items: fixed size, merged by segment of bits.

    Every task marks its terms in a bitmap; the set bits are united by a
    distinct aggregate, and only the bitmap's 64-bit words come to the driver
    (at most ``BLOOM_BITS / 64`` rows).
    """
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(BLOOM_BITS, bool)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for term in set(words_of(value)):
                    bitmap[_bits(term)] = True
        packed = np.packbits(bitmap).view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "bits": pa.array(packed[at], pa.int64())})

    rows = (items.select(F.col(text).cast("string").alias("t")).mapInArrow(mark, "at long, bits long")
            .groupBy("at").agg(F.bit_or("bits").alias("bits")).collect())
    words = np.zeros(BLOOM_BITS // 64, np.int64)
    for row in rows:
        words[row["at"]] = row["bits"]
    return words.tobytes()


class _TermCodes(dict):
    """A number per term that is stored, 0 for any other; the filter is asked once per distinct word while the cache lasts."""

    def __init__(self, keep: np.ndarray | None):
        super().__init__()
        self._keep = keep
        self.terms: list[bytes] = [b""]

    def __missing__(self, term: bytes) -> int:
        code = 0
        if self._keep is None or all(self._keep[b] for b in _bits(term)):
            code = len(self.terms)
            self.terms.append(term)
        self[term] = code
        return code


def build_index(docs: DataFrame, terms: bytes | None = None, doc_id: str = "doc_id", text: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The positional inverted index of ``docs``, written to the shared folder.

    ``terms`` is a ``term_filter``; without one every term is stored.
    """
    small_batches(docs.sparkSession)
    keep = None if terms is None else np.unpackbits(np.frombuffer(terms, np.uint8)).view(bool)

    def close(number: int, ids: list, keys: list, starts: list, counts: list, codes: list, known: _TermCodes) -> pa.RecordBatch:
        code = np.concatenate(codes)
        place = np.flatnonzero(code).astype(np.uint32)
        used, which = np.unique(code[place], return_inverse=True)
        terms = [known.terms[c] for c in used.tolist()]
        by_term = sorted(range(len(terms)), key=terms.__getitem__)
        rank = np.empty(len(terms), np.int64)
        rank[by_term] = np.arange(len(terms))
        order = np.argsort(rank[which], kind="stable")
        lengths = np.bincount(rank[which], minlength=len(terms))
        # deltas within each list: small numbers, which Parquet packs well
        listed = place[order]
        deltas = np.diff(listed, prepend=np.uint32(0))
        first = (np.cumsum(lengths) - lengths).astype(np.int64)
        deltas[first] = listed[first]
        return pa.RecordBatch.from_pydict({
            "segment": pa.array([number], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "text_keys": pa.array([keys], pa.list_(pa.int64())),
            "starts": pa.array([starts], pa.list_(pa.int64())), "n_words": pa.array([counts], pa.list_(pa.int64())),
            "terms": pa.array([[terms[k] for k in by_term]], pa.list_(pa.binary())),
            "counts": pa.array([lengths], pa.list_(pa.int32())),
            "positions": pa.array([deltas.tobytes()], pa.binary())})

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known = _TermCodes(keep)
        gap = np.zeros(1, np.uint32)
        ids, keys, starts, counts, codes, at = [], [], [], [], [], 0
        for batch in text_batches(batches, "t"):
            for doc, value, key in zip(*(batch.column(c).to_pylist() for c in ("d", "t", "k"))):
                found = words_of(value)
                codes += [np.fromiter(map(known.__getitem__, found), np.uint32, len(found)), gap]
                ids.append(doc)
                keys.append(key)
                starts.append(at)
                counts.append(len(found))
                at += len(found) + 1
                if at >= segment_words:
                    yield close(number, ids, keys, starts, counts, codes, known)
                    ids, keys, starts, counts, codes, at = [], [], [], [], [], 0
                    number += 1
                    if len(known) > CACHE_TERMS:
                        known = _TermCodes(keep)
        if ids:
            yield close(number, ids, keys, starts, counts, codes, known)

    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return stage(rows.withColumn("k", F.xxhash64("t")).mapInArrow(index, SEGMENT_SCHEMA), "positional-index")


class SegmentReader:
    """Look-ups in one segment of the index."""

    def __init__(self, terms: list[bytes], counts: list[int], positions: bytes):
        ends = np.cumsum(counts, dtype=np.int64)
        self._places = {t: (int(e) - int(n), int(e)) for t, n, e in zip(terms, counts, ends)}
        self._data = np.frombuffer(positions, np.uint32)
        self._read: dict[bytes, np.ndarray] = {}

    def count(self, term: bytes) -> int:
        first, last = self._places.get(term, (0, 0))
        return last - first

    def postings(self, term: bytes) -> np.ndarray:
        if term not in self._read:
            first, last = self._places[term]
            self._read[term] = np.cumsum(self._data[first:last], dtype=np.int64)
        return self._read[term]

    def _rarest_first(self, phrase: list[bytes]) -> list[int]:
        order = sorted(range(len(phrase)), key=lambda k: (self.count(phrase[k]), k))
        return order if order and self.count(phrase[order[0]]) else []

    def starts(self, phrase: list[bytes]) -> np.ndarray:
        """Positions at which ``phrase`` begins.

        The rarest term fixes the alignment; the others are intersected in
        order of rising frequency.
        """
        order = self._rarest_first(phrase)
        if not order:
            return np.empty(0, np.int64)
        at = self.postings(phrase[order[0]]) - order[0]
        for k in order[1:]:
            listed = self.postings(phrase[k])
            near = np.searchsorted(listed, at + k)
            at = at[(near < len(listed)) & (listed[np.minimum(near, len(listed) - 1)] == at + k)]
            if not len(at):
                break
        return at

    def near(self, phrase: list[bytes], slop: int, starts: np.ndarray) -> np.ndarray:
        """Rows (document, begin, stop) of the places where the terms of ``phrase`` lie within ``slop`` of each other's places.

        ``starts`` are the documents' first positions. For a begin b, term k
        is looked for from b + k to b + k + slop; every b that the rarest
        term allows is tried, so which term that is makes no difference.
        """
        order = self._rarest_first(phrase)
        if not order:
            return np.empty((0, 3), np.int64)
        rarest = self.postings(phrase[order[0]])
        tried = np.arange(-slop, 1)
        doc = np.repeat(np.searchsorted(starts, rarest, "right") - 1, len(tried))
        at, doc = np.unique(np.stack([(rarest[:, None] - order[0] + tried).ravel(), doc]), axis=1)
        first, beyond = starts[doc], np.append(starts[1:], np.iinfo(np.int64).max)[doc]
        begin, stop = beyond, np.zeros(len(at), np.int64)
        for k in order:
            listed = self.postings(phrase[k])
            place = np.searchsorted(listed, np.maximum(at + k, first))
            found = listed[np.minimum(place, len(listed) - 1)]
            good = (place < len(listed)) & (found <= at + k + slop) & (found < beyond)
            begin, stop = np.minimum(begin, found)[good], np.maximum(stop, found + 1)[good]
            at, doc, first, beyond = at[good], doc[good], first[good], beyond[good]
        return np.stack([doc, begin, stop], axis=1)


def phrase_matches(index: DataFrame, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW,
                   slop: int = 0) -> DataFrame:
    """Matches of one block of items: the merged word ranges of each item in each document.

    Columns: segment, doc (its place in the segment), item_id, begin, stop
    (word numbers in the document, end exclusive).
    """
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = SegmentReader(row["terms"], row["counts"], row["positions"])
                starts = np.array(row["starts"], np.int64)
                known: dict[tuple, np.ndarray] = {}
                out: dict[str, list] = {"segment": [], "doc": [], "item_id": [], "begin": [], "stop": []}
                for item_id, words in items:
                    size = min(window, len(words))
                    hits = []
                    for k in range(len(words) - size + 1 if size else 0):
                        phrase = tuple(words[k:k + size])
                        if phrase not in known:
                            known[phrase] = reader.near(list(phrase), slop, starts) if slop else reader.starts(list(phrase))
                        if len(known[phrase]):
                            hits.append(known[phrase])
                    if not hits:
                        continue
                    if slop:
                        doc, begin, stop = np.unique(np.concatenate(hits), axis=0).T
                        reached = np.maximum.accumulate(stop)
                        # a document ends before the next begins, so ranges of two documents never touch
                        cut = np.flatnonzero(begin[1:] > reached[:-1]) + 1
                        for first, last in zip([0, *cut], [*cut, len(doc)]):
                            out["segment"].append(row["segment"])
                            out["doc"].append(int(doc[first]))
                            out["item_id"].append(item_id)
                            out["begin"].append(int(begin[first] - starts[doc[first]]))
                            out["stop"].append(int(reached[last - 1] - starts[doc[first]]))
                        continue
                    at = np.unique(np.concatenate(hits))
                    doc = np.searchsorted(starts, at, "right") - 1
                    # occurrences of the item that touch or overlap in one document are one range
                    cut = np.flatnonzero((np.diff(at) > size) | (np.diff(doc) > 0)) + 1
                    for run, docs_ in zip(np.split(at, cut), np.split(doc, cut)):
                        if len(run):
                            out["segment"].append(row["segment"])
                            out["doc"].append(int(docs_[0]))
                            out["item_id"].append(item_id)
                            out["begin"].append(int(run[0] - starts[docs_[0]]))
                            out["stop"].append(int(run[-1] - starts[docs_[0]]) + size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["segment"], pa.int64()), pa.array(out["doc"], pa.int32()),
                     pa.array(out["item_id"], pa.int64()), pa.array(out["begin"], pa.int64()),
                     pa.array(out["stop"], pa.int64())], names=list(out))

    # one segment per batch: a segment is bounded by its words
    index.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return index.select("segment", "starts", "terms", "counts", "positions").mapInArrow(match, MATCH_SCHEMA)


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
                size: int = ITEM_BLOCK) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The test items in bounded blocks, one block in the driver at a time."""
    block = []
    for row in items.select(F.col(item_id).cast("long"), F.col(text).cast("string")).toLocalIterator():
        words = words_of(row[1])
        if words:
            block.append((row[0], words))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def find_contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", slop: int = 0,
                       window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(documents, matches): every document row of the index, and the ranges that items cover in it.

    ``documents`` has segment, doc, doc_id, text_key (a 64-bit hash of the text), n_words; ``matches`` as from
    ``phrase_matches``. Both are keyed by (segment, doc), a document's row.
    """
    index = build_index(docs, term_filter(items, item_text), doc_id, text)
    parts = [stage(phrase_matches(index, block, window, slop), "index-matches")
             for block in item_blocks(items, item_id, item_text)]
    spark = docs.sparkSession
    matches = spark.createDataFrame([], MATCH_SCHEMA) if not parts else parts[0]
    for part in parts[1:]:
        matches = matches.unionByName(part)
    small_batches(spark)
    listed = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "n_words")).alias("doc", "_d"))
    return listed.select("segment", "doc", F.col("_d.doc_ids").alias("doc_id"), F.col("_d.text_keys").alias("text_key"),
                         F.col("_d.n_words").alias("n_words")), matches


def contamination_digest(documents: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per document: hit words, items, and the verdict.

    A word is counted once however many ranges cover it: ranges are taken in
    order and each adds only what lies beyond all earlier ones.
    """
    w = Window.partitionBy("segment", "doc").orderBy("begin", "stop").rowsBetween(Window.unboundedPreceding, -1)
    hits = (matches.select("segment", "doc", "begin", "stop").distinct()
            .withColumn("_reached", F.coalesce(F.max("stop").over(w), F.lit(0)))
            .groupBy("segment", "doc")
            .agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("begin", "_reached"))).alias("n_hit")))
    found = (matches.select("segment", "doc", "item_id").distinct().groupBy("segment", "doc")
             .agg(F.count(F.lit(1)).alias("n_items"),
                  F.concat_ws(",", F.array_sort(F.collect_list(F.col("item_id").cast("string")))).alias("_items")))
    none = F.lit(0).cast("long")
    return (documents.join(hits, ["segment", "doc"], "left").join(found, ["segment", "doc"], "left")
            .select("doc_id", "text_key", "n_words", F.coalesce("n_hit", none).alias("n_hit"),
                    F.coalesce("n_items", none).alias("n_items"),
                    F.sha2(F.coalesce("_items", F.lit("")), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
