"""MinHash near-duplicate detection (operator 3).

1. Each text becomes its set of distinct word shingles (as 64-bit hashes), a
   fingerprint of the set, and the minima of ``BANDS * ROWS`` universal hash
   functions. Texts with equal sets are one *class*.
2. Minima are banded; classes that agree in a whole band share a bucket.
   There are as many bands as it takes for a pair at the linking similarity
   to miss all of them with a chance below 1e-6 (24 at 0.85, 35 at 0.8).
3. Buckets are cut into blocks of bounded size; a bucket of several blocks is
   dealt as pairs of blocks, so every pair of its members still meets, in a
   task of bounded memory. A pair is looked at only in the first band that it
   shares. Pairs are compared inside the task and never written out: step one
   compares signatures and keeps the members that have a possible partner,
   step two confirms their links on the full sets and writes a spanning
   forest of each block (at most one edge per member).
4. Large-star and small-star steps turn the edges into components.

Defined cases: NULL or wordless texts have an empty set and are linked with
nothing; a text of fewer words than a shingle has its whole sequence as one
shingle; repeated rows are members of one class (all get the class's
component); a row with a NULL id is compared like any other but names no
component, and is kept only if no member has an id and its text has the least
hash; ties are broken by the smallest id; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import small_batches, stage, text_batches
from tickroll.llm.components import components

SHINGLE = 5
THRESHOLD = 80            # percent
ROWS = 5                  # minima of a band
MISSED = 1e-6             # chance that a pair at the threshold shares no band
BLOCK = 256               # classes of a bucket compared in one block, and
BLOCK_SHINGLES = 4_000_000  # their shingles on average (long texts make smaller blocks)
CACHE_WORDS = 300_000   # word hashes kept per task before the cache is dropped
SLACK = 6.0               # standard deviations of the signature estimate below the threshold

# A-Z to lower case, white space [\x20\x09-\x0D] to one separator.
WORD_TABLE = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))



def band_count(threshold: int) -> int:
    """Bands needed for a pair of ``threshold`` percent similarity."""
    shared = (min(threshold, 99) / 100) ** ROWS
    return max(1, math.ceil(math.log(MISSED) / math.log1p(-shared)))


def hash_family(threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the universal hash functions, the same in every task."""
    rng, n = np.random.default_rng(20240229), band_count(threshold) * ROWS
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


FEATURES = "doc_id long, text_key long, n_shingles long, fp binary, bands array<long>, sketch binary"


class _WordHashes(dict):
    """64-bit hash per word, computed once per task while the cache lasts."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``."""
    words = text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(hashes) > CACHE_WORDS:
        hashes.clear()
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def minima(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray], chunk: int = 4096) -> np.ndarray:
    """The least value of each universal hash function over the set (multiply-add on 64 bits)."""
    multipliers, addends = family
    least = np.full(len(multipliers), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), chunk):
        values = shingles[at:at + chunk, None] * multipliers + addends
        least = np.minimum(least, values.min(axis=0))
    return least


def features(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: set size, set fingerprint, band keys and an 8-bit signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, family = _WordHashes(), hash_family(threshold)
        for batch in text_batches(batches, "t"):
            sizes, prints, bands, sketches = [], [], [], []
            for value in batch.column("t").to_pylist():
                found = shingle_set(value, shingle, hashes)
                sizes.append(len(found))
                if not len(found):
                    prints.append(None)
                    bands.append(None)
                    sketches.append(None)
                    continue
                least = minima(found, family)
                prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(np.array([xxhash.xxh3_64_intdigest(least[b * ROWS:(b + 1) * ROWS].tobytes(), seed=b)
                                       for b in range(len(least) // ROWS)], np.uint64).view(np.int64))
                sketches.append((least >> np.uint64(24)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("k"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "fp", "bands", "sketch"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return stage(rows.withColumn("k", F.xxhash64("t")).mapInArrow(run, FEATURES), "minhash-features")


def _blocks(members: DataFrame, key: str) -> DataFrame:
    """Deal each bucket's members into blocks, or pairs of blocks, of bounded size.

    ``members`` has the bucket's size ``n`` and its ``shingles``. Adds ``lo``,
    ``hi`` (the pair of blocks a row is dealt to) and ``own`` (its own block).
    """
    parts = F.greatest(F.ceil(F.col("n") / F.lit(BLOCK)), F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES)), F.lit(1)).cast("int")
    return (members.withColumn("own", F.pmod(F.xxhash64("fp", key), parts).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .withColumn("lo", F.least("own", "_other")).withColumn("hi", F.greatest("own", "_other"))
            .drop("_other", "n", "shingles"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (key, lo, hi), from batches in which they lie together."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "lo", "hi")]
        cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for first, last in zip(bounds, bounds[1:]):
            group_key = tuple(int(c[first]) for c in columns)
            if held and group_key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = group_key
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def _possible(group: pa.Table, limit: int) -> np.ndarray | None:
    """Matrix of the pairs of a group to look at: agreeing signatures, first shared band, blocks that meet here."""
    n = group.num_rows
    if n < 2:
        return None
    sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(n, -1)
    bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    band = int(np.flatnonzero(bands[0] == group["key"][0].as_py())[0])
    own = group["own"].to_numpy()
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    out = np.zeros((n, n), bool)
    for i in range(n - 1):
        rest = slice(i + 1, n)
        near = (sketch[rest] == sketch[i]).sum(1) >= limit
        if lo != hi:
            near &= own[rest] != own[i]
        if band and near.any():
            near &= ~(bands[rest, :band] == bands[i, :band]).any(1)
        out[i, rest] = near
    return out | out.T


def _signature_limit(threshold: int) -> int:
    """Signature agreements that a linked pair falls short of with a chance of about 1e-8."""
    n, p = band_count(threshold) * ROWS, threshold / 100
    return int(n * p - SLACK * (n * p * (1 - p)) ** 0.5)


def _meetings(classes: DataFrame, threshold: int) -> DataFrame:
    """(key, lo, hi, own, fp): members of each block that have a possible partner there."""
    keyed = classes.select("fp", "size", F.explode("bands").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles")).filter("n > 1")
    members = keyed.drop("size").join(crowded, "key").join(classes.select("fp", "bands", "sketch"), "fp")
    limit = _signature_limit(threshold)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            pairs = _possible(group, limit)
            if pairs is not None and pairs.any():
                kept = group.select(["key", "lo", "hi", "own", "fp"]).filter(pa.array(pairs.any(1)))
                yield from kept.combine_chunks().to_batches()

    return stage(_together(_blocks(members, "key").select("key", "lo", "hi", "own", "fp", "bands", "sketch"))
                 .mapInArrow(look, "key long, lo int, hi int, own int, fp binary"), "minhash-meetings")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of a bounded block of sets (exact, by a product of 0/1 matrices)."""
    n = len(sets)
    values, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = counts > 1                     # a shingle of one set adds to no intersection
    column = np.cumsum(shared) - 1
    chosen = shared[where]
    owner, column = owner[chosen], column[where[chosen]]
    width = int(shared.sum())
    total = np.zeros((n, n), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(1, 4_000_000 // n)           # at most 16 MB a matrix
    for first in range(0, width, step):
        a, b = np.searchsorted(column, (first, first + step))
        marks = np.zeros((n, min(step, width - first)), np.float32)
        marks[owner[a:b], column[a:b] - first] = 1
        total += (marks @ marks.T).astype(np.int64)
    return total


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a block."""
    unseen, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not unseen[root]:
            continue
        unseen[root] = False
        todo = [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & unseen)
            unseen[new] = False
            edges += [(at, int(x)) for x in new]
            todo += new.tolist()
    return edges


def _links(meetings: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Spanning edges (a, b) of the confirmed links of each block."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            own = group["own"].to_numpy()
            prints = group["fp"].to_pylist()
            found = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
            if len(found) < 2:
                continue
            both = _overlaps(found)
            size = np.array([len(s) for s in found])
            linked = 100 * both >= threshold * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            edges = _forest(linked)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([prints[i] for i, _ in edges], pa.binary()),
                                                  pa.array([prints[j] for _, j in edges], pa.binary())], names=["a", "b"])

    rows = meetings.join(sets, "fp").select("key", "lo", "hi", "own", "fp", "shingles")
    return _together(rows).mapInArrow(confirm, "a binary, b binary")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links reach, the document
    itself included; ``kept`` marks the document of that id. ``text_key`` is a
    64-bit hash of the text (it tells apart rows that share an id).
    """
    rows = features(docs, shingle, threshold, doc_id, text)
    classes = stage(rows.filter("fp is not null").groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("who"),
        F.max("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "minhash-classes")
    meetings = _meetings(classes, threshold)

    # full sets of the classes that meet another one, from one document of each
    wanted = (meetings.select("fp").distinct().join(classes.select("fp", "who"), "fp")
              .select("fp", F.col("who.doc_id").alias("_id"), F.col("who.text_key").alias("_key")))
    source = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    texts = (source.withColumn("k", F.xxhash64("t"))
             .join(wanted, F.col("d").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_key"))).select("fp", "t"))

    def collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in text_batches(batches, "t"):
            found = [shingle_set(t, shingle, hashes).tobytes() for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(found, pa.binary())], names=["fp", "shingles"])

    sets = texts.mapInArrow(collect_sets, "fp binary, shingles binary").dropDuplicates(["fp"])
    links = stage(_links(meetings, sets, threshold), "minhash-links")
    members = components(links, "a", "b")

    # the smallest id of each component, then back to every document
    who = classes.select("fp", "who")
    named = members.join(who.withColumnRenamed("fp", "node"), "node")
    roots = named.groupBy("root").agg(F.min("who").alias("first"))
    named = named.join(roots, "root").select(F.col("node").alias("fp"), "first")
    # written before the join: a class of very many copies is then split by Spark
    named = stage(who.join(named, "fp", "left").select("fp", F.coalesce("first", "who").alias("first")), "minhash-names")
    own = F.col("doc_id") == F.col("component_id")
    unnamed = F.col("component_id").isNull() & F.coalesce(F.col("text_key") == F.col("first.text_key"), F.lit(True))
    return (rows.select("doc_id", "text_key", "n_shingles", "fp").join(named, "fp", "left")
            .withColumn("component_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")))
            .select("doc_id", "text_key", "n_shingles", "component_id", F.coalesce(own, unnamed).alias("kept")))
