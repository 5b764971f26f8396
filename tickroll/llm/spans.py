"""Substring dedup (operator 8): sliding spans of sentences.

Texts are cut into sentences. A sentence of fewer than ``SHORT`` words joins
the next one, and a long one is cut further, so a passage without full stops
is seen too: of every ``REACH`` gaps between words in a row, the one with the
least hash of the words on both sides is a cut. From every sentence on, the
shortest run of at least ``MIN_SENTENCES`` sentences with at least
``MIN_WORDS`` words is one span, hashed over its words.

Whether a gap is a border depends on fewer than ``REACH`` gaps on either side,
so within a repeated passage the borders are the same from ``REACH`` words
after its begin (``SHORT`` - 1 more if the rest of a sentence there is
shorter) to ``REACH`` words before its end, whatever stands around it. A
passage of 2 * ``REACH`` + ``MIN_WORDS`` + ``SHORT`` - 1 = 51 words or more
therefore always shares a span. All spans are joined globally by hash; the
first occurrence (least document, then place) stays, and the sentences under
every later one are removed; words of the passage outside its common borders
stay.

Texts travel twice only: once to be cut, where only hashes, sentence numbers
and each document's number of sentences leave the task, and once to meet their
own removal list. A text that has one is cut again there (places in code
points for all spans would take more disk than cutting the few takes time);
one that has none is passed on.

Defined cases: NULL text is read as empty and stays NULL; texts shorter than
a span keep all sentences; within one text the later repetition is removed
too; rows with equal id and text are one document and fare alike; rows that
share an id but not the text are ordered by a hash of it; a NULL id comes
after all others; columns of the same names are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import small_batches, stage, text_batches

MIN_SENTENCES = 2
MIN_WORDS = 20
MAX_WORDS = 16    # words that no sentence exceeds once it is cut
SHORT = 4         # words below which a sentence joins the next
REACH = MAX_WORDS - 2   # gaps between words in a row of which one is a cut

# Sentences end after . ! ? (and their wide forms) in front of white space, or at a line's end.
_END = re.compile(r"(?<=[.!?])(?:[\"')\]]*)\s+|\n\s*|(?<=[。！？])\s*")
_WORD = re.compile(r"\S+")


def _closes(words: list[str]) -> bool:
    """Whether a short sentence ends a unit all the same: by its own words, so that runs of short ones have borders too."""
    return bool(words) and zlib.crc32(" ".join(words).lower().encode()) % 4 == 0


def _cuts(words: list[str]) -> list[int]:
    """Words before which a long sentence is cut: of every ``REACH`` gaps in a row the last one with the least hash."""
    marks = [zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:])]
    out, least = [], -1
    for last in range(REACH - 1, len(marks)):
        first = last - REACH + 1
        if least < first:
            least = min(range(last, first - 1, -1), key=marks.__getitem__)
        elif marks[last] <= marks[least]:
            least = last
        else:
            continue
        out.append(least + 1)
    return out


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-cased words) of each sentence; text between two sentences belongs to the first."""
    out, begin, last, held, pieces = [], 0, 0, [], []
    for border in [*[m.end() for m in _END.finditer(text)], len(text)]:
        said = text[last:border].split()
        pieces.append((last, border))
        last = border
        held += said
        if border < len(text) and len(said) < SHORT and not _closes(said):
            continue
        a, b, words, joined = begin, border, [w.lower() for w in held], pieces
        begin, held, pieces = border, [], []
        if not words:
            if out:
                out[-1] = (out[-1][0], b, out[-1][2])
            elif b > a:
                out.append((a, b, []))
            continue
        if len(words) <= REACH:
            out.append((a, b, words))
            continue
        places = [m.start() for x, y in joined for m in _WORD.finditer(text, x, y)]
        cuts = _cuts(words)
        edges = [a, *[places[k] for k in cuts], b]
        out += [(x, y, words[i:j]) for x, y, i, j in zip(edges, edges[1:], [0, *cuts], [*cuts, len(words)])]
    return out


def span_hashes(parts: list[tuple[int, int, list[str]]]) -> Iterator[tuple[int, int, int]]:
    """(hash, first sentence, end sentence) of the span that begins at each sentence with words."""
    sizes = [len(words) for _, _, words in parts]
    joined = [" ".join(words) for _, _, words in parts]
    end = total = 0
    for first, size in enumerate(sizes):
        end = max(end, first)
        while end < len(sizes) and (total < MIN_WORDS or end - first < MIN_SENTENCES):
            total += sizes[end]
            end += 1
        if total < MIN_WORDS or end - first < MIN_SENTENCES:
            return
        if size:
            yield xxhash.xxh3_128_intdigest("\n".join(joined[first:end])), first, end
        total -= size


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every span: its hash (two longs), document (id, text_key), sentences, and whether the text has had it before.

    A row without a hash says the number of sentences of a document (``n``).
    Written once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = (1 << 64) - 1
        for batch in text_batches(batches, "t"):
            ids, keys = batch.column("d").to_pylist(), batch.column("k").to_pylist()
            rows: list[tuple] = []
            for doc, key, value in zip(ids, keys, batch.column("t").to_pylist()):
                seen: set[int] = set()
                parts = sentences(value) if value else []
                rows.append((None, None, doc, key, 0, len(parts), False))
                for h, first, end in span_hashes(parts):
                    rows.append((h & low, h >> 64, doc, key, first, end - first, h in seen))
                    seen.add(h)
            out = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.uint64()).view(pa.int64()), pa.array(out[1], pa.uint64()).view(pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int32()),
                 pa.array(out[5], pa.int32()), pa.array(out[6], pa.bool_())],
                names=["h1", "h2", "doc", "text_key", "first", "n", "again"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return stage(rows.withColumn("k", F.xxhash64("t")).mapInArrow(
        run, "h1 long, h2 long, doc long, text_key long, first int, n int, again boolean"), "sentence-spans")


def removals(found: DataFrame) -> DataFrame:
    """Per document (doc, text_key): number of sentences, and the sentence ranges of its repeated, non-first spans."""
    # (id, text) as one number, so that the least is found by a hash aggregate of two plain columns
    number = "decimal(38,0)"
    place = (F.when(F.col("doc").isNull(), F.lit("1" + "0" * 37).cast(number))
             .otherwise(F.col("doc").cast(number) * F.lit(2**32).cast(number)).cast(number)
             + F.shiftrightunsigned("text_key", 32).cast(number)).cast(number)
    once = found.filter(F.col("h1").isNotNull() & ~F.col("again")).drop("again")
    # written before the join: a span of very many documents is then split by Spark
    firsts = stage(once.withColumn("place", place).groupBy("h1", "h2").agg(F.min("place").alias("keeper"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").drop("n"), "span-firsts")
    later = once.join(firsts, ["h1", "h2"]).filter(place != F.col("keeper"))
    columns = ["doc", "text_key", "first", "n"]
    rows = later.select(*columns).unionByName(found.filter("again").select(*columns)).withColumn("sentences", F.lit(None).cast("int"))
    count = found.filter("h1 is null").select(*columns, F.col("n").alias("sentences"))
    return rows.unionByName(count).groupBy("doc", "text_key").agg(
        F.max("sentences").cast("long").alias("n_sentences"),
        F.collect_set(F.when(F.col("sentences").isNull(), F.struct("first", "n"))).alias("ranges"))


def dedup_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text without repeated spans, n_sentences, n_removed, removed (code point ranges)."""
    gone = removals(spans(docs, doc_id, text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.xxhash64("t") == F.col("text_key")), "left").select(
        "doc_id", "t", F.transform("ranges", lambda r: F.array(r["first"], r["n"])).alias("ranges"),
        F.coalesce("n_sentences", F.lit(0)).cast("long").alias("n_sentences"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "t"):
            texts, n_removed, removed = [], [], []
            for value, ranges in zip(batch.column("t").to_pylist(), batch.column("ranges").to_pylist()):
                drop = sorted({i for first, n in ranges or () for i in range(first, first + n)})
                parts = sentences(value) if drop else []
                merged: list[list[int]] = []
                for a, b, _ in map(parts.__getitem__, drop):
                    if merged and merged[-1][1] == a:
                        merged[-1][1] = b
                    else:
                        merged.append([a, b])
                kept, at = [], 0
                for a, b in merged:
                    kept.append(value[at:a])
                    at = b
                texts.append("".join(kept) + value[at:] if merged else value)
                n_removed.append(len(drop))
                removed.append(",".join(f"{a}:{b}" for a, b in merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("n_sentences"),
                 pa.array(n_removed, pa.int64()), pa.array(removed, pa.string())],
                names=["doc_id", "text", "n_sentences", "n_removed", "removed"])

    return joined.mapInArrow(cut, "doc_id long, text string, n_sentences long, n_removed long, removed string")
