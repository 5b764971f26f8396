"""Byte-level BPE encoding and decoding by prefix dynamic programming (operator 6).

For a vocabulary of ranked byte strings the encoding of a byte string is the
result of merging, again and again, the adjacent pair whose union has the
lowest rank (the leftmost of equals). Merging never crosses the border
between two tokens of the final encoding, and a crossing merge would show
already in the pair alone; hence

* every prefix of an encoding is the encoding of that prefix, and
* tokens laid end to end are an encoding exactly if each adjacent pair is.

So each byte prefix has one *valid last token*: the one that ends there, is
in the vocabulary, and forms a valid pair with the valid last token of the
prefix in front of it. Storing that token per prefix gives the encoding by
walking back from the end, lets text be appended without looking at what is
already encoded, and lets an edit be re-encoded from the edit on until the
stored tokens agree again.

The pre-tokenizer pattern is applied first; a piece that is itself in the
vocabulary is one token, whatever the merges say (as in rank-file encoders).

Defined cases: NULL text is read as empty; empty text has no ids; repeated
rows and NULL ids are encoded row by row; extra columns are ignored; special
token strings are ordinary text.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickroll.llm.chunks import ChunkCache
from tickroll.llm.common import large_batches, small_batches, whole_text

PAIRS = 1_000_000   # token pairs that a worker remembers (about 120 MB)


def load_ranks(path: str) -> dict[bytes, int]:
    """Read a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixBpe:
    """BPE over one piece of bytes by valid last tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._valid: dict[int, bool] = {}       # left << 32 | right
        # finds all tokens that end at a byte, the longest first
        self._ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._ends.add_word(token.decode("latin-1"), (len(token), rank))
        self._ends.make_automaton()

    def merged(self, piece: bytes) -> list[int]:
        """The encoding by definition: merge the lowest-ranked pair until none is left."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(((self.ranks[u], i) for i in range(len(parts) - 1)
                        if (u := parts[i] + parts[i + 1]) in self.ranks), default=None)
            if best is None:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def _pair(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes; left -1 is the start."""
        key = left << 32 | right
        known = self._valid.get(key)
        if known is None:
            a, b = self.tokens.get(left, b""), self.tokens[right]
            known = bool(left == -1 or a + b not in self.ranks) and (
                self.merged(a + b) == ([right] if left == -1 else [left, right]))
            if len(self._valid) > PAIRS:
                self._valid.clear()
            self._valid[key] = known
        return known

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> list[int]:
        """Add the valid last tokens of the prefixes of ``data`` that ``last`` does not hold yet.

        ``last[n]`` is the token that ends the encoding of ``data[:n]``;
        ``last[0]`` is -1. Appending costs only the new bytes.
        """
        stop = len(data) if stop is None else stop
        done, valid = len(last), self._valid
        low = max(0, done - self.longest)
        for at, (size, token) in self._ends.iter(data[low:stop].decode("latin-1")):
            end = low + at + 1
            if end < done:
                continue
            if end > done:
                raise ValueError("the vocabulary lacks a byte")
            left = last[end - size]
            fits = valid.get(left << 32 | token)
            if self._pair(left, token) if fits is None else fits:
                last.append(token)
                done += 1
        if done <= stop:
            raise ValueError("the vocabulary lacks a byte")
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The encoding of the whole prefix, from its last tokens."""
        out, at = [], len(last) - 1
        while at > 0:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def edited(self, old: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """Last tokens after ``old[start:stop]`` became ``new``.

        Tokens in front of the edit stay. Behind it, as soon as the last
        tokens of as many prefixes in a row as the longest token has bytes
        agree with the old ones, all later ones do, and are taken over.
        """
        data, shift = old[:start] + new + old[stop:], len(new) - (stop - start)
        now, behind = last[:start + 1], start + len(new)
        while len(now) <= len(data):
            self.extend(data, now, min(len(data), len(now) + self.longest))
            end = len(now) - 1
            if end - self.longest >= behind and now[-self.longest:] == last[end - shift + 1 - self.longest:end - shift + 1]:
                return data, now + last[end - shift + 1:]
        return data, now

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of the pre-tokenizer."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.walk(self.extend(piece, [-1]))


class TextBpe:
    """Whole texts: the pre-tokenizer pattern, then ``PrefixBpe`` per piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = PrefixBpe(ranks)
        self.pattern = regex.compile(pattern)

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.bpe.encode(piece.encode("utf-8"))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bpe.tokens[i] for i in ids])


class OpenText:
    """An encoded text that can be appended to and edited; only what changes is encoded again."""

    def __init__(self, encoder: TextBpe, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.pieces: list[str] = []
        self._last: list[list[int]] = []
        self.append(text)

    def ids(self) -> list[int]:
        bpe, out = self.encoder.bpe, []
        for piece, last in zip(self.pieces, self._last):
            whole = bpe.ranks.get(piece.encode("utf-8"))
            out += [whole] if whole is not None else bpe.walk(last)
        return out

    def append(self, more: str) -> None:
        """Only the last piece can grow; its stored prefixes are kept."""
        if not more:
            return
        tail, last = (self.pieces.pop(), self._last.pop()) if self.pieces else ("", [-1])
        self.text += more
        for piece in self.encoder.pattern.findall(tail + more):
            data, old = piece.encode("utf-8"), tail.encode("utf-8")
            same = 0
            while same < min(len(data), len(old)) and data[same] == old[same]:
                same += 1
            self.pieces.append(piece)
            self._last.append(self.encoder.bpe.extend(data, last[:same + 1]))
            tail, last = "", [-1]

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace ``text[start:stop]``: split again from two pieces before the edit until old borders are met."""
        text = self.text[:start] + new + self.text[stop:]
        shift = len(new) - (stop - start)
        borders, at = [], 0
        for piece in self.pieces:
            borders.append(at)
            at += len(piece)
        first = max(0, sum(b < start for b in borders) - 3)
        old_border = {b + shift: k for k, b in enumerate(borders) if b >= stop}
        at = borders[first] if borders else 0
        pieces, lasts, rest = self.pieces[:first], self._last[:first], len(self.pieces)
        for found in self.encoder.pattern.finditer(text, at):
            if found.start() in old_border and found.start() >= start + len(new):
                rest = old_border[found.start()]
                break
            k, data = len(pieces), found.group().encode("utf-8")
            # a changed piece keeps what its old bytes and stored tokens still say
            if k < len(self.pieces):
                was, last = self.pieces[k].encode("utf-8"), self._last[k]
                a = 0
                while a < min(len(was), len(data)) and was[a] == data[a]:
                    a += 1
                b = 0
                while b < min(len(was), len(data)) - a and was[-1 - b] == data[-1 - b]:
                    b += 1
                last = self.encoder.bpe.edited(was, last, a, len(was) - b, data[a:len(data) - b])[1]
            else:
                last = self.encoder.bpe.extend(data, [-1])
            pieces.append(found.group())
            lasts.append(last)
        self.text, self.pieces, self._last = text, pieces + self.pieces[rest:], lasts + self._last[rest:]


_WORKER: dict[tuple, ChunkCache] = {}


def _task_cache(ranks: dict[bytes, int], pattern: str) -> ChunkCache:
    """The worker's chunk cache for a vocabulary; a worker process keeps it from task to task."""
    key = (len(ranks), hash(frozenset(ranks.items())), pattern)
    if key not in _WORKER:
        encoder = TextBpe(ranks, pattern)
        _WORKER.clear()
        _WORKER[key] = ChunkCache(lambda parts, spaced: [
            array("i", encoder.encode(" " + part if spaced else part)).tobytes() for part in parts], np.int32)
    return _WORKER[key]


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id",
                 text: str = "text", decode: bool = False, verify: bool = False) -> DataFrame:
    """``(doc_id, ids)`` for every row: the ids of its whole text (NULL read as empty).

    ``decode`` adds ``decoded``, the bytes that the ids stand for; ``verify``
    decodes too, raises an error where they do not say the text, and adds
    ``verified``, the CRC-32 of the (decimal, comma-joined) ids that did. Both
    ways in one step, so that a task needs one Python worker and texts and ids
    pass between the JVM and Python once.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: its size is fixed
    names = ["doc_id", "ids", *["decoded"] * decode, *["verified"] * verify]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _task_cache(shared.value, pattern)
        token = {rank: token for token, rank in shared.value.items()} if decode or verify else {}
        tokens = [token.get(i) for i in range(max(token, default=-1) + 1)]
        for batch in large_batches(batches, "t"):
            found = cache.encoded(batch.column("t"))
            ends = np.cumsum([0, *[len(f) // 4 for f in found]], dtype=np.int32)
            columns = [batch.column("d"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))]
            if decode or verify:
                each = [np.frombuffer(f, np.int32).tolist() for f in found]
                said = [b"".join([tokens[i] for i in ids]) for ids in each]
            if decode:
                columns.append(pa.array(said, pa.binary()))
            if verify:
                for doc, one, own in zip(batch.column("d"), said, batch.column("t")):
                    if one != own.as_py().encode():
                        raise ValueError(f"token ids of document {doc.as_py()} do not decode to its text")
                columns.append(pa.array([zlib.crc32(",".join(map(str, ids)).encode()) for ids in each], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(doc_id).cast("long").alias("d"), whole_text(text).alias("t")).mapInArrow(
        run, "doc_id long, ids array<int>" + ", decoded binary" * decode + ", verified long" * verify)


def ids_in_decimal(ids: str = "ids") -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), ",")


def verified_ids() -> Column:
    """The ids of a verified row, if they still are the ones that were decoded; an error else."""
    return F.when(F.crc32(ids_in_decimal()) == F.col("verified"), F.col("ids")).otherwise(
        F.raise_error(F.concat(F.lit("token ids of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("NULL")),
                               F.lit(" do not decode to its text"))))


def decode_ids(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``(doc_id, ids_text, decoded)``: the ids in decimal, and the bytes they stand for."""
    shared = rows.sparkSession.sparkContext.broadcast({r: t for t, r in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = [shared.value.get(i) for i in range(max(shared.value, default=-1) + 1)]
        decimal = [str(i) for i in range(len(tokens))]
        for batch in batches:
            texts, decoded = [], []
            offsets = batch.column("ids").offsets.to_numpy()
            flat = batch.column("ids").values.to_numpy(zero_copy_only=False)
            for first, last in zip(offsets, offsets[1:]):
                ids = flat[first:last].tolist()
                texts.append(",".join([decimal[i] for i in ids]))
                decoded.append(b"".join([tokens[i] for i in ids]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()),
                                              pa.array(decoded, pa.binary())], names=["doc_id", "ids_text", "decoded"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids_text string, decoded binary")
