"""Cut texts into chunks that byte-level BPE tokenizers encode independently.

The pre-tokenizer pattern of the GPT-2 family never joins what stands on the
two sides of a single white-space character between two other characters: a
space belongs to the piece after it, a line break is a piece of its own. Nor
does it join a letter and a full stop or comma after it. Texts may be cut
there, and the ids of the chunks laid end to end are the ids of the text.
Words repeat, so a task encodes a chunk once and looks it up afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A space between two characters that no definition calls white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
# Marks that the pattern separates from a letter before them.
MARKS = frozenset(".,;:!?")


def odd(part: str) -> bool:
    """A part of ``text.split(" ")`` next to which the text may not be cut."""
    return not part or part[0].isspace() or part[-1].isspace()


def chunks(part: str) -> list[str]:
    """The chunks of a part that follows no space and has no white space at its ends."""
    if "\n" in part:
        lines = part.split("\n")
        if any(map(odd, lines)):
            return [part]
        out = []
        for line in lines:
            out += ["\n", *chunks(line)] if out else chunks(line)
        return out
    if len(part) > 1 and part[-1] in MARKS and part[-2].isalpha():
        return [part[:-1], part[-1]]
    return [part]


class ChunkCache:
    """Encodes texts by their chunks.

    ``encode(chunks, spaced)`` gets many new chunks at a time (``spaced``: each
    has a space before it) and returns their values: the bytes of ids of type
    ``kind``. The parts of a batch of texts are made distinct and looked up by
    Arrow; only new ones are handled one by one. When the cache has ``limit``
    parts, those met in several batches stay (the most met half of the limit);
    chunks after no space are Python objects and fewer (``bare``).
    """

    def __init__(self, encode: Callable[[list[str], bool], list[bytes]], kind: np.dtype, limit: int = 800_000,
                 bare: int = 200_000):
        self._encode, self._type, self._limit, self._most_bare = encode, np.dtype(kind), limit, bare
        self._parts = pa.array([], pa.string())     # what follows a space
        self._ids = np.empty(0, self._type)         # their ids, end to end
        self._sizes = np.empty(0, np.int64)         # ids of each; -1 where a text may not be cut
        self._met = np.empty(0, np.int64)           # batches that had it
        self._bare: dict[str, bytes] = {}           # chunks that follow no space

    def _shrink(self) -> None:
        if len(self._bare) > self._most_bare:
            self._bare.clear()
        if len(self._parts) <= self._limit:
            return
        often = np.flatnonzero(self._met > 1)
        keep = np.sort(often[np.argsort(-self._met[often], kind="stable")[:self._limit // 2]])
        sizes = np.maximum(self._sizes, 0)
        self._ids = self._ids[_ranges(np.cumsum(sizes)[keep] - sizes[keep], sizes[keep])]
        self._parts, self._sizes, self._met = self._parts.take(pa.array(keep)), self._sizes[keep], self._met[keep] // 2 + 1

    def _learn(self, new: list[str], heads: list[str]) -> tuple[list[str], list[bytes | None], int]:
        """New parts with their values, those hardly ever met again last, and the number of the others."""
        simple, unsafe, compound = [], [], {}
        for part in new:
            if part.isalnum():
                simple.append(part)
            elif odd(part):
                unsafe.append(part)
            else:
                compound[part] = chunks(part)
        after = {c for pieces in compound.values() for c in pieces[1:]}
        for head in heads:
            after.update([head] if odd(head) else chunks(head))
        after = [c for c in after if c and c not in self._bare]
        self._bare.update(zip(after, self._encode(after, False)))

        # first chunks of compounds: known already, or new like the rest
        first = list({pieces[0] for pieces in compound.values()}.difference(simple))
        place = pc.index_in(pa.array(first, pa.string()), value_set=self._parts).to_pylist()
        fresh = simple + [c for c, p in zip(first, place) if p is None]
        value = dict(zip(fresh, self._encode(fresh, True)))
        starts = np.cumsum(np.maximum(self._sizes, 0)) - np.maximum(self._sizes, 0)
        for chunk, p in zip(first, place):
            if p is not None:
                value[chunk] = self._ids[starts[p]:starts[p] + self._sizes[p]].tobytes()
        joined = {part: b"".join([value[pieces[0]], *[self._bare[c] for c in pieces[1:]]])
                  for part, pieces in compound.items() if len(pieces) > 1}
        lasting = [part for part in joined if len(compound[part]) == 2]
        once = [part for part in joined if len(compound[part]) > 2]      # several lines
        parts = fresh + lasting + unsafe
        values = [value[p] for p in fresh] + [joined[p] for p in lasting] + [None] * len(unsafe)
        return parts + once, values + [joined[p] for p in once], len(parts)

    def _head(self, head: str) -> bytes:
        return b"".join([self._bare[c] for c in ([head] if odd(head) else chunks(head))]) if head else b""

    def encoded(self, texts: pa.Array) -> list[bytes]:
        """The value of each text of a string array without nulls."""
        self._shrink()
        n, item = len(texts), self._type.itemsize
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = split.flatten().dictionary_encode()
        words, index = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        heads = offsets[:-1]
        after = np.ones(len(index), bool)
        after[heads] = False
        used = np.zeros(len(words), bool)
        used[index[after]] = True
        head_words = words.take(pa.array(index[heads])).to_pylist()

        # where each distinct part stands in the cache; new ones are added behind
        where = pc.index_in(words, value_set=self._parts).fill_null(-1).to_numpy().astype(np.int64)
        unknown = np.flatnonzero(used & (where < 0))
        new = words.take(pa.array(unknown)).to_pylist()
        parts, values, lasting = self._learn(new, head_words)
        base = len(self._parts)
        place = {part: base + i for i, part in enumerate(parts)}
        where[unknown] = [place[part] for part in new]
        ids = np.concatenate([self._ids, np.frombuffer(b"".join([v or b"" for v in values]), self._type)])
        sizes = np.concatenate([self._sizes, np.array([-1 if v is None else len(v) // item for v in values], np.int64)])
        met = np.concatenate([self._met, np.zeros(len(parts), np.int64)])
        met[where[used]] += 1

        # texts that may not be cut at every space are cut where it is allowed
        several = np.diff(offsets) > 1
        unsafe = np.array([odd(h) for h in head_words], bool) & several
        uncut = used.copy()
        uncut[used] = sizes[where[used]] < 0
        unsafe[np.repeat(np.arange(n), np.diff(offsets))[uncut[index] & after]] = True

        first = [self._head(h) for h in head_words]
        ids_all = np.concatenate([ids, np.frombuffer(b"".join(first), self._type)])
        sizes_all = np.concatenate([np.maximum(sizes, 0), np.array([len(v) // item for v in first], np.int64)])
        starts = np.cumsum(sizes_all) - sizes_all
        at = where[index]
        at[heads] = len(sizes) + np.arange(n)
        counts = sizes_all[at]
        laid = ids_all[_ranges(starts[at], counts)]
        bounds = np.concatenate([[0], np.cumsum(counts)])[offsets]
        out = [laid[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
        for i in np.flatnonzero(unsafe):
            begin, *rest = CUT.split(texts[i].as_py())
            out[i] = b"".join(self._encode([begin], False) + self._encode(rest, True))

        stay = base + lasting
        self._parts = pa.concat_arrays([self._parts, pa.array(parts[:lasting], pa.string())])
        self._sizes, self._met = sizes[:stay], met[:stay]
        self._ids = ids[:int(np.maximum(self._sizes, 0).sum())]
        return out


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i]``, ..., ``starts[i] + counts[i] - 1`` of every i, end to end."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
