"""Trie nodes against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.llm.helpers import collected
from tickroll.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    new = {}
    for c, v in own.items():
        base, h = c - (c % 5 if c >= 0 else -(-c % 5)), zlib.crc32(str(c).encode()) % 9
        new[c] = tuple(v if base == c else own.get(base, [])[:h] + v[h:])
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, v in new.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(new[c]) == len(p))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items()), key=repr)


def talks():
    rng, rows = random.Random(1), []
    for c in range(40):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            rows.append((c, rng.choice([None, t, t]), rng.choice(["user", None]), rng.choice(["a", "b", None, "é"])))
    rows += [(c, t, "u", "same") for c in (50, 55, 60, 65, 70, 71, 72) for t in range(13)]
    rows += [(c, t, "u", f"same{c % 3 if t == 10 else 0}") for c in (80, 85, 90, 95, 100) for t in range(12)]
    return rows + [(None, 1, "u", "x"), (-3, 0, "u", "n"), (-5, 0, "u", "same"), (7, 1, "u", "again"), (7, 1, "u", "again")]


@pytest.mark.parametrize("burst, segment", [(4096, 64), (1, 64), (4096, 4), (1, 4), (2, 3), (1, 1)])
def test_nodes_equal_plain_prefixes(spark, burst, segment):
    rows = talks()
    assert collected(prefix_trie.build(spark.createDataFrame(rows, SCHEMA), burst, segment)) == brute(rows)


def test_long_conversations(spark):
    """Two long ones part late, a third is their common beginning; pieces of ids are digested in order."""
    rows = [(c, t, "u", f"{t}" if t < 700 or c == 0 else f"{t}!") for c in (0, 5) for t in range(900)]
    rows += [(10, t, "u", f"{t}") for t in range(640)]
    rows += [(c, 0, "u", "0") for c in range(100, 3000, 5)]
    assert collected(prefix_trie.build(spark.createDataFrame(rows, SCHEMA), 64)) == brute(rows)


def test_no_rows_and_clashing_columns(spark):
    assert collected(prefix_trie.build(spark.createDataFrame([], SCHEMA))) == []
    df = spark.createDataFrame([(5, 0, "u", "a", 1, "x")], SCHEMA + ", depth long, ids string")
    assert collected(prefix_trie.build(df)) == brute([(5, 0, "u", "a")])
