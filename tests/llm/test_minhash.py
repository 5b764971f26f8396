"""Near-duplicates against a plain version, components, and edge cases."""

import random

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import SF, collected, rows, same
from tickroll.llm import minhash
from tickroll.llm.catalog import QUERIES
from tickroll.llm.components import components

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "x", b"") for i, t in docs], "doc_id long, text string, fp string, bands binary")
    return minhash.near_duplicates(df, **options)


def test_query_on_the_documents(spark):
    same(QUERIES["op3_minhash"](spark, SF), COLUMNS, brute.near_duplicates(rows("documents", "doc_id", "text")))


def test_large_groups_of_different_copies_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rnd.randrange(0, 7)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10 ** 6)}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, docs[7][1]) for i in range(60)]
    same(run(spark, docs, shingle=3, threshold=85), COLUMNS, brute.near_duplicates(docs))


def test_edge_cases(spark):
    long = " ".join(f"v{k % 997}" for k in range(50_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "Two words"), (5, "two\x0bWORDS"), (6, "one"), (7, "a b c"), (8, "A  b\nc"),
            (9, long), (10, long + " tail"), (11, "a b c"), (11, "a b c"), (12, "É b c"), (13, "é b c")]
    same(run(spark, docs, shingle=3, threshold=85), COLUMNS, brute.near_duplicates(docs))


def test_null_ids(spark):
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in
           run(spark, [(None, "a b c d"), (5, "a b c d"), (None, "x y z"), (None, "")], shingle=3).collect()}
    assert got == {(None, 5, False), (5, 5, True), (None, None, True)}


def test_empty_table(spark):
    assert collected(run(spark, [])) == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7000, 6999), (6999, 7000)]
    rnd = random.Random(1)
    rnd.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {7000: 6999, 6999: 6999}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").agg(F.count(F.lit(1))).first()[0] == 0
