"""Benchmark decontamination against a plain version, and its edge cases."""

import itertools
import random

from tests.llm import brute
from tests.llm.helpers import SF, collected, rows, same
from tickroll.llm import decontamination as d
from tickroll.llm.catalog import QUERIES

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def run(spark, docs, items, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string, segment int, n_words string")
    documents, matches = d.find_contamination(df, spark.createDataFrame(items, "item_id long, text string"), **options)
    return documents, matches


def test_query_on_the_documents(spark):
    same(QUERIES["op2_decontamination"](spark, SF), COLUMNS,
         brute.contamination(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text")))


def test_edge_cases(spark):
    phrase = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(1, phrase), (2, "Short item"), (3, None), (4, " .,"), (None, "lonely"), (5, phrase.upper()), (6, "é̀ ßa")]
    docs = [(1, None, 1, "x"), (2, "", 1, "x"), (3, phrase, 1, "x"), (3, phrase, 1, "x"), (None, "x " + phrase + " " + phrase, 1, "x"),
            (4, phrase.rsplit(" ", 2)[0], 1, "x"), (5, "a SHORT, item b", 1, "x"), (6, "short", 1, "x"), (7, "item short", 1, "x"),
            (8, "w " * 5000 + "short item", 1, "x"), (9, "short-item-short item", 1, "x"), (10, "é̀ ßA", 1, "x")]
    documents, matches = run(spark, docs, [i for i in items if i[0] is not None])
    want = brute.contamination([x[:2] for x in docs], [i for i in items if i[0] is not None])
    same(d.contamination_digest(documents, matches), COLUMNS, want)


def test_phrases_do_not_cross_documents_or_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(d, "ITEM_BLOCK", 1)
    docs = [(i, t, 0, "") for i, t in enumerate(["a b", "c d", "a b c d e", "b c"])]
    items = [(1, "b c"), (2, "a b c d e"), (3, "zz")]
    df = spark.createDataFrame(docs, "doc_id long, text string, segment int, n_words string").coalesce(1)
    index = d.build_index(df, segment_words=4)
    assert index.count() > 1
    blocks = list(d.item_blocks(spark.createDataFrame(items, "item_id long, text string"), size=1))
    assert len(blocks) == 3
    got = d.find_contamination(df, spark.createDataFrame(items, "item_id long, text string"))
    same(d.contamination_digest(*got), COLUMNS, brute.contamination([x[:2] for x in docs], items))


def test_proximity(spark):
    docs = [(1, "alpha beta gamma delta", 0, ""), (2, "alpha x beta gamma y delta", 0, ""), (3, "alpha x x x beta gamma delta", 0, "")]
    item = [(9, "alpha beta gamma delta")]
    for slop, want in ((0, {1}), (2, {1, 2}), (3, {1, 2, 3})):
        documents, matches = run(spark, docs, item, slop=slop)
        hit = matches.join(documents, ["segment", "doc"]).select("doc_id").distinct().collect()
        assert {r[0] for r in hit} == want


def near_brute(text, phrase, slop):
    """Whether some choice of places has offsets that differ by slop at most."""
    found = text.split()
    choices = itertools.product(*[[i - k for i, w in enumerate(found) if w == term] for k, term in enumerate(phrase.split())])
    return any(max(c) - min(c) <= slop for c in choices)


def test_proximity_does_not_depend_on_the_other_documents_of_a_segment(spark):
    texts = ["a x b c y d", "a b", "c d", "b a d c", "d c b a", "a b x c d", "x a", "b c d", "a b c d"]
    rnd = random.Random(3)
    texts += [" ".join(rnd.choice("abcdxyz") for _ in range(rnd.randrange(1, 9))) for _ in range(40)]
    items = [(9, "a b c d"), (8, "b d")]
    for more in ([], ["a a a a a"], ["b b b b b", "c c c"], ["d d d d", "c c c c c", "a a"]):
        docs = [(i, t, 0, "") for i, t in enumerate([*texts, *[" ".join(m.split() * 30) for m in more]])]
        df = spark.createDataFrame(docs, "doc_id long, text string, segment int, n_words string").coalesce(1)
        for slop in (1, 2, 3):
            documents, matches = d.find_contamination(df, spark.createDataFrame(items, "item_id long, text string"), slop=slop)
            got = {(r["doc_id"], r["item_id"]) for r in matches.join(documents, ["segment", "doc"])
                   .filter("0 <= begin AND begin < stop AND stop <= n_words").collect()}
            assert {x for x in got if x[0] < len(texts)} == {
                (i, item) for i, t in enumerate(texts) for item, phrase in items if near_brute(t, phrase, slop)}


def test_empty_tables(spark):
    documents, matches = run(spark, [], [(1, "a b")])
    assert collected(d.contamination_digest(documents, matches), *COLUMNS) == []
    documents, matches = run(spark, [(1, "a b", 0, "")], [])
    same(d.contamination_digest(documents, matches), COLUMNS, brute.contamination([(1, "a b")], []))
