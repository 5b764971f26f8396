"""Quality rules against a plain version, the labels, and edge cases."""

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import SF, collected, rows
from tickroll.llm import quality
from tickroll.llm.catalog import QUERIES
from tickroll.llm.common import table

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def expected(docs):
    return sorted(((d, *brute.quality(t)) for d, t in docs), key=repr)


def test_query_on_the_documents(spark):
    got = QUERIES["op7_quality"](spark, SF)
    assert collected(got, *COLUMNS) == expected(rows("documents", "doc_id", "text"))


def test_verdicts_agree_with_the_labels(spark):
    """Clean documents stay but for the fixed base rule; nearly all junk goes."""
    rows_ = (quality.judge(table(spark, SF, "documents")).join(table(spark, SF, "labels"), "doc_id")
             .select("quality", "base_failed", "kept").collect())
    clean = [r["kept"] for r in rows_ if r["quality"] == 1 and not r["base_failed"]]
    assert clean.count(False) <= 0.01 * len(clean)
    junk = [r["kept"] for r in rows_ if r["quality"] == 0]
    assert junk.count(True) <= 0.1 * len(junk)


def test_passing_rows_come_back_as_they_were(spark):
    docs = table(spark, SF, "documents").select("*", F.lit(7).alias("n_words"))
    got = quality.passing(docs)
    assert got.columns == docs.columns
    want = {d for d, t in rows("documents", "doc_id", "text") if brute.quality_kept(t, quality.RULES, quality.STOP_WORDS)}
    assert {r["doc_id"] for r in got.select("doc_id", "n_words").collect() if r["n_words"] == 7} == want


TEXTS = [None, "", " \n\t\x0b ", "one", "a b c d e a b c d e", "a a a a a a a a a a a a", "x\nx\n x\nx \n\n\nx", "# * $ % & | < >", "é日🎉 ß\u00a0q",
         "\x0c".join(["p"] * 4), "a b c d e f " * 2000, "\n".join(["same line here"] * 500), "w" * 50_000, "\ta b\r\nc"]


def test_edge_cases(spark):
    docs = [(None if i == 4 else i, t) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame([(d, t, 5, False, "k") for d, t in docs], "doc_id long, text string, n_words int, kept boolean, _t string")
    judged = quality.judge(df)
    assert collected(judged, *COLUMNS) == expected(docs)
    assert judged.columns.count("n_words") == judged.columns.count("kept") == 1
    assert quality.judge(df.limit(0)).collect() == []


def test_rules_are_one_projection(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    assert quality.judge(df, rules=[]).first()["kept"]
    assert quality.judge(df, rules=[quality.Rule("long", "n_words", None, 5)]).first()["failed_rules"] == ["long"]
    plan = quality.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert quality.judge(df).select(F.size("failed_rules")).first()[0] == 0
