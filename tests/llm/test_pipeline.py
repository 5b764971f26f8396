"""The corpus pipeline, stage by stage, against plain versions."""

from collections import defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import SF, rows
from tickroll.llm import bpe, quality, secrets
from tickroll.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_on_the_documents(spark):
    docs = table(spark, SF, "documents")
    now = {r[0]: r for r in rows("documents", *COLUMNS)}
    found = {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF)
        if name != "encode":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            kept = {r["doc_id"]: tuple(r) for r in out.collect()}
            assert len(kept) == out.count()
        if name == "quality_rules":
            want = {i for i, r in now.items() if brute.quality_kept(r[1], quality.RULES, quality.STOP_WORDS)}
        elif name == "near_duplicates":
            want = {d for d, _, _, stays in brute.near_duplicates([(i, r[1]) for i, r in sorted(now.items())], 5, 80) if stays}
        elif name == "decontaminate":
            bench = rows("benchmark", "item_id", "text")
            want = {r[0] for r in brute.contamination([(i, r[1]) for i, r in now.items()], bench) if not r[5]}
        elif name == "redact_secrets":
            want = set(now)
            holders = defaultdict(set)
            for r in now.values():
                for value in values_of(r[1]):
                    holders[value].add((r[3], r[2]))
            for i, r in kept.items():
                said = brute.secrets_base(now[i][1])[3]
                live = [s for s in said if masked(value_of(now[i][1], s), holders)]
                assert ("[SECRET]" in r[1]) >= bool(live) and r[4] == len(r[1])
                assert not any(masked(value_of(r[1], s), holders) for s in brute.secrets_base(r[1])[3])
                if "[SECRET]" not in r[1]:
                    assert r == now[i]
        else:
            encoder = brute.rank_encoder()
            assert {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in out.collect()} == {
                i: (len(ids := encoder.encode_ordinary(r[1])), ids) for i, r in now.items()}
            break
        assert set(kept) == want, name
        found[name] = len(kept)
        if name != "redact_secrets":
            assert all(kept[i] == now[i] for i in kept)
        now = kept
        docs = out.select("*")
        path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/test-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    assert found["quality_rules"] > found["near_duplicates"] > found["decontaminate"] == found["redact_secrets"] > 0


def value_of(text, span):
    import re
    kind, a, b = span
    return re.search(r"[A-Za-z0-9+/_.=-]+$", text[a:b])[0] if kind == "assign" else text[a:b]


def masked(value, holders):
    """All but widely copied values that don't look random."""
    import re
    copied = (len({source for source, _ in holders[value]}) >= secrets.COPIED_OWNERS
              or len(holders[value]) >= secrets.COPIED_REPOSITORIES)
    looks = (re.search("[0-9]", value) and re.search("[A-Za-z]", value) and not re.search(secrets.PLACEHOLDERS, value)
             and len(set(value)) >= secrets.LEAST_DISTINCT)
    return not copied or bool(looks)


def values_of(text):
    return {value_of(text, s) for s in brute.secrets_base(text)[3]}


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in docs],
                                 "doc_id long, text string, lang string, source string, n_chars long, n_words string")


def test_stages_on_odd_rows(spark):
    prose = "The cat and the dog sat on the mat in the house by the sea with all of their many friends that day. "
    docs = [(1, prose), (1, prose), (2, prose + "x"), (None, prose), (None, None), (3, ""), (4, None), (5, "a " * 30_000)]
    df = frame(spark, docs)
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, df, SF)
        got = out.collect()
        assert function(spark, df.limit(0), SF).count() == 0
        if name == "near_duplicates":
            assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(
                [(1, prose), (None, None), (3, ""), (4, None), (5, "a " * 30_000)], key=repr)
        elif name == "quality_rules":
            assert sorted((r["doc_id"] for r in got), key=repr) == [1, 1, 2, None]
        elif name == "encode":
            assert len(got) == len(docs)
        else:
            assert len(got) == len(docs) and out.columns == df.columns


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    assert 0 < out.count() < table(spark, SF, "documents").count()
    assert out.filter(F.size("ids") != F.col("n_tokens")).count() == 0


def test_a_wrong_id_sequence_fails_the_last_stage(spark, monkeypatch):
    df = frame(spark, [(1, "the cat sat on the mat"), (2, "é日本🎉"), (None, None)])
    assert corpus_pipeline.encode(spark, df, SF).count() == 3
    right = bpe.encode_texts

    def wrong(*args, **options):
        return right(*args, **options).withColumn("ids", F.reverse("ids"))

    monkeypatch.setattr(bpe, "encode_texts", wrong)
    with pytest.raises(Exception, match="do not decode"):
        corpus_pipeline.encode(spark, df, SF).collect()
