"""The classifier chain: held-out accuracy, out-of-fold scores, and edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SF, rows
from tickroll.llm import toxicity as t
from tickroll.llm.catalog import QUERIES


def table(spark, docs):
    return spark.createDataFrame([(*d, 0.5, 1) for d in docs], "doc_id long, text string, score double, fold int")


def made(rnd, n, first=0):
    docs, labels = [], []
    for i in range(first, first + n):
        words = [f"{rnd.choice('abcdefgh')}{rnd.choice('klmnop')}{rnd.choice('aeiou')}{rnd.choice('rst')}n" for _ in range(rnd.randrange(10, 200))]
        kind = rnd.random()
        if kind < 0.15:
            words += rnd.sample(["idiot", "moron,", "Scum.", "clown", "loser"], 2)
        elif kind < 0.3:
            words += ["grobix" + rnd.choice(["en", "ung", "er", "t"]) for _ in range(3)]
        rnd.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(kind < 0.3)))
    return docs, labels


def test_held_out_accuracy_on_made_documents(spark):
    rnd = random.Random(9)
    docs, labels = made(rnd, 600)
    unseen, truth = made(rnd, 300, 1000)
    got = t.detect_toxicity(table(spark, docs + unseen), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), t.label_categories())
    found = {r["doc_id"]: r["toxic"] for r in got.collect()}
    want = {i: bool(y) for i, _, y in truth}
    hit = sum(found[i] and want[i] for i in want)
    assert hit >= 0.95 * sum(want.values()) and sum(found[i] and not want[i] for i in want) <= 3


def test_query_on_the_documents(spark):
    got = QUERIES["op4_toxicity"](spark, SF).toPandas().set_index("doc_id")
    truth = dict(rows("labels", "doc_id", "toxic"))
    clean = [i for i, y in truth.items() if not y]
    assert got.loc[clean, "toxic"].mean() <= 0.01
    assert got.loc[[i for i, y in truth.items() if y], "toxic"].mean() >= 0.7
    assert len(got) == len(rows("documents", "doc_id"))


def test_scores_for_training_are_out_of_fold(spark):
    """With labels at random, scores of models that saw a text would fit its label; out-of-fold ones can't."""
    rnd = random.Random(3)
    docs = [(i, " ".join(f"u{rnd.randrange(60)}" for _ in range(12))) for i in range(300)]
    df = table(spark, docs).select("doc_id", "text").withColumn("a", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    sample = t.sample_features(df, ["a"])
    _, scored = t.fit_chain(sample, ["a"])
    rows_ = scored.join(sample.select("doc_id", "a"), "doc_id").toPandas()
    assert len(rows_) == 300
    corr = np.corrcoef(rows_["score_a"], rows_["a"].astype(float))[0, 1] if rows_["score_a"].std() else 0.0
    assert abs(corr) < 0.25


def test_later_models_use_earlier_scores():
    rnd = np.random.default_rng(0)
    earlier = rnd.normal(size=(400, 1)) * 4
    y = earlier[:, 0] > 1
    model, score = t.fit_linear(np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32), earlier, y, np.ones(400, bool))
    assert model.earlier[0] > 0 and ((score > 0) == y).mean() > 0.9


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (None, "idiot"), (3, "a " * 100_000), (4, "!!! ..."), (4, "!!! ..."), (5, "clown é 日本")]
    for labels in ([], [(1, 1, 1)], [(2, 1, 0), (2, 0, 1), (None, 1, 1), (99, 1, 1), (5, None, None)]):
        marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        got = t.detect_toxicity(table(spark, docs), marks, t.label_categories())
        assert got.columns == ["doc_id", "p_insult", "p_toxic", "toxic"] and got.count() == len(docs)
        assert got.filter("p_toxic is null or toxic is null").count() == 0
        assert t.detect_toxicity(table(spark, []), marks, t.label_categories()).count() == 0


def test_each_model_keeps_its_own_best_features(spark, monkeypatch):
    """The union over the folds holds every feature that some model chooses, also where a cut applies."""
    monkeypatch.setattr(t, "MAX_FEATURES", 6)
    docs, labels = made(random.Random(5), 400)
    sample = t.sample_features(t.labelled_sample(
        table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {"toxic": F.col("toxic") == 1}), ["toxic"])
    pdf = sample.toPandas().sort_values("doc_id", kind="stable")
    row = np.repeat(np.arange(len(pdf)), pdf["index"].map(len))
    index, y = np.concatenate(pdf["index"].to_list()), pdf["toxic"].to_numpy(bool)
    want = set()
    for fold in range(t.FOLDS + 1):
        want |= set(t._chosen(row, index, y, pdf["fold"].to_numpy() != fold).tolist())
    got = t._selected(sample, "toxic", t.FOLDS)
    assert want and want <= set(got) and len(got) <= 6 * (t.FOLDS + 1)


def test_the_sample_takes_one_text_of_an_id_whatever_the_order(spark):
    docs = [(1, "b text"), (1, "a text"), (1, None), (2, None), (2, None)]
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    found = [sorted(map(tuple, t.labelled_sample(table(spark, d).repartition(n), labels, {"toxic": F.col("toxic") == 1}).collect()))
             for d, n in ((docs, 1), (docs[::-1], 3))]
    assert found[0] == found[1] and len(found[0]) == 2 and found[0][0][1] in ("a text", "b text") and found[0][1][1:] == (None, False)


def dense_model(x, past, y, train):
    """One model of the chain on dense counts: chosen columns, full-batch Adam; returns the scores of all rows."""
    has, n1, n0 = x > 0, (y & train).sum(), (~y & train).sum()
    a, b = has[y & train].sum(0), has[~y & train].sum(0)
    p = (a + b) / (n1 + n0)
    z = np.abs(a / n1 - b / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    scale = np.array([max(1.0, np.abs(c[train]).max()) for c in past.T])
    chosen = (a + b >= t.LEAST_DOCS) & (z >= t.LEAST_Z)
    base = (n1 + 0.5) / (n1 + n0 + 1.0)
    rows_ = np.hstack([x[:, chosen], past / scale if len(scale) else past, np.ones((len(x), 1))])
    w, m, v = np.zeros(rows_.shape[1]), 0.0, 0.0
    w[-1] = np.log(base / (1 - base))
    decay = np.append(np.full(len(w) - 1, t.RIDGE), 0.0)
    for step in range(1, t.STEPS + 1):
        error = (1 / (1 + np.exp(-np.clip(rows_ @ w, -30, 30))) - y)[train]
        g = rows_[train].T @ error / train.sum() + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return rows_ @ w


def test_the_chain_equals_a_dense_plain_version(spark):
    """Out-of-fold scores of both categories, and the scores of the first final model, from texts and labels alone."""
    docs, labels = made(random.Random(11), 240)
    toxic = np.array([y for _, _, y in labels], bool)
    insult = toxic & np.array([any(w in text.lower() for w in t.INSULTS) for _, text in docs])
    found = [[f for token in set(text.split()) for f in t.token_features(token)] for _, text in docs]
    names = sorted({f for fs in found for f in fs})
    x = np.array([[fs.count(f) for f in names] for fs in found], float)

    sample = t.sample_features(t.labelled_sample(
        table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), t.label_categories()), ["insult", "toxic"])
    models, scored = t.fit_chain(sample, ["insult", "toxic"])
    fold = sample.select("doc_id", "fold").toPandas().sort_values("doc_id")["fold"].to_numpy()
    oof = scored.toPandas().sort_values("doc_id")
    last = t.score_chain(table(spark, docs), models, ["insult", "toxic"]).toPandas().sort_values("doc_id")

    past, first, everything = np.empty((len(docs), 0)), None, np.ones(len(docs), bool)
    for name, y in (("insult", insult), ("toxic", toxic)):
        want = np.empty(len(docs))
        for f in range(t.FOLDS):
            want[fold == f] = dense_model(x, past, y, fold != f)[fold == f]
        np.testing.assert_allclose(oof[f"score_{name}"], want, atol=1e-6)
        if name == "insult":     # fitted on all, and applied to the same texts
            first = dense_model(x, past, y, everything)
            np.testing.assert_allclose(last["score_insult"], first, atol=1e-6)
        past = np.hstack([past, want[:, None]])
