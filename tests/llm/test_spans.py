"""Sentence span dedup against a plain version, planted passages, and edge cases."""

import random

from tests.llm.helpers import SF, collected, rows
from tickroll.llm import spans
from tickroll.llm.catalog import QUERIES

COLUMNS = ["doc_id", "text", "n_sentences", "n_removed"]


def expected(docs):
    """Brute force: all spans of all documents by their words, first occurrences kept."""
    order = sorted({(d is None, d or 0, d, t) for d, t in docs if t is not None}, key=lambda x: x[:2])
    cut = {(d, t): spans.sentences(t) for _, _, d, t in order}
    places = {}
    for _, _, d, t in order:
        parts = cut[d, t]
        for i in range(len(parts)):
            j, n = i, 0
            while j < len(parts) and (n < spans.MIN_WORDS or j - i < spans.MIN_SENTENCES):
                n += len(parts[j][2])
                j += 1
            if n >= spans.MIN_WORDS and j - i >= spans.MIN_SENTENCES and parts[i][2]:
                places.setdefault(tuple(tuple(p[2]) for p in parts[i:j]), []).append((d, t, i, j))
    drop = {}
    for found in places.values():
        for d, t, i, j in found[1:]:
            drop.setdefault((d, t), set()).update(range(i, j))
    out = []
    for d, t in docs:
        parts, gone = cut.get((d, t), []), drop.get((d, t), set())
        out.append((d, None if t is None else "".join(t[a:b] for k, (a, b, _) in enumerate(parts) if k not in gone), len(parts), len(gone)))
    return sorted(out, key=repr)


def run(spark, docs):
    return spans.dedup_spans(spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, first int, ranges string"))


def test_query_on_the_documents(spark):
    assert collected(QUERIES["op8_spans"](spark, SF), *COLUMNS) == expected(rows("documents", "doc_id", "text"))


def words(rnd, n):
    return [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]


def prose(rnd, n):
    out = words(rnd, n)
    return " ".join(w + (". " if rnd.random() < 0.12 else "") for w in out)


def test_planted_passages_are_removed_and_clean_documents_stay(spark):
    rnd = random.Random(4)
    passage = " ".join(" ".join(words(rnd, n)) + "." for n in (14, 9, 17, 12, 8))
    no_stops = " ".join(words(rnd, 5)) + ". " + " ".join(words(rnd, 60))
    docs = [(i, prose(rnd, 80) + ". " + (passage if i < 20 else no_stops) + " " + prose(rnd, 60)) for i in range(40)]
    docs += [(100 + i, prose(rnd, 200)) for i in range(40)]
    got = {r["doc_id"]: r for r in run(spark, docs).collect()}
    assert all(got[100 + i]["n_removed"] == 0 for i in range(40))
    assert got[0]["n_removed"] == got[20]["n_removed"] == 0
    middle = " ".join(passage.split(". ")[1:4])
    assert all(middle.split()[-1] not in got[i]["text"] for i in range(1, 20))
    assert all(no_stops.split()[30] not in got[i]["text"] for i in range(21, 40))


TEXT = "One two three four five six. Seven eight nine ten eleven twelve. Thirteen fourteen fifteen sixteen. A b c d e f g h."


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " \n "), (4, TEXT), (5, TEXT.upper().replace(" ", "  ")), (4, TEXT), (None, "Intro.\n" + TEXT), (6, "Short. Same."),
            (7, "Short. Same."), (8, TEXT + "\n" + TEXT), (9, "word " * 30_000), (10, "日本語。テスト。" * 50), (11, "x. " * 500)]
    assert collected(run(spark, docs), *COLUMNS) == expected(docs)


def test_sentences_cover_the_text():
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "bc", " ", "  ", ".", "! ", "?\"", "\n", "。", "é ", ") "]) for _ in range(rnd.randrange(80)))
        parts = spans.sentences(text)
        assert "".join(text[a:b] for a, b, _ in parts) == text
        assert "".join(w for *_, ws in parts for w in ws) == "".join(text.lower().split())
        assert all(len(ws) <= spans.MAX_WORDS for *_, ws in parts)


def shared(a, b):
    """Whether two texts have a span in common."""
    return bool({h for h, *_ in spans.span_hashes(spans.sentences(a))} & {h for h, *_ in spans.span_hashes(spans.sentences(b))})


def unique(rnd, n):
    return [f"u{rnd.getrandbits(60)}" for _ in range(n)]


def passage_of(rnd, kind, n):
    """n words: without full stops, in sentences of any length, in sentences of 26 words, or in lines of one to three words."""
    out = unique(rnd, n)
    if kind == "lines":
        return " ".join(w + ("\n" if rnd.random() < 0.5 else "") for w in out)
    if kind == "no closer":     # short lines of which none ends a unit by its own words
        return "\n".join([w for w in unique(rnd, 4 * n) if not spans._closes([w])][:n])
    return " ".join(w + ("." if kind == "mixed" and rnd.random() < 0.15 or kind == "26" and k % 26 == 25 else "") for k, w in enumerate(out))


def test_passages_share_a_span_behind_prefixes_of_every_length():
    rnd = random.Random(8)
    for kind in ("no stops", "mixed", "26", "lines"):
        for n in [51, 52, 53, 60, 75, 100, 200, 400]:
            for prefix in range(32):
                passage = passage_of(rnd, kind, n)
                a = " ".join([*unique(rnd, rnd.randrange(32)), passage, *unique(rnd, rnd.randrange(20))])
                b = " ".join([*unique(rnd, prefix), passage, *unique(rnd, rnd.randrange(20))])
                assert shared(a, b), (kind, n, prefix)
    # lines of which none is a border of its own, and a word that is repeated
    for prefix in range(32):
        lines = passage_of(rnd, "no closer", 80)
        assert shared("Some words here.\n" + lines, " ".join(unique(rnd, prefix)) + "\n" + lines)
        assert shared("x " + "same " * 60, " ".join(unique(rnd, prefix)) + " same" * 60)


def test_embedded_passages_against_runs_of_words(spark):
    """Brute force over words: what goes lies in runs of MIN_WORDS words said before, and of every passage the inner part goes."""
    rnd = random.Random(9)
    docs, planted = [], {}
    for k, (kind, n) in enumerate([("no stops", 51), ("no stops", 130), ("26", 52), ("mixed", 70), ("lines", 90), ("no stops", 400)]):
        passage = passage_of(rnd, kind, n)
        for prefix in range(32):
            docs.append((100 * k + prefix, " ".join([*unique(rnd, prefix), passage, *unique(rnd, rnd.randrange(1, 20))])))
            planted[docs[-1][0]] = (prefix, n)
    said: set[tuple] = set()
    got = {r["doc_id"]: r for r in run(spark, docs).collect()}
    for doc, text in docs:
        found = text.split()
        windows = [tuple(found[i:i + spans.MIN_WORDS]) for i in range(len(found) - spans.MIN_WORDS + 1)]
        before = {p for i, w in enumerate(windows) if w in said for p in range(i, i + spans.MIN_WORDS)}
        said.update(windows)
        left = set(got[doc]["text"].split())
        gone = {p for p, w in enumerate(found) if w not in left}
        assert gone <= before, doc
        prefix, n = planted[doc]
        if prefix:
            assert len(gone) >= spans.MIN_WORDS
            # at either end at most a stretch without a common border, and at the end a span that is not whole
            assert set(range(prefix + 17, prefix + n - 27)) <= gone
        else:
            assert not gone


def test_empty_table(spark):
    assert collected(run(spark, [])) == []
