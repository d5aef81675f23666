"""Cross-entropy difference against a plain model."""

import math
import re
from collections import Counter

import pytest

from ledgerframe.llm import lm_scoring as op
from ledgerframe.llm.common import table


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def plain_scores(docs, sides):
    """Scores of rows (id, text) one by one, each without its own counts where it was counted."""
    grams, seen, starts = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for (_, text), side in zip(docs, sides, strict=True):
        if side < 2 and words(text):
            w = words(text)
            seen[side].update(w)
            grams[side].update(zip([None, *w[:-1]], w, strict=True))
            starts[side] += 1
    outcomes, out = len(set(seen[0]) | set(seen[1])) + 2, []
    total = [sum(x.values()) for x in seen]
    for (i, text), side in zip(docs, sides, strict=True):
        w, p = words(text), []
        own, mine = Counter(w), Counter(zip([None, *w[:-1]], w, strict=True))
        for s in (0, 1):
            less = 1 if s == side else 0
            sums = 0.0
            for a, b in zip([None, *w[:-1]], w, strict=True):
                first = starts[s] - less if a is None else seen[s][a] - less * own[a]
                pair = math.log(grams[s][a, b] - less * mine[a, b] + op.ADDED) - math.log(first + op.ADDED * outcomes)
                one = math.log(seen[s][b] - less * own[b] + op.ADDED) - math.log(total[s] - less * len(w) + op.ADDED * (outcomes - 1))
                sums += op.WEIGHT * pair + (1 - op.WEIGHT) * one
            p.append(sums)
        out.append((i, len(w), (p[1] - p[0]) / len(w) if w else None))
    return out


@pytest.mark.parametrize("ids", [op.BROADCAST_IDS, 0])
def test_matches_plain_model(spark, ids, monkeypatch):
    """With all of the likely words cached, and with few; whether ids are broadcast or joined by shuffle."""
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    docs = docs.select("doc_id", "text").union(docs.select("doc_id", "text").limit(3)).union(spark.createDataFrame([(7001, "again " * 70_000), (None, "no id")], "doc_id long, text string"))
    own = op.matched_corpora
    monkeypatch.setattr(op, "matched_corpora", lambda *a: own(*a, most_ids=ids))
    if not ids:
        monkeypatch.setattr(op, "CACHED", 64)
    rows = op.matched_corpora(docs, labels, "doc_id", "text").collect()
    want = plain_scores([(r["doc_id"], r["text"]) for r in rows], [r["side"] for r in rows])
    got = [(r["doc_id"], r["n_tokens"], r["score"]) for r in op.score_documents(docs, labels).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert len(got) == len(want) and {r["side"] for r in rows} == {0, 1, 2}
    for (i, n, score), (j, m, plain) in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert (i, n) == (j, m) and score == (None if plain is None else pytest.approx(plain, abs=1e-9)), i


def test_target_like_text_scores_low(spark):
    docs = spark.createDataFrame([(i, "the good words of the target text " * 3 if i % 2 else "some other noise from the web page " * 3) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 20, 2)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["score"] for r in op.score_documents(docs, labels).collect()}
    assert max(out[i] for i in range(1, 40, 2)) < min(out[i] for i in range(0, 40, 2))


def test_large_counts_split():
    import numpy as np

    rows = np.zeros(2, np.dtype([("hi", "u4"), ("lo", "u2"), ("side", "u1"), ("n", "i8")]))
    rows["hi"], rows["n"] = [5, 9], [200_000, 3]
    out = op.split_counts(rows, op._GRAM)
    assert out["n"][out["hi"] == 5].sum(dtype=np.int64) == 200_000 and out["n"][out["hi"] == 9].tolist() == [3]


def test_own_counts_are_left_out(spark):
    """A counted document that resembles no other one scores as if it had not been counted."""
    docs = [(i, f"common words of a page {i % 3} " * 4) for i in range(12)] + [(50, "quite unlike anything else here"), (51, "quite unlike anything else here too")]
    labels = spark.createDataFrame([(i, 1, 0) for i in (0, 2, 4, 6, 50)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["score"] for r in op.score_documents(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()}
    assert abs(out[50]) < 0.3


def test_odd(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 1, 0), (6, 0, 1), (77, 1, 0)], "doc_id long, quality int, toxic int")
    out = op.score_documents(odd_docs, labels).collect()
    assert len(out) == odd_docs.count()
    assert all((r["score"] is None) == (r["n_tokens"] == 0) for r in out)
    assert op.score_documents(odd_docs.limit(0), labels).count() == 0
    assert {r["score"] for r in op.score_documents(odd_docs, labels.limit(0)).collect()} <= {None, 0.0}
