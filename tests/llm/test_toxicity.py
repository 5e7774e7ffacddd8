import random
import zlib

import numpy as np
import pytest

from wordloom.llm import toxicity


def all_segments(weights):
    """Maximal segments by the definition: recursion on the best segment, its left and its right."""

    def inside(low, high):
        best = None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += weights[j]
                if total > 0 and (best is None or total > best[2] + 1e-12):
                    best = (i, j, total)
        if best is None:
            return []
        return inside(low, best[0]) + [best] + inside(best[1] + 1, high)

    return inside(0, len(weights))


@pytest.mark.parametrize("seed", range(20))
def test_linear_scan_finds_the_maximal_segments(seed):
    r = np.random.default_rng(seed)
    weights = r.normal(-0.3, 1.0, 60)
    before = np.concatenate(([0.0], np.cumsum(weights)))
    got = toxicity.segments(weights, before, np.flatnonzero(weights > 0))
    want = all_segments(weights.tolist())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


@pytest.fixture(scope="module")
def corpus(words):
    r, plain = random.Random(9), words(3000, 3)
    rows, labels = [], []
    for i in range(1500):
        text = [r.choice(plain) for _ in range(r.randrange(20, 200))]
        toxic = i % 5 == 0
        for _ in range(r.randrange(2, 6) if toxic else 0):
            text.insert(r.randrange(len(text)), r.choice(["vilest", "grobian" + r.choice(plain), "Schuft,"]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark, docs_of, corpus):
    rows, labels = corpus
    odd = [(None, "vilest grobianx schuft", None), (9001, None, "s"), (9002, "", "s"), (9001, rows[0][1], "s"),
           (9003, "calm " * 200_000 + "vilest schuft grobiane vilest", "s")]
    docs = docs_of(rows + odd)
    table = spark.createDataFrame(labels + [(0, 1), (None, 1), (9002, None), (77777, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, table)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    empty = [r.score for r in got if r.doc_id == 9002]
    assert empty == [min(r.score for r in got)]
    toxic = next(r for r in got if r.doc_id == 9003)
    assert toxic.passages and toxic.passages[-1].first_word >= 200_000
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == sum(1 - r.predicted for r in got)


def test_no_labels(spark, docs_of, corpus):
    docs = docs_of(corpus[0][:20])
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert {r.predicted for r in toxicity.score_toxicity(docs, model).collect()} == {0}
    assert toxicity.score_toxicity(docs_of([]), model).count() == 0
