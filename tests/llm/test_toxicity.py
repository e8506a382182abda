import itertools
import random
import zlib

import numpy as np
import pytest

from plateful.llm import toxicity
from tests.llm.cases import SCHEMA, clashing, documents, frame, prose

INSULTS = ["gromblat", "snerkling", "vilpoth", "druzzik", "fomblewit"]


def labelled(n=260):
    draw, rows, labels = random.Random(8), [], []
    for i in range(n):
        words, toxic = prose(i, draw.randint(5, 150)).split(), i % 4 == 0
        for _ in range(draw.randint(2, 4) if toxic else 0):
            words.insert(draw.randrange(len(words) + 1), draw.choice(INSULTS) + draw.choice(["", ",", "!"]))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_forward_backward_matches_all_paths():
    draw = np.random.default_rng(1)
    scores, moves = draw.normal(0, 2, (3, 6)), np.array([-0.7, 0.4, 1.1])
    marginals, pairs = toxicity.forward_backward(scores, moves)
    for row, p, e in zip(scores, marginals, pairs.T):
        total, on, moved = 0.0, np.zeros(6), np.zeros(3)
        for path in itertools.product((0, 1), repeat=6):
            steps = [*zip(path, path[1:])]
            count = np.array([steps.count((0, 1)), steps.count((1, 0)), steps.count((1, 1))])
            weight = np.exp(np.dot(path, row) + count @ moves)
            total, on, moved = total + weight, on + weight * np.array(path), moved + weight * count
        assert p == pytest.approx(on / total) and e == pytest.approx(moved / total)


def one_long_chain(scores, moves):
    """Marginals of one chain word by word, and its expected moves."""
    m = np.array([[1, np.exp(moves[0])], [np.exp(moves[1]), np.exp(moves[2])]])
    nodes = np.column_stack([np.ones(len(scores)), np.exp(scores)])
    forward, backward = [nodes[0] / nodes[0].sum()], [np.array([0.5, 0.5])]
    for x in nodes[1:]:
        forward.append(forward[-1] @ m * x)
        forward[-1] = forward[-1] / forward[-1].sum()
    for x in nodes[:0:-1]:
        backward.append(m @ (x * backward[-1]))
        backward[-1] = backward[-1] / backward[-1].sum()
    on = np.array(forward) * np.array(backward[::-1])
    pairs = np.zeros(3)
    for f, b, x in zip(forward, backward[-2::-1], nodes[1:]):
        joint = f[:, None] * m * (x * b)[None, :]
        joint /= joint.sum()
        pairs += [joint[0, 1], joint[1, 0], joint[1, 1]]
    return on[:, 1] / on.sum(axis=1), pairs


@pytest.mark.parametrize("moves", [(-0.7, 0.4, 1.1), (-3.0, -1.0, 2.5), (0.0, 0.0, 0.0)])
def test_a_text_is_one_chain_wherever_its_rows_are_cut(moves):
    draw, moves = np.random.default_rng(4), np.array(moves)
    passage = np.array([2.5, -0.5, 1.5, 3.0, -1.0, 2.0])
    model = toxicity.Model({}, 0.0, moves, np.zeros(3))
    lengths = [*range(0, 70), 127, 128, 129, 640, 1000]
    scored = [np.concatenate([draw.normal(-1.5, 1, n), passage, draw.normal(-1.5, 1, 90)]) for n in lengths]
    scored += [np.array([-2.0]), np.array([]), draw.normal(0, 3, 64)]
    tagger = toxicity.Tagger(model)
    texts = [[f"t{i}x{j}" for j in range(len(x))] for i, x in enumerate(scored)]
    tagger.known = {w: v for words, x in zip(texts, scored) for w, v in zip(words, x)}
    for found, x in zip(tagger.marginals(texts), scored):
        if len(x):
            assert np.abs(found - one_long_chain(x, moves)[0]).max() < 1e-9
    ends = np.cumsum([len(x) for x in scored])
    rows, place, nth = toxicity._windows(np.concatenate(scored), ends, toxicity._OUT)
    real = np.zeros(rows.size, dtype=bool)
    real[place] = True
    real = real.reshape(rows.shape)
    start, end = toxicity.carried(rows, moves, real, nth)
    expected = toxicity.forward_backward(rows, moves, start, end, real)[1]
    assert expected.sum(axis=1) == pytest.approx(sum(one_long_chain(x, moves)[1] for x in scored if len(x)))


def test_held_out_documents(spark):
    rows, labels = labelled()
    report = toxicity.toxicity_report(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in report if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in report)


def test_spans_are_the_insults(spark):
    rows, labels = labelled()
    report = toxicity.toxicity_report(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    right = wrong = 0
    for r in report:
        text = rows[r["doc_id"]][1]
        for span in filter(None, r["spans"].split(",")):
            start, end = map(int, span.split(":"))
            good = any(w in text[start:end] for w in INSULTS)
            right, wrong = right + good, wrong + (not good)
    assert right > 120 and wrong < 0.05 * right


def test_held_out_labels_are_never_read(spark):
    rows, labels = labelled()
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = [{r["doc_id"]: r["score"] for r in toxicity.toxicity_report(
        frame(spark, rows), spark.createDataFrame(x, LABELS)).collect()} for x in (labels, flipped)]
    assert a == b


def test_awkward_rows(spark):
    rows, labels = labelled(120)
    docs = clashing(frame(spark, rows + [(5000 + (d[0] or 0), *d[1:]) for d in documents()] + [(None, "gromblat x vilpoth", None, None, None)]),
                    "score", "toxic", "spans", "place")
    labels = spark.createDataFrame(labels + [(None, None, None), (3, None, None), (7, 1, 0), (7, 1, 0), (9999, 1, 1)], LABELS)
    report = toxicity.toxicity_report(docs, labels).collect()
    assert len(report) == docs.count()
    empty = {r["score"] for r in report if r["doc_id"] in (5200, 5201, 5202)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert len({r["score"] for r in report if r["doc_id"] == 5206}) == 1


def test_long_text_is_scored_whole(spark):
    rows, labels = labelled()
    long = prose(77, 20_000).split()
    clean, late = " ".join(long), " ".join([*long, "gromblat", "so", "druzzik", "and", "vilpoth"])
    report = toxicity.toxicity_report(frame(spark, rows + [(9001, clean, None, None, None), (9002, late, None, None, None)]),
                                      spark.createDataFrame(labels, LABELS)).filter("doc_id > 9000").collect()
    assert {r["doc_id"]: r["predicted"] for r in report} == {9001: 0, 9002: 1}


def test_without_labels_or_documents(spark):
    rows, labels = labelled(20)
    none = toxicity.toxicity_report(frame(spark, rows), spark.createDataFrame([], LABELS)).collect()
    assert {(r["score"], r["predicted"], r["spans"]) for r in none} == {(0.0, 0, "")}
    one = [(i, q, 0) for i, q, _ in labels]
    assert {r["score"] for r in toxicity.toxicity_report(frame(spark, rows), spark.createDataFrame(one, LABELS)).collect()} == {0.0}
    assert toxicity.toxicity_report(frame(spark, [], SCHEMA), spark.createDataFrame(labels, LABELS)).count() == 0
