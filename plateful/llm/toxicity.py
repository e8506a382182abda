"""Toxicity scores from a linear-chain conditional random field over words.

Labels mark whole documents, so words are labelled first: on a bounded sample of labelled documents,
words that tell toxic documents from clean ones are picked, then words and word beginnings that
explain most of the toxic documents not yet explained; where they occur in toxic documents, words are labelled toxic.
A chain of two states, with weights for the word, its beginnings and its end, is trained on these
labelled words. Over a text, forward-backward gives every word its marginal probability; runs
of likely words are the offending spans, and the two highest marginals give the document's
score by a logistic curve fitted on the sample.

The sample is bounded by ``Sample``; scoring covers whole texts of all documents, and a text is one
chain however long it is. The work is done in rows of ``WINDOW`` words: the moves over a row are one matrix, with
which the forward message is carried on and the backward one back from row to row. Defined results: a very long text is scored whole; a NULL or empty text scores as one without an offending
word; rows that repeat score alike, whatever their label; without labels of both kinds every
score is 0; an empty table gives an empty result; other columns are not read.
"""

import re
import string
from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plateful.llm.shared import WORD, broadcast_below

WINDOW = 64
CACHED_WORDS = 500_000
FLOOR = 1e-7
_WORDS = re.compile(WORD)
_EDGES = string.punctuation + "«»“”„‘’…–—¿¡"
_OUT = -30.0


class Sample(NamedTuple):
    """Bounds of the labelled sample: documents per label, and the longest text in it."""

    toxic: int = 1500
    clean: int = 3000
    max_chars: int = 10_000


def features(word: str) -> list[str]:
    core = word.lower().strip(_EDGES)
    return [f"w {core}", f"4 {core[:4]}", f"6 {core[:6]}", f"e {core[-4:]}"] if core else ["w"]


def marks(word: str) -> list[str]:
    """What may mark a word as toxic: the word itself or its beginning."""
    core = word.lower().strip(_EDGES)
    return [f"w {core}"] + [f"{n} {core[:n]}" for n in (3, 4, 5) if len(core) > n]


def toxic_marks(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Marks that tell toxic texts from clean ones."""
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())
    where, clean = defaultdict(set), Counter()
    for i in np.flatnonzero(toxic).tolist():
        for m in {m for w in set(texts[i]) for m in marks(w)}:
            where[m].add(i)
    where = {m: rows for m, rows in where.items() if len(rows) > 2}
    for i in np.flatnonzero(~toxic).tolist():
        clean.update({m for w in set(texts[i]) for m in marks(w)} & where.keys())

    def gain(k, c, of):
        """Log-likelihood gain of a mark in k of ``of`` toxic and c clean texts over one that ignores the label."""
        share = of / (of + n_clean)
        p = (k + 0.01) / (k + c + 0.02)
        return k * np.log(p / share) + c * np.log(max(1 - p, 1e-9) / (1 - share)) if p > share else 0.0

    # A chance mark must not pass: the gain needed grows with the number of marks to choose from.
    least = np.log(max(len(where), 2)) + 2
    pure = {m: rows for m, rows in where.items()
            if clean[m] <= 0.02 * len(rows) * max(1.0, n_clean / n_toxic)}
    # A word that near copies share stands between the same words in all of them.
    places = defaultdict(set)
    for i in np.flatnonzero(toxic).tolist():
        words = ["", *texts[i], ""]
        for before, w, after in zip(words, words[1:], words[2:]):
            for m in marks(w):
                if m in pure:
                    places[m].add((before, after))
    pure = {m: rows for m, rows in pure.items() if len(places[m]) >= max(3, 0.5 * len(rows))}
    chosen = {m for m, rows in pure.items()
              if m[0] == "w" and gain(min(len(rows), len(places[m])), clean[m], n_toxic) >= least}
    open_rows = set(np.flatnonzero(toxic).tolist()).difference(*(pure[m] for m in chosen))
    while open_rows and pure:
        best = max(pure, key=lambda m: (gain(len(pure[m] & open_rows), clean[m], len(open_rows)), len(m), m))
        if gain(len(pure[best] & open_rows), clean[best], len(open_rows)) < least:
            break
        chosen.add(best)
        open_rows -= pure[best]
    return chosen


class Model(NamedTuple):
    """Weights of features for state 1 against 0, scores of moves (0 to 1, 1 to 0, 1 to 1), curve of the score."""

    weights: dict[str, float]
    bias: float
    moves: np.ndarray
    curve: np.ndarray


def forward_backward(scores: np.ndarray, moves: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None,
                     real: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 (rows, words), and the expected moves (0 to 1, 1 to 0 and 1 to 1; rows).

    ``start`` is the share of state 1 in the message that comes from the row before, NaN where a text begins,
    ``end`` that in the message from the row after, and ``real`` is false for places after the end of a text.
    Without them every row is a chain of its own. A move into a row counts for that row.
    """
    node = np.exp(np.clip(scores, _OUT, -_OUT))
    enter, leave, stay = np.exp(moves)
    n, size = node.shape
    first = np.ones(n, dtype=bool) if start is None else np.isnan(start)
    before = np.zeros(n) if start is None else np.where(first, 0.0, start)
    real = np.ones((n, size), dtype=bool) if real is None else real
    forward, backward = np.empty((n, size)), np.empty((n, size))
    # Shares of state 1 suffice: both messages are scaled to add up to 1.
    one = ((1 - before) * enter + before * stay) * node[:, 0]
    f = np.where(first, node[:, 0] / (1 + node[:, 0]), one / (one + (1 - before) + before * leave))
    forward[:, 0] = f
    for t in range(1, size):
        one = ((1 - f) * enter + f * stay) * node[:, t]
        f = one / (one + (1 - f) + f * leave)
        forward[:, t] = f
    b = np.full(n, 0.5) if end is None else end
    backward[:, -1] = b
    for t in range(size - 2, -1, -1):
        ahead = b * node[:, t + 1]
        zero, one = (1 - b) + ahead * enter, (1 - b) * leave + ahead * stay
        b = np.where(real[:, t + 1], one / (zero + one), b)
        backward[:, t] = b
    on = forward * backward
    marginals = on / (on + (1 - forward) * (1 - backward))

    def moved(f, b, x):
        pairs = np.stack([(1 - f) * enter * x * b, f * leave * (1 - b), f * stay * x * b])
        return pairs / (pairs.sum(axis=0) + (1 - f) * (1 - b))

    inside = np.where(real[:, 1:], moved(forward[:, :-1], backward[:, 1:], node[:, 1:]), 0.0).sum(axis=2)
    return marginals, inside + np.where(first, 0.0, moved(before, backward[:, 0], node[:, 0]))


def carried(scores: np.ndarray, moves: np.ndarray, real: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``start`` and ``end`` of each row for :func:`forward_backward`; ``nth`` is the number of a row in its text.

    A text's rows follow one another. All words of a row are one 2 x 2 matrix, and messages are passed on
    through these, for the rows of all texts with the same number at once.
    """
    n, size = scores.shape
    start, end = np.where(nth == 0, np.nan, 0.5), np.full(n, 0.5)
    most = int(nth.max(initial=0))
    if most == 0:
        return start, end
    node = np.exp(np.clip(scores, _OUT, -_OUT))
    enter, leave, stay = np.exp(moves)
    # Rows from[0], from[1] of the product; nothing moves into the first word of a text.
    whole = np.zeros((4, n))
    whole[0], whole[3] = 1.0, 1.0
    for t in range(size):
        a, b, c, d = whole
        into = [a + b * leave, (a * enter + b * stay) * node[:, t], c + d * leave, (c * enter + d * stay) * node[:, t]]
        if t == 0:
            into = [np.where(nth == 0, x, y) for x, y in zip((a, b * node[:, 0], c, d * node[:, 0]), into)]
        new = np.stack(into)
        whole = np.where(real[:, t], new / new.sum(axis=0), whole)
    by_number = np.argsort(nth, kind="stable")
    cuts = np.searchsorted(nth[by_number], np.arange(most + 2))
    message = np.full((2, n), 0.5)
    for k in range(1, most + 1):
        own = by_number[cuts[k]:cuts[k + 1]]
        (a, b, c, d), (zero, one) = whole[:, own - 1], message[:, own - 1]
        new = np.stack([zero * a + one * c, zero * b + one * d])
        message[:, own] = new / new.sum(axis=0)
        start[own] = message[1, own]
    back = np.full((2, n), 0.5)
    for k in range(most, 0, -1):
        own = by_number[cuts[k]:cuts[k + 1]]
        (a, b, c, d), (zero, one) = whole[:, own], back[:, own]
        new = np.stack([a * zero + b * one, c * zero + d * one])
        back[:, own - 1] = new / new.sum(axis=0)
        end[own - 1] = back[1, own - 1]
    return start, end


def _windows(flat: np.ndarray, ends: np.ndarray, fill) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive texts cut into rows of ``WINDOW``, for each entry of ``flat`` its place in them, and each row's number in its text."""
    sizes = np.diff(ends, prepend=0)
    rows = -(-sizes // WINDOW)
    shift = (np.cumsum(rows) - rows) * WINDOW - (ends - sizes)
    place = np.arange(len(flat)) + np.repeat(shift, sizes)
    out = np.full(int(rows.sum()) * WINDOW, fill, dtype=flat.dtype)
    out[place] = flat
    return out.reshape(-1, WINDOW), place, np.arange(int(rows.sum())) - np.repeat(np.cumsum(rows) - rows, rows)


def train_chain(texts: list[list[str]], labels: list[np.ndarray], epochs: int = 6, rate: float = 0.5,
                ridge: float = 1e-4, seed: int = 7) -> tuple[dict[str, float], float, np.ndarray]:
    """Weights by adaptive gradient steps on batches of rows.

    The messages from the rows around are those of the weights at the beginning of an epoch.
    """
    counts = Counter(f for words in texts for w in set(words) for f in features(w))
    index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n > 1))}
    none = len(index)
    known = {}
    for word in {w for words in texts for w in words}:
        ids = [index.get(f, none) for f in features(word)]
        known[word] = ids + [none] * (4 - len(ids))
    ends = np.cumsum([len(t) for t in texts])
    flat = np.array([known[w] for words in texts for w in words], dtype=np.int32).reshape(-1, 4)
    rows, place, nth = _windows(np.arange(len(flat)), ends, -1)
    truth = np.concatenate(labels).astype(float)
    before = np.where(nth > 0, truth[np.maximum(rows[:, 0] - 1, 0)], 0.0)
    rng = np.random.default_rng(seed)
    # All chains with a toxic word, and as many times three without.
    has = np.zeros(len(rows), dtype=bool)
    has[place[truth > 0] // WINDOW] = True
    others = np.flatnonzero(~has)
    used = np.concatenate([np.flatnonzero(has), rng.permutation(others)[:3 * int(has.sum()) + 500]])
    weights, bias, moves = np.zeros(none + 1), np.array([-2.0]), np.zeros(3)
    seen = [np.full_like(x, 1e-6) for x in (weights, bias, moves)]
    for _ in range(epochs):
        known_scores = weights[flat].sum(axis=1) + bias
        start, end = carried(np.where(rows >= 0, known_scores[rows], _OUT), moves, rows >= 0, nth)
        for some in np.array_split(rng.permutation(used), max(1, len(used) // 256)):
            at = rows[some]
            real = at >= 0
            ids, y = flat[at], np.where(real, truth[at], 0.0)
            scores = np.where(real, weights[ids].sum(axis=2) + bias, _OUT)
            p, expected = forward_backward(scores, moves, start[some], end[some], real)
            error = np.where(real, p - y, 0.0) / len(some)
            last = np.column_stack([before[some], y[:, :-1]])
            here = real & ((nth[some] > 0)[:, None] | (np.arange(WINDOW) > 0))
            observed = np.where(here, np.stack([(1 - last) * y, last * (1 - y), last * y]), 0.0).sum(axis=2)
            slopes = (np.bincount(ids.ravel(), np.repeat(error.ravel(), 4), none + 1) + ridge * weights,
                      np.array([error.sum()]), (expected - observed).mean(axis=1) + ridge * moves)
            for x, total, slope in zip((weights, bias, moves), seen, slopes):
                total += slope ** 2
                x -= rate * slope / np.sqrt(total)
            weights[none] = 0
    return {f: float(weights[i]) for f, i in index.items() if abs(weights[i]) > 0.01}, float(bias[0]), moves


class Tagger:
    """Scores words with a model; the score of each distinct word is kept until the cache is full."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def _score(self, word):
        return self.model.bias + sum(self.model.weights.get(f, 0.0) for f in features(word))

    def marginals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Per text the probability of each word to be toxic."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        for words in texts:
            for w in set(words).difference(known):
                known[w] = self._score(w)
        ends = np.cumsum([len(t) for t in texts])
        flat = np.array([known[w] for words in texts for w in words], dtype=float)
        if not len(flat):
            return [flat for _ in texts]
        rows, place, nth = _windows(flat, ends, _OUT)
        real = np.zeros(rows.size, dtype=bool)
        real[place] = True
        real = real.reshape(rows.shape)
        start, end = carried(rows, self.model.moves, real, nth)
        found = forward_backward(rows, self.model.moves, start, end, real)[0].ravel()[place]
        return np.split(found, ends[:-1])


def top_two(marginals: np.ndarray) -> tuple[float, float]:
    """Log-odds of the two highest marginals."""
    p = np.clip(np.sort(np.append(marginals, (0, 0)))[-2:], FLOOR, 1 - FLOOR)
    low, high = np.log(p) - np.log1p(-p)
    return float(high), float(low)


def fit_curve(tops: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression of the label on the two log-odds, with a ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(tops)), tops / 10])
    w, ridge = np.zeros(3), np.diag([0.01, 0.1, 0.1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.array([w[0], max(w[1], 0) / 10, max(w[2], 0) / 10])


def train(texts: list[str], toxic: list[int]) -> Model | None:
    """A model from labelled texts, or None without both labels."""
    label = np.array(toxic, dtype=bool)
    if not label.any() or label.all():
        return None
    known = {}
    words = [[known.setdefault(w, w) for w in _WORDS.findall(t)] for t in texts]
    # Near copies share their longest line; one of them is enough to find marks.
    first = {}
    for i, t in enumerate(texts):
        first.setdefault((label[i], max(t.split("\n"), key=len)), i)
    own = sorted(first.values())
    chosen = toxic_marks([words[i] for i in own], label[own])
    is_marked = {w: not chosen.isdisjoint(marks(w)) for w in {w for ws in words for w in ws}}
    labels = [np.array([is_marked[w] for w in ws], dtype=bool) & t for ws, t in zip(words, label)]
    weights, bias, moves = train_chain(words, labels)
    model = Model(weights, bias, moves, np.zeros(3))
    tops = np.array([top_two(m) for m in Tagger(model).marginals(words)])
    return model._replace(curve=fit_curve(tops, label.astype(float)))


def labelled_sample(docs: DataFrame, labels: DataFrame, training: Column, bounds: Sample) -> DataFrame:
    """(text, toxic) for at most ``bounds`` labelled documents, those with the smallest hash of doc_id."""
    marked = (labels.filter(training & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .withColumn("place", F.xxhash64("doc_id")))
    ids = [marked.filter(F.col("toxic") == value).orderBy("place", "doc_id").limit(n)
           for value, n in ((1, bounds.toxic), (0, bounds.clean))]
    ids = broadcast_below(ids[0].unionByName(ids[1]).select("doc_id", "toxic", "place"))
    return (docs.select("doc_id", "text").filter(F.length("text") <= bounds.max_chars).join(ids, "doc_id")
            .orderBy("place", "doc_id", "text").limit(bounds.toxic + bounds.clean).select("text", "toxic"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document (doc_id, text): doc_id, score, predicted, and the offending spans as start and end."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double, predicted int, spans array<struct<`start`: int, `end`: int>>"
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def spans(text, marginals):
        found = []
        for m, p in zip(_WORDS.finditer(text), marginals >= 0.5):
            if p and found and found[-1]["joined"]:
                found[-1]["end"] = m.end()
            elif p:
                found.append({"start": m.start(), "end": m.end(), "joined": True})
            elif found:
                found[-1]["joined"] = False
        return [{"start": s["start"], "end": s["end"]} for s in found]

    def run(batches):
        tagger = shared.value and Tagger(shared.value)
        for batch in batches:
            for offset in range(0, batch.num_rows, 128):
                part = batch.slice(offset, 128)
                texts = [t or "" for t in part.column("text").to_pylist()]
                if tagger is None:
                    scores, found = [0.0] * len(texts), [[]] * len(texts)
                else:
                    marginals = tagger.marginals([_WORDS.findall(t) for t in texts])
                    curve = tagger.model.curve
                    scores = [float(1 / (1 + np.exp(-np.clip(curve[0] + curve[1:] @ top_two(m), -50, 50)))) for m in marginals]
                    found = [spans(t, m) if len(m) and m.max() >= 0.5 else [] for t, m in zip(texts, marginals)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64()),
                     pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(found, span)],
                    names=["doc_id", "score", "predicted", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, bounds: Sample = Sample()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, spans (start:end, comma-joined)."""
    rows = labelled_sample(docs, labels, ~held_out(F.col("doc_id")), bounds).collect()
    model = train([r["text"] for r in rows], [r["toxic"] for r in rows])
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                                     shown.alias("spans"))
