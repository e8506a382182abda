"""Quality filtering by weak supervision.

Rules vote that a text is good or bad, or abstain. No rule decides alone and none is trusted
beforehand: expectation-maximisation over the votes of all texts estimates how often each
rule is right about good and about bad texts, and how many texts are good. The posterior
probability of a text's votes is its quality.

Votes make at most 3**rules patterns, so the fit works on counts per pattern, whatever the
number of texts, and the posteriors are sent to all tasks as a table of that size.

Defined results: a NULL or empty text has no words, zero for every measure and fails the base
rule; a very long text is measured whole; rows that repeat are judged alike; an empty table gives an empty result; other columns
are kept whatever their names. A text in which no rule votes has the share of good texts
as its quality.
"""

import re
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from plateful.llm.shared import WORD, released
from plateful.plans.staging import checkpointed

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_QUALITY = 0.5
ROUNDS = 200
BATCH = 512
# Pseudo-counts before any text is seen: good texts are more frequent, and a rule's votes
# (abstain, bad, good) are right more often than wrong.
GOOD, BAD = 8.0, 2.0
ON_GOOD, ON_BAD = (4.0, 0.4, 5.6), (4.0, 4.0, 2.0)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_shouted", "n_plain", "n_function", "n_bangs"]

# Frequent function words of the corpus languages.
FUNCTION_WORDS = frozenset(
    "the and of to in that is for with from this le la les de des et que un une dans pour sur"
    " der die das und von zu mit den ist für auf el los las y en por con para una del".split())

_WORDS = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    if not text:
        return (0,) * len(MEASURES)
    words = _WORDS.findall(text)
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    index = dict(zip(dict.fromkeys(words), count()))
    return (len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
            _repeated(words, index), len(lines), sum(map(str.isupper, words)), sum(map(str.isalpha, words)),
            len(FUNCTION_WORDS & index.keys()), text.count("!"))


def _repeated(words, index):
    """Words that lie in a window of three words which the text has twice or more."""
    if len(words) < 4:
        return 0
    ids, size = np.fromiter(map(index.__getitem__, words), np.int64, len(words)), len(index)
    pairs = ids[:-1] * size + ids[1:]
    if size >= 2 ** 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.isin(windows, twice)
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(found)] |= found
    return int(covered.sum())


def with_measures(rows: DataFrame, inside: str | None = None) -> DataFrame:
    """``rows`` (..., text) with ``MEASURES`` in place of the text; or beside the struct ``inside`` that holds it."""
    kept = [c for c in rows.columns if c != "text"]
    schema = ", ".join([*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept],
                        *[f"{m} long" for m in MEASURES]])

    def run(batches):
        for whole in released(batches):
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                texts = pc.struct_field(batch.column(inside), "text") if inside else batch.column("text")
                found = np.array([*map(measure, texts.to_pylist())], np.int64).reshape(-1, len(MEASURES))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *map(pa.array, found.T.copy())],
                                                 names=[*kept, *MEASURES])

    return rows.mapInArrow(run, schema)


class Rule(NamedTuple):
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


RULES = [
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols < 0.03 * n_words"),
    Rule("shouting", "n_shouted > 0.4 * n_words", "n_shouted < 0.1 * n_words"),
    Rule("exclamation", "n_bangs > 0.2 * n_words", "n_bangs < 0.02 * n_words"),
    Rule("repetition", "n_repeat_words > 0.3 * n_words", "n_repeat_words < 0.1 * n_words"),
    Rule("lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words",
         "word_chars BETWEEN 4 * n_words AND 9 * n_words"),
    Rule("plain_words", "n_plain < 0.4 * n_words", "n_plain > 0.65 * n_words"),
    Rule("function_words", "n_function = 0 AND n_words >= 20", "n_function >= 3"),
]


def pattern(rules: list[Rule] = RULES) -> Column:
    """The votes of all rules as one number in base 3: 0 abstains, 1 bad, 2 good."""
    votes = [f"CASE WHEN n_words = 0 THEN 0 WHEN {r.bad} THEN 1 WHEN {r.good} THEN 2 ELSE 0 END * {3 ** i}"
             for i, r in enumerate(rules)]
    return F.expr(" + ".join(votes)).cast("long")


def _unpacked(patterns: np.ndarray, n_rules: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n_rules) % 3


class Fit(NamedTuple):
    """Share of good texts, and per rule and vote (abstain, bad, good) its frequency on good and on bad texts."""

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def quality(self, votes: np.ndarray) -> np.ndarray:
        rules = np.arange(votes.shape[1])
        odds = (np.log(self.share) - np.log1p(-self.share)
                + (np.log(self.on_good) - np.log(self.on_bad))[rules, votes].sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Per rule how often its vote, where it gives one, is right."""
        good, bad = self.share * self.on_good, (1 - self.share) * self.on_bad
        return (good[:, 2] + bad[:, 1]) / (good[:, 1:] + bad[:, 1:]).sum(axis=1)


def fit(votes: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> Fit:
    """Expectation-maximisation over vote patterns that ``n`` texts have each.

    Abstaining counts as a choice too, because most rules know one kind of fault and say
    nothing about others: a text with one clear fault is not saved by rules that look elsewhere.
    """
    rules, kinds = votes.shape[1], np.eye(3)[votes]

    def rates(weight, prior):
        seen = np.einsum("p,prv->rv", weight, kinds) + prior
        return seen / seen.sum(axis=1, keepdims=True)

    found = Fit(GOOD / (GOOD + BAD), rates(0 * n, np.array(ON_GOOD)), rates(0 * n, np.array(ON_BAD)))
    for _ in range(rounds):
        good = n * found.quality(votes)
        newer = Fit((GOOD + good.sum()) / (GOOD + BAD + n.sum()), rates(good, np.array(ON_GOOD)),
                    rates(n - good, np.array(ON_BAD)))
        moved = max(np.abs(newer.on_good - found.on_good).max(), np.abs(newer.on_bad - found.on_bad).max())
        found = newer
        if moved < 1e-9:
            break
    return found


def qualities(measured: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(votes, quality) for each pattern of votes in ``measured``."""
    counted = (measured.groupBy(pattern(rules).alias("votes")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy("votes").collect())
    spark = measured.sparkSession
    if not counted:
        return spark.createDataFrame([], "votes long, quality double")
    patterns, n = np.array([r["votes"] for r in counted]), np.array([r["n"] for r in counted], dtype=float)
    votes = _unpacked(patterns, len(rules))
    return spark.createDataFrame([*zip(patterns.tolist(), fit(votes, n).quality(votes).tolist())],
                                 "votes long, quality double")


def rule_report(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule what was learned about it: how often it votes good and bad, and how often its votes are right."""
    counted = (with_measures(docs.select("text")).groupBy(pattern(rules).alias("votes")).agg(F.count(F.lit(1)).alias("n")).collect())
    votes = _unpacked(np.array([r["votes"] for r in counted], dtype=np.int64), len(rules))
    n = np.array([r["n"] for r in counted], dtype=float)
    total, right = max(float(n.sum()), 1.0), fit(votes, n).accuracy()
    found = [(r.name, float(n[votes[:, i] == 2].sum() / total), float(n[votes[:, i] == 1].sum() / total), float(right[i]))
             for i, r in enumerate(rules)]
    return docs.sparkSession.createDataFrame(found, "rule string, votes_good double, votes_bad double, accuracy double")


def judged(measured: DataFrame, found: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``measured`` with base_failed, quality and kept."""
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (measured.withColumn("votes", pattern(rules)).join(F.broadcast(found), "votes")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("quality") >= MIN_QUALITY)))


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, the base measures, base_failed, kept, quality."""
    measured = checkpointed(with_measures(docs.select("doc_id", "text")))
    return judged(measured, qualities(measured)).select("doc_id", *MEASURES[:5], "base_failed", "kept", "quality")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Texts are measured twice rather than stored."""
    found = qualities(with_measures(docs.select("text")))
    rows = docs.select(F.struct("*").alias("_row"))
    return judged(with_measures(rows, inside="_row"), found).filter("kept").select("_row.*")
