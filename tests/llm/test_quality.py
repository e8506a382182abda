import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from plateful.llm import quality
from tests.llm.cases import WORDS, clashing, documents, frame, prose


def plain_measures(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


@pytest.mark.parametrize("text", [None, "", " \n ", "a", "a b c", "a b c a b c", "a a a a a", "x #1 <b>\nx #1 <b>\n\n \nx",
                                  "a b c d\na b c d", prose(3, 200), "é 日本 | & é 日本 | & ç"])
def test_measures_match_plain_counts(text):
    assert quality.measure(text)[:5] == plain_measures(text)


def test_repeats_with_many_distinct_words_match(monkeypatch):
    words = [f"w{i % 700}" for i in range(1500)]
    expected = plain_measures(" ".join(words))[4]
    assert quality._repeated(words, {w: 2 ** 20 + i for i, w in enumerate(dict.fromkeys(words))}) == expected


def test_fit_finds_bad_texts_without_labels():
    draw = np.random.default_rng(1)
    good = draw.random(4000) < 0.8
    right = draw.random((4000, 5)) < np.array([0.95, 0.9, 0.9, 0.8, 0.85])
    votes = np.where(right == good[:, None], 2, 1)
    votes[draw.random(votes.shape) < 0.3] = 0
    found = quality.fit(votes, np.ones(len(votes)))
    assert abs(found.share - 0.8) < 0.05
    assert ((found.quality(votes) >= 0.5) == good).mean() > 0.93
    assert found.accuracy()[0] > found.accuracy()[3]


def junk():
    shouted = [(500 + i, ("AAB!! " + prose(i, 90).upper().replace(" ", "!! ")), "en", "src0", 0) for i in range(8)]
    signs = [(520 + i, prose(70 + i, 90).replace(" ", "### "), "en", "src0", 0) for i in range(8)]
    return shouted + signs


def test_report_keeps_prose_and_drops_junk(spark):
    prosaic = [(1000 + i, "the and of to " + prose(200 + i, 120).replace(". ", ".\n"), "en", "s", 0) for i in range(150)]
    report = {r["doc_id"]: r for r in quality.quality_report(frame(spark, junk() + prosaic)).collect()}
    assert not any(report[d[0]]["kept"] for d in junk())
    assert sum(report[d[0]]["kept"] for d in prosaic) > 145


def plain_qualities(votes, rounds=quality.ROUNDS):
    """Expectation-maximisation text by text, in plain loops."""
    n_rules = len(votes[0])

    def rates(weights, priors):
        table = []
        for i in range(n_rules):
            seen = [priors[v] + sum(w for w, own in zip(weights, votes) if own[i] == v) for v in range(3)]
            table.append([x / sum(seen) for x in seen])
        return table

    share = quality.GOOD / (quality.GOOD + quality.BAD)
    on_good, on_bad = rates([0] * len(votes), quality.ON_GOOD), rates([0] * len(votes), quality.ON_BAD)

    def posterior():
        found = []
        for own in votes:
            good, bad = share, 1 - share
            for i, v in enumerate(own):
                good, bad = good * on_good[i][v], bad * on_bad[i][v]
            found.append(good / (good + bad))
        return found

    for _ in range(rounds):
        weights = posterior()
        share = (quality.GOOD + sum(weights)) / (quality.GOOD + quality.BAD + len(votes))
        before = on_good
        on_good, on_bad = rates(weights, quality.ON_GOOD), rates([1 - w for w in weights], quality.ON_BAD)
        if max(abs(a - b) for x, y in zip(before, on_good) for a, b in zip(x, y)) < 1e-12:
            break
    return posterior()


def test_kept_matches_a_plain_fit(spark):
    docs = [d for d in documents() if d[0] != 205] + junk() + [(1000 + i, "the and of to " + prose(200 + i, 120), "en", "s", 0) for i in range(40)]
    measured = quality.with_measures(frame(spark, docs).select("doc_id", "text")).toPandas()
    conditions = ", ".join(f"CASE WHEN n_words = 0 THEN 0 WHEN {r.bad} THEN 1 WHEN {r.good} THEN 2 ELSE 0 END" for r in quality.RULES)
    votes = duckdb.query(f"SELECT {conditions} FROM measured").fetchall()
    expected = sorted(zip(measured.n_words.tolist(), measured.word_chars.tolist(),
                          [q >= quality.MIN_QUALITY and w >= 50 and 100 * r <= 50 * w for q, w, r in
                           zip(plain_qualities(votes), measured.n_words, measured.n_repeat_words)]))
    report = quality.quality_report(frame(spark, docs)).collect()
    assert sorted((r["n_words"], r["word_chars"], r["kept"]) for r in report) == expected
    assert 5 < sum(k for *_, k in expected) < len(expected)


def test_learned_accuracies_are_shown(spark):
    shown = quality.rule_report(clashing(frame(spark, junk() * 5 + documents()), "rule", "accuracy")).collect()
    assert [r["rule"] for r in shown] == [r.name for r in quality.RULES]
    assert all(0 <= r["votes_good"] + r["votes_bad"] <= 1 and 0 < r["accuracy"] <= 1 for r in shown)
    assert quality.rule_report(frame(spark).limit(0)).count() == len(quality.RULES)


def test_awkward_rows(spark):
    found = quality.quality_report(frame(spark)).collect()
    assert len(found) == len(documents())
    expected = {d[0]: plain_measures(d[1]) for d in documents() if d[0] != 205}
    for r in found:
        if r["doc_id"] not in (205, None):
            assert tuple(r)[1:6] == expected[r["doc_id"]]
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_filter_keeps_columns_and_empty_tables(spark):
    docs = clashing(frame(spark), "n_words", "kept", "votes", "quality", "_row")
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns and kept.select("kept").distinct().collect()[0][0] == "kept"
    report = quality.quality_report(frame(spark)).filter("kept").count()
    assert kept.count() == report
    assert quality.good_documents(docs.limit(0)).count() == 0
    assert quality.quality_report(frame(spark).filter(F.lit(False))).count() == 0
