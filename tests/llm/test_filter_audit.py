import random
import re
from itertools import permutations

import pytest

from plateful.llm import filter_audit
from tests.llm.cases import SCHEMA, WORDS, clashing, documents, frame, prose, rows

LABELS = "doc_id long, quality int, toxic int"


def fails_of(docs):
    found = []
    for doc_id, text, *_ in docs:
        text = text or ""
        words = WORDS.findall(text)
        copy = doc_id is not None and any(d[0] is not None and d[0] < doc_id and (d[1] or "") == text for d in docs)
        found.append({"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                      "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                      "D": bool(re.search("[#$%&*|]", text)), "E": copy})
    return found


def audit(parts, fails, good, toxic, filters):
    """Every filter order, walked through document by document."""
    found = []
    for part in set(parts):
        own = [i for i, p in enumerate(parts) if p == part]
        shapley, result = dict.fromkeys(filters, 0), []
        for order in permutations(filters):
            left = own
            for step, f in enumerate(order, 1):
                removed = [i for i in left if fails[i][f]]
                failing = sum(fails[i][f] for i in own)
                left = [i for i in left if not fails[i][f]]
                shapley[f] += len(removed)
                result.append((f, ("".join(order), step, len(left), len(removed), failing - len(removed),
                                   sum(fails[i][f] and sum(fails[i].values()) == 1 for i in own),
                                   sum(good[i] for i in removed), sum(toxic[i] for i in removed))))
        found += [(part, *row, shapley[f]) for f, row in result]
    return sorted(found, key=str)


def test_report_equals_a_plain_walk(spark):
    draw = random.Random(4)
    docs = documents() + [(300 + i, draw.choice(["ABC #", "A plain text", prose(3, 120), "", None, "a " * 150]),
                           draw.choice(["en", "de", "", None]), "s", 0) for i in range(60)]
    labels = [(d[0], draw.choice([0, 1, None]), draw.choice([0, 1, None])) for d in docs if draw.random() < 0.6]
    labels += labels[:20] + [(None, 1, 1), (9999, 1, 1)]
    good, toxic = ({d for d, *mark in labels if mark[k] == 1 and d is not None} for k in (0, 1))
    found = filter_audit.audit_report(clashing(frame(spark, docs), "part", "id", "bit", "words", "E", "n"),
                                      clashing(frame(spark, labels, LABELS), "good", "id"))
    assert rows(found) == audit([d[2] or "" for d in docs], fails_of(docs), [d[0] in good for d in docs],
                                [d[0] in toxic for d in docs], "ABCDE")


@pytest.mark.parametrize("n", [1, 2, 3])
def test_any_filters(spark, n):
    draw, filters = random.Random(n), "XYZ"[:n]
    made = [(i, draw.choice(["a", "b"]), draw.random() < 0.5, draw.random() < 0.2, *[draw.random() < 0.4 for _ in filters])
            for i in range(200)]
    schema = "id long, part string, good boolean, toxic boolean, " + ", ".join(f"{f} boolean" for f in filters)
    found = filter_audit.interactions(frame(spark, made, schema), [*filters])
    assert rows(found) == audit([m[1] for m in made], [dict(zip(filters, m[4:])) for m in made],
                                [m[2] for m in made], [m[3] for m in made], filters)


def test_hot_texts_and_ids(spark, monkeypatch):
    """A third of the rows share a text and another third a doc_id: same result, and no such key is shuffled."""
    monkeypatch.setattr(filter_audit, "HOT_ROWS", 20)
    docs = [(i, "one text", "en", "s", 0) for i in range(100)] + [(500, f"text {i}", "en", "s", 0) for i in range(100)]
    docs += [(1000 + i, f"text {i}", "en", "s", 0) for i in range(100)] + [(None, "one text", "en", "s", 0)]
    labels = [(500, 1, 0), (3, 0, 1)]
    found = filter_audit.audit_report(frame(spark, docs), frame(spark, labels, LABELS))
    assert rows(found) == audit([d[2] for d in docs], fails_of(docs), [d[0] == 500 for d in docs],
                                [d[0] == 3 for d in docs], "ABCDE")


def test_ids_are_shuffled_once_and_evenly(spark):
    """Prefixes are put in after the exchange; no join goes by part or filter."""
    made = frame(spark, [(i, "a", False, False, i % 2 == 0, i % 3 == 0) for i in range(60)],
                 "id long, part string, good boolean, toxic boolean, X boolean, Y boolean")
    counts = filter_audit.prefix_counts(filter_audit.failing_ids(made, ["X", "Y"]))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning(id") + plan.count("Exchange hashpartitioning(_id") <= 4
    assert "prefix" not in "".join(line for line in plan.splitlines() if "hashpartitioning(id" in line or "hashpartitioning(_id" in line)


def test_very_long_text(spark):
    docs = [(1, prose(3, 150_000), "en", "s", 0), (2, prose(3, 150_000), "en", "s", 0), (3, "x " * 99, "en", "s", 0)]
    found = filter_audit.audit_report(frame(spark, docs), frame(spark, [], LABELS))
    assert rows(found) == audit(["en"] * 3, fails_of(docs), [False] * 3, [False] * 3, "ABCDE")


def test_empty_tables(spark):
    assert filter_audit.audit_report(frame(spark, [], SCHEMA), frame(spark, [], LABELS)).count() == 0
    assert filter_audit.audit_report(frame(spark), frame(spark, [], LABELS)).filter("good_lost + toxic_lost > 0").count() == 0
