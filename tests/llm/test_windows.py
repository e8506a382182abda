import zlib
from collections import Counter

import numpy as np
import pytest

from plateful.llm import fitting, packing, windows
from tests.llm.cases import SCHEMA, clashing, documents, frame, prose


def held_by(plan):
    found = Counter()
    for lengths, n in (*plan.fitted, *plan.greedy):
        for length in lengths:
            found[length] += n
    return found


def padding(lengths, window):
    total = sum(lengths)
    return 0 if total & (total - 1) == 0 else window - total


def test_combinations_are_all_of_them():
    def plain(total, depth, most):
        if total == 0:
            return {()}
        if depth == 0:
            return set()
        return {(x, *rest) for x in range(min(total, most), 0, -1) for rest in plain(total - x, depth - 1, x)}

    for total, depth in ((1, 1), (6, 3), (10, 4), (12, 12)):
        expected = plain(total, depth, total)
        found = fitting.combinations(total, depth, [*range(1, total + 1)])
        assert sorted(found) == sorted(expected)
        odd = [x for x in range(1, total + 1) if x % 2]
        assert sorted(fitting.combinations(total, depth, odd)) == sorted(c for c in expected if all(x % 2 for x in c))


@pytest.mark.parametrize("counts", [{}, {1: 1}, {64: 3}, {63: 5, 1: 2}, {33: 7}, {5: 1000}, {64: 1, 32: 2, 1: 1},
                                    {n: n % 5 for n in range(1, 65)}, {32: 101}, {16: 3, 24: 3}])
def test_plan_holds_every_piece_once(counts):
    plan = fitting.plan_windows(counts, 64, ((16, 4), (8, 6)))
    assert held_by(plan) == +Counter(counts)
    assert all(sum(lengths) == 64 and n > 0 for lengths, n in plan.fitted)
    assert all(0 < sum(lengths) <= 64 and n > 0 for lengths, n in plan.greedy)


def test_random_plans_hold_every_piece_once():
    draw = np.random.default_rng(7)
    for window in (1, 2, 7, 64, 100):
        for _ in range(20):
            counts = Counter(draw.integers(1, window + 1, draw.integers(1, 300)).tolist())
            plan = fitting.plan_windows(counts, window, ((8, 3), (5, 5)))
            assert held_by(plan) == counts
            assert all(sum(lengths) == window for lengths, _ in plan.fitted)
            assert all(sum(lengths) <= window for lengths, _ in plan.greedy)


@pytest.mark.parametrize("n", [5_000, 50_000, 5_000_000])
def test_fit_fills_most_windows_and_little_is_padded(n):
    """The fitted combinations carry the packing, at every size; greedy packing only sees the residuals."""
    draw = np.random.default_rng(2)
    counts = Counter(np.clip(draw.lognormal(6.5, 1, n).astype(int) + 1, 1, 4096).tolist())
    plan = fitting.plan_windows(counts, 4096, windows.ROUNDS)
    total = sum(k * v for k, v in counts.items())
    assert held_by(plan) == counts
    assert plan.share_fitted() > 0.8
    assert sum(padding(lengths, 4096) * k for lengths, k in plan.greedy) <= 0.001 * total + 4096


def test_places_are_disjoint():
    plan = fitting.plan_windows({5: 30, 7: 20, 40: 6, 64: 2}, 64, ((16, 4),))
    seen = Counter()
    for length, (first, start, each, from_, offsets) in windows.places(plan).items():
        for rank in range({5: 30, 7: 20, 40: 6, 64: 2}[length]):
            run = np.searchsorted(first, rank, side="right") - 1
            window, nth = divmod(rank - first[run], each[run])
            at = offsets[from_[run] + nth]
            seen.update((start[run] + window, at + i) for i in range(length))
    assert max(seen.values()) == 1
    for window in {w for w, _ in seen}:
        own = [at for w, at in seen if w == window]
        assert sorted(own) == [*range(len(own))]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, windows.END]


def test_report_against_plain_tokenization(spark, tokenizer):
    docs = documents() + [(400 + i, prose(i, 40), "en", "s", 0) for i in range(30)]
    report = windows.window_documents(clashing(frame(spark, docs), "length", "sequence_id", "start", "_rank")).toPandas()
    assert report.columns.tolist() == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    expected = Counter()
    for doc_id, text, *_ in docs:
        ids = np.array(ids_of(tokenizer, text), "<u4")
        for start in range(0, len(ids), 4096):
            cut = ids[start:start + 4096]
            expected[(doc_id, start, len(cut), zlib.crc32(cut.tobytes()), len(ids))] += 1
    found = Counter((None if d != d else int(d), *map(int, rest)) for d, *rest in
                    report[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False))
    assert found == expected
    padded = 0
    for _, g in report.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
        padded += padding(g.length.tolist(), 4096)
    assert padded <= 2 * 4096


def test_hot_length_and_repeated_rows(spark):
    docs = [(1, "same words here", "en", "s", 0)] * 900 + [(2, prose(1, 900), "en", "s", 0)] * 40
    report = windows.window_documents(frame(spark, docs)).toPandas()
    own = {(w, at + i) for w, at, n in zip(report.sequence_id, report.offset, report.length) for i in range(n)}
    assert len(report) >= 940 and len(own) == report.length.sum()


def test_windows_hold_the_ids(spark, tokenizer):
    found = windows.window_sequences(clashing(frame(spark), "ids", "parts")).collect()
    assert sorted(i for s in found for i in s["ids"]) == sorted(i for d in documents() for i in ids_of(tokenizer, d[1]))
    assert all(0 < len(s["ids"]) <= 4096 for s in found)


def test_very_long_text_is_tokenized_whole(spark, tokenizer):
    text = prose(8, 400_000)
    report = windows.window_documents(frame(spark, [(1, text, "en", "s", 0)])).toPandas()
    assert report.length.sum() == len(ids_of(tokenizer, text)) == report.doc_tokens[0]


def test_empty_table(spark):
    assert windows.window_documents(frame(spark, [], SCHEMA)).count() == 0
