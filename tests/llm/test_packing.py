import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from plateful.llm import fitting, packing
from tests.llm.cases import SCHEMA, clashing, documents, frame, prose

TEXTS = ["A <|endoftext|> b", "café naïve “Q” — ½ x² Σς İ", "don't WE'LL 'sx _a__b 12.5\x0b\x0c", "", "\x00\x1c a b", "é",
         "K Å ẞ é ª µ a\x85b\xa0c", "a b", "日本語 テスト", "😀 x", None, "  lead trail  ",
         "ÉCOLE Über ÑANDÚ", "x<|y", "!!'s ?'re", prose(1, 300)]


@pytest.fixture(scope="module")
def tokenizer():
    return packing.UnitTokenizer(packing.vocabulary_path())


def whole_ids(tokenizer, text):
    return tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("start", [0, 3, 12])
def test_ids_equal_those_of_whole_texts(tokenizer, start):
    ids, bounds = tokenizer.encode(pa.array(TEXTS).slice(start))
    for text, a, b in zip(TEXTS[start:], bounds, bounds[1:]):
        assert ids[a:b].tolist() == whole_ids(tokenizer, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x2100)), max_size=4))
def test_ids_of_any_text(tokenizer, texts):
    ids, bounds = tokenizer.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole_ids(tokenizer, t) for t in texts]


def test_cache_may_be_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_UNITS", 3)
    for text in TEXTS:
        ids, _ = tokenizer.encode(pa.array([text], pa.string()))
        assert ids.tolist() == whole_ids(tokenizer, text)


def test_least_squares_is_optimal():
    draw = np.random.default_rng(0)
    for rows, columns in ((5, 12), (20, 60), (30, 10)):
        a, b = draw.random((rows, columns)), draw.random(rows) * 5
        x = fitting.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-5 and np.abs(slope[x > 0]).max(initial=0) < 1e-5


@pytest.mark.parametrize("counts", [{}, {1: 1}, {64: 3}, {63: 5, 1: 2}, {33: 7}, {5: 1000}, {64: 1, 32: 2, 1: 1},
                                    {n: n % 5 for n in range(1, 65)}])
def test_plan_holds_every_piece_once(counts):
    plan = packing.pack_plan(counts, 64, 16)
    held = Counter()
    for lengths, n in plan:
        assert 0 < sum(lengths) <= 64 and n > 0
        for length in lengths:
            held[length] += n
    assert held == +Counter(counts)


def test_plan_is_close_to_the_bound():
    draw = np.random.default_rng(2)
    counts = Counter(np.clip(draw.lognormal(6, 1, 20_000).astype(int) + 1, 1, 4096).tolist())
    n = sum(k for _, k in packing.pack_plan(counts))
    assert n <= 1.003 * sum(k * v for k, v in counts.items()) / 4096 + 1


@pytest.mark.parametrize("n", [20_000, 2_000_000])
def test_fitted_patterns_carry_the_packing(n):
    """Patterns hold nine tenths of the tokens, all full, and the whole stays within a thousandth of the bound."""
    draw = np.random.default_rng(3)
    lengths = np.maximum(draw.lognormal(6.6, 1.0, n).astype(int), 1)
    counts = Counter(((lengths - 1) % 4096 + 1).tolist())
    counts[4096] += int(((lengths - 1) // 4096).sum())
    plan = fitting.plan_windows(counts, 4096, packing.rounds(packing.BINS))
    assert plan.share_fitted() >= 0.9 and all(sum(x) == 4096 for x, _ in plan.fitted)
    assert sum(k for part in plan for _, k in part) <= 1.001 * int(lengths.sum()) / 4096 + 1


def test_report_against_plain_tokenization(spark, tokenizer):
    report = packing.pack_documents(frame(spark)).toPandas()
    expected = Counter()
    for doc_id, text, *_ in documents():
        ids = np.array([*whole_ids(tokenizer, text), packing.END], "<u4")
        for n, a in enumerate(range(0, len(ids), 4096)):
            cut = ids[a:a + 4096]
            expected[(doc_id, n, a, len(cut), zlib.crc32(cut.tobytes()))] += 1
    found = Counter((None if d != d else int(d), p, s, n, c) for d, p, s, n, c in
                    report[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
    assert found == expected
    for _, g in report.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
    assert report.sequence_id.nunique() <= -(-report.length.sum() // 4096) + 1


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = clashing(frame(spark), "length", "offset", "sequence_id")
    sequences = packing.packed_sequences(docs).collect()
    assert sum(len(s["ids"]) for s in sequences) == sum(len(whole_ids(tokenizer, d[1])) + 1 for d in documents())
    assert all(s["ids"].count(packing.END) <= len(s["doc_ids"]) for s in sequences)


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, [], SCHEMA)).count() == 0
