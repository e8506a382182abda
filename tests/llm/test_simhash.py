import random

import pytest
import xxhash

from plateful.llm import simhash
from tests.llm.cases import SCHEMA, WORDS, clashing, documents, frame


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lowered)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " ", "One", "One two", "a b c d", "É Ab\x0bC\x00d É", "x " * 500])
def test_fingerprint_matches_plain(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_close_pairs_meet_at_a_home(blocks):
    draw = random.Random(blocks)
    for _ in range(150):
        u = draw.getrandbits(64)
        v = u
        for bit in draw.sample(range(64), draw.randint(0, simhash.MAX_BITS)):
            v ^= 1 << bit
        home, _ = simhash.anchors(u, blocks)
        assert home in set(simhash.anchors(v, blocks)[1].tolist())


def test_golay_and_hamming_codes_are_perfect():
    for code in (simhash.GOLAY, simhash.HAMMING):
        _, patterns = simhash._excess_patterns(*code)
        assert all(len(levels[0]) == 1 for levels in patterns.values())


def plain_components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= simhash.MAX_BITS:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def test_links_and_components_match_brute_force(spark):
    draw, prints = random.Random(4), set()
    for _ in range(12):
        u = draw.getrandbits(64)
        for _ in range(draw.randint(1, 25)):      # chains of one or two flipped bits
            prints.add(u)
            for bit in draw.sample(range(64), draw.randint(1, 3)):
                u ^= 1 << bit
    prints |= {0, 1, 2 ** 63, 2 ** 64 - 1, 2 ** 64 - 2}
    signed = {p: p - 2 ** 64 if p >> 63 else p for p in prints}
    nodes = spark.createDataFrame([(s,) for s in signed.values()], "fingerprint long").repartition(4)
    near = {(min(signed[a], signed[b]), max(signed[a], signed[b])) for a in prints for b in prints
            if a != b and (a ^ b).bit_count() <= simhash.MAX_BITS}
    assert {tuple(r) for r in simhash.links(nodes).collect()} == near
    assert simhash.links(nodes).count() == len(near)
    roots = {r["fingerprint"]: r["root"] for r in simhash.classes(nodes).collect()}
    expected = plain_components(sorted(prints))
    same = {}
    for p, s in signed.items():
        assert same.setdefault(expected[p], roots[s]) == roots[s]
    assert len(set(same.values())) == len(same)


def test_long_chain_has_one_component(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long").repartition(5)
    found = {tuple(r) for r in simhash.components(edges).collect()}
    assert found == {(i, 0) for i in range(1, n + 1)}


def test_hubs_have_one_component_each(spark):
    """Two hubs with very many neighbours, one the smallest and one the largest node of its component, and a bridge."""
    edges = [(0, i) for i in range(1, 700)] + [(i, 5000) for i in range(1000, 1900)] + [(2000, 2001)]
    found = {tuple(r) for r in simhash.components(frame(spark, edges, "a long, b long")).collect()}
    assert found == ({(i, 0) for i in range(1, 700)} | {(i, 1000) for i in [*range(1001, 1900), 5000]} | {(2001, 2000)})
    joined = simhash.components(frame(spark, edges + [(699, 1000)], "a long, b long")).collect()
    assert {r["root"] for r in joined if r["node"] != 2001} == {0}


def test_whole_rows_are_shuffled_once_and_repeated_rows_are_cut(spark):
    docs = [(1, "a b c d", "en", f"s{i}", i) for i in range(400)] + [(2, "a b c d", "en", "s", 0)] * 300 + [(7, "x y z w", "en", "s", 1)] * 3
    docs += [(30 + i, f"text number {i} of some more words", "en", "s", 0) for i in range(5)] + [(None, "q r s t", None, None, None)] * 2
    rows = frame(spark, docs)
    kept = simhash.one_per_component(rows)
    report = simhash.near_duplicates(rows).collect()
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(c) for c in {r["component_id"] for r in report})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "_row" not in "".join(line for line in plan.splitlines() if "BroadcastExchange" in line)


def test_report_on_awkward_rows(spark):
    found = simhash.near_duplicates(frame(spark)).collect()
    assert len(found) == len(documents())
    by_print = {}
    for d in documents():
        by_print.setdefault(plain_fingerprint(d[1]), []).append(d[0])
    expected = plain_components(sorted(by_print))
    groups = {}
    for p, ids in by_print.items():
        groups.setdefault(expected[p], []).extend(i for i in ids if i is not None)
    least = {p: min(groups[expected[p]], default=None) for p in by_print}
    for r in found:
        assert r["component_id"] == least[int(r["fingerprint"], 16)]
    texts = {d[0]: d[1] for d in documents() if d[0] is not None}
    assert all(r["fingerprint"] == f"{plain_fingerprint(texts[r['doc_id']]):016x}" for r in found if r["doc_id"] is not None)


def test_one_row_of_each_component_stays(spark):
    docs = clashing(frame(spark), "fingerprint", "root", "_id", "_row", "best")
    kept = simhash.one_per_component(docs)
    report = simhash.near_duplicates(frame(spark)).collect()
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(c) for c in {r["component_id"] for r in report})
    assert simhash.one_per_component(docs.limit(0)).count() == 0


def test_only_null_ids_and_empty_table(spark):
    docs = frame(spark, [(None, "a b c", None, None, None), (None, "a b c", None, None, None), (None, "x y z", None, None, None)])
    assert [r["component_id"] for r in simhash.near_duplicates(docs).collect()] == [None] * 3
    assert simhash.one_per_component(docs).count() == 2
    assert simhash.near_duplicates(frame(spark, [], SCHEMA)).count() == 0
