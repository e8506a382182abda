import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plateful.llm import merkle
from plateful.plans.staging import folders, shared_folder
from tests.llm.cases import SCHEMA, clashing, documents, frame, prose, rows


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return H(*[framed(v) for v in (doc_id, source, lang, n_chars, text)])


def ascending(value):
    return (value is not None, value if value is not None else 0)


def levels_of(digests, width):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][i:i + width]) for i in range(0, len(found[-1]), width)])
    return found


def climbed(levels, place, leaf, width):
    """The siblings of a leaf, and the root that it folds to."""
    proof = []
    for level in levels[:-1]:
        start = place - place % width
        run = level[start:start + width]
        proof += run[:place - start] + run[place - start + 1:]
        leaf = H(*run[:place - start], leaf, *run[place - start + 1:])
        place //= width
    return proof, leaf


def manifest(docs, width=2):
    parts = defaultdict(list)
    for d in docs:
        parts[d[2]].append((ascending(d[0]), leaf_of(*d), d))
    languages = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in languages:
        parts[lang].sort(key=lambda x: x[:2])
        trees[lang] = levels_of([leaf for _, leaf, _ in parts[lang]], width)
    top = levels_of([trees[lang][-1][0] for lang in languages], width)
    found = []
    for nth, lang in enumerate(languages):
        for place, (_, leaf, (doc_id, text, lang, source, n_chars)) in enumerate(parts[lang]):
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            own = leaf_of(doc_id, text, lang, source, n_chars + 1) if changed else leaf
            proof, own = climbed(trees[lang], place, own, width)
            more, own = climbed(top, nth, own, width)
            root = top[-1][0]
            found.append((doc_id, leaf, trees[lang][-1][0], root, H(*proof, *more), own, own == root))
    return sorted(found, key=str)


@pytest.mark.parametrize("width", [2, 3, 5])
def test_manifest_equals_plain_trees(spark, width):
    docs = clashing(frame(spark), "part", "place", "digest", "root", "siblings", "_part")
    assert rows(merkle.manifest_report(docs, width)) == manifest(documents(), width)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 17, 33])
def test_any_number_of_leaves(spark, n):
    docs = [(i * 3, f"text {i}", "en", "s", i) for i in range(n)] + [(5, "x", None, None, None), (6, "", "", "", 0)] * (n % 2)
    assert rows(merkle.manifest_report(frame(spark, docs))) == manifest(docs)


def test_any_change_is_found(spark, tmp_path):
    """Every field of a leaf counts: whatever is changed, no proof of the old tree leads to the root."""
    found = merkle.proofs(frame(spark), str(tmp_path)).filter("doc_id = 7").first()
    assert found["root"].hex() == manifest(documents())[0][3]
    old = next(d for d in documents() if d[0] == 7)
    for i, value in enumerate([8, old[1] + " ", "de", None, 1]):
        new = [*old]
        new[i] = value
        leaf = merkle.folded(F.lit(leaf_of(*new)), F.lit(bytearray(found["path"])), F.lit(found["steps"]).cast("array<int>"))
        assert spark.range(1).select(leaf).first()[0] != found["root"].hex()
    same = merkle.folded(F.lit(leaf_of(*old)), F.lit(bytearray(found["path"])), F.lit(found["steps"]).cast("array<int>"))
    assert spark.range(1).select(same).first()[0] == found["root"].hex()


def test_fields_cannot_run_into_one_another(spark):
    docs = [(1, "b", "en", "a", 1), (1, "", "en", "ab", 1), (1, None, "en", "a1:b", 1)]
    assert len({r.leaf for r in merkle.manifest_report(frame(spark, docs)).collect()}) == 3


def test_very_long_text_largest_count_and_one_hot_language(spark):
    docs = [(1, prose(3, 200_000), "en", "s", 2**63 - 1), (2, "a", "en", "s", -1)] + [(14, "same", "en", "s", 4)] * 40
    assert rows(merkle.manifest_report(frame(spark, docs))) == manifest(docs)


def test_very_many_languages(spark, monkeypatch):
    """Beyond the number that may be broadcast, with one language that holds most rows."""
    monkeypatch.setattr(merkle, "FEW_PARTS", 10)
    docs = [(i, f"text {i}", f"l{i % 60:02}" if i % 3 == 0 else "en", "s", i) for i in range(400)] + [(9, "x", None, None, None)]
    assert rows(merkle.manifest_report(frame(spark, docs))) == manifest(docs)


def test_levels_are_removed(spark):
    def left():
        return [f for f in folders(spark, shared_folder(spark)) if f.startswith("merkle-")]

    assert merkle.manifest_report(frame(spark)).count() == len(documents()) and not left()


def test_empty_table(spark):
    found = merkle.manifest_report(frame(spark, [], SCHEMA))
    assert found.count() == 0 and found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
