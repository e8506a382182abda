"""Near-duplicate detection by SimHash fingerprints and anchor points.

Links are fingerprints at ``MAX_BITS`` or fewer differing bits. The anchors are the words of a
covering code: the product of perfect Golay codes over blocks of 23 bits, so every block lies
within the covering radius 3 of exactly one anchor block. A fingerprint is at home at the anchor
within that radius, and is sent to every anchor within radius plus threshold as a visitor. Two
linked fingerprints then meet at the home of either. The threshold is shared by all blocks:
a visitor's excess distances over the radius may add up to ``MAX_BITS``, because the
differing bits of a pair do. Only meetings at one anchor are compared.

Two blocks give 2**24 anchors and about 61 visits a fingerprint. Homes per anchor, and so comparisons per
fingerprint, grow with the table; ``blocks`` can be lowered for small tables, and a third
block of 15 bits (perfect Hamming code, radius 1) gives 2**35 anchors and 154 visits.
All choices find the same links.

Defined results: a NULL or empty text has fingerprint zero and links like any other; all shingles of a very long text
count; equal
fingerprints are one node, so a group of copies of any size costs one row; rows with a NULL
doc_id keep it and count only where a component has no other; an empty table gives an
empty result; other columns are kept whatever their names.
"""

import itertools
import re
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plateful.llm.shared import WORD, hot_limit, released, split_join
from plateful.plans.staging import checkpointed

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BATCH = 512

# Generator polynomials of the binary Golay code of 23 bits and the Hamming code of 15 bits.
GOLAY = (23, 0b101011100011, 3)
HAMMING = (15, 0b10011, 1)
BLOCKS = {1: [GOLAY], 2: [GOLAY, GOLAY], 3: [GOLAY, GOLAY, HAMMING]}


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text as an unsigned number."""
    lowered = (text or "").encode().translate(_LOWER)
    spans = [m.span() for m in _WORDS.finditer(lowered)]
    if not spans:
        return 0
    joined = b" ".join([lowered[a:b] for a, b in spans])
    ends = np.cumsum([b - a + 1 for a, b in spans]).tolist()
    starts = [0, *ends[:-1]]
    last = min(n, len(ends)) - 1
    hashes = [xxhash.xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[last:])]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * np.add.reduce(bits, axis=0, dtype=np.int32) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


_WORDS = re.compile(WORD.encode())
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def with_fingerprint(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``docs`` (..., text) with ``fingerprint`` (bigint) in place of ``text``."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept], "fingerprint long"])

    def run(batches):
        for whole in released(batches):
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                prints = np.array([fingerprint(t, n) for t in batch.column("text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(prints.view(np.int64))],
                                                 names=[*kept, "fingerprint"])

    return docs.mapInArrow(run, schema)


@cache
def _excess_patterns(width: int, polynomial: int, radius: int) -> tuple[np.ndarray, dict[int, list[np.ndarray]]]:
    """The syndrome of each bit, and for each syndrome the error patterns of weight up to radius (at 0), radius + 1, ..., radius + MAX_BITS.

    A word differs from an anchor block by exactly the patterns of its own syndrome.
    """
    check = polynomial.bit_length() - 1
    syndromes = np.zeros(width, dtype=np.int64)
    for i in range(width):
        rest = 1 << i
        for bit in range(i, check - 1, -1):
            if rest >> bit & 1:
                rest ^= polynomial << (bit - check)
        syndromes[i] = rest
    found = {s: [[] for _ in range(MAX_BITS + 1)] for s in range(1 << check)}
    for weight in range(radius + MAX_BITS + 1):
        for places in itertools.combinations(range(width), weight):
            s = int(np.bitwise_xor.reduce(syndromes[list(places)])) if places else 0
            found[s][max(0, weight - radius)].append(sum(1 << p for p in places))
    return syndromes, {s: [np.array(p, dtype=np.uint64) for p in levels] for s, levels in found.items()}


def anchors(word: int, blocks: int) -> tuple[int, np.ndarray]:
    """The home anchor of a fingerprint, and all anchors it visits."""
    visits = [(0, np.zeros(1, dtype=np.uint64))]
    home, shift = 0, 0
    for width, polynomial, radius in BLOCKS[blocks]:
        part = word >> shift & ((1 << width) - 1)
        syndromes, patterns = _excess_patterns(width, polynomial, radius)
        s = 0
        for i in range(width):
            if part >> i & 1:
                s ^= int(syndromes[i])
        at = [(np.uint64(part) ^ p) << np.uint64(shift) for p in patterns[s]]
        home |= int(at[0][0])
        visits = [(spent + more, (known[:, None] | at[more][None, :]).ravel())
                  for spent, known in visits for more in range(MAX_BITS + 1 - spent)]
        shift += width
    return home, np.concatenate([v for _, v in visits])


def visits(nodes: DataFrame, blocks: int = 2) -> DataFrame:
    """(anchor, fingerprint) for each distinct fingerprint in ``nodes`` and each anchor it visits."""
    def run(batches):
        for batch in batches:
            words = batch.column("fingerprint").to_numpy().view(np.uint64)
            for start in range(0, len(words), 1024):
                some = words[start:start + 1024]
                found = [anchors(int(w), blocks)[1] for w in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)),
                     pa.array(np.repeat(some, [len(f) for f in found]).view(np.int64))], names=["anchor", "fingerprint"])

    return nodes.select("fingerprint").mapInArrow(run, "anchor long, fingerprint long")


def homes(nodes: DataFrame, blocks: int = 2) -> DataFrame:
    """(anchor, fingerprint) with the home of each fingerprint."""
    def run(batches):
        for batch in batches:
            words = batch.column("fingerprint").to_numpy().view(np.uint64)
            at = np.array([anchors(int(w), blocks)[0] for w in words], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), batch.column("fingerprint")],
                                             names=["anchor", "fingerprint"])

    return nodes.select("fingerprint").mapInArrow(run, "anchor long, fingerprint long")


def links(nodes: DataFrame, blocks: int = 2) -> DataFrame:
    """(a, b) with a < b for all fingerprints of ``nodes`` at most ``MAX_BITS`` bits apart.

    A pair is found once, at the home of a. Far pairs are dropped inside the join, so at most
    2080 rows leave it per fingerprint.
    """
    near = F.bit_count(F.col("h.fingerprint").bitwiseXOR(F.col("v.fingerprint"))) <= MAX_BITS
    return (homes(nodes, blocks).alias("h").join(visits(nodes, blocks).alias("v"), (F.col("h.anchor") == F.col("v.anchor"))
                                                 & (F.col("h.fingerprint") < F.col("v.fingerprint")) & near)
            .select(F.col("h.fingerprint").alias("a"), F.col("v.fingerprint").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b) the smallest node it is connected to.

    Alternating large-star and small-star rounds until nothing changes. Minima are aggregated before
    they are shuffled, and the minima of hubs are sent to their edges, so no task gets all
    edges of one. Rounds grow with the logarithm of the longest chain, and each ends in a checkpoint.
    """
    edges, before = checkpointed(edges.select("a", "b")), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, limit = state, hot_limit(2 * state[0])
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = (both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
                 .select("a", F.least("a", "m").alias("m"), "n"))
        large = (split_join(both, least, "a", limit).filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = (split_join(large, low, "a", limit).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = checkpointed(small)


def classes(prints: DataFrame, blocks: int = 2) -> DataFrame:
    """(fingerprint, root) for each distinct fingerprint of ``prints``; root names its component."""
    nodes = checkpointed(prints.select("fingerprint").distinct())
    linked = components(links(nodes, blocks))
    return (nodes.join(linked, F.col("fingerprint") == F.col("node"), "left")
            .select("fingerprint", F.coalesce("root", "fingerprint").alias("root")))


def near_duplicates(docs: DataFrame, n: int = SHINGLE, blocks: int = 2) -> DataFrame:
    """Per document (doc_id, text): doc_id, fingerprint (16 hex digits), component_id (smallest doc_id)."""
    prints = checkpointed(with_fingerprint(docs.select("doc_id", "text"), n))
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    member = checkpointed(classes(prints, blocks).join(first, "fingerprint"))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    limit = hot_limit(prints.count())
    ids = checkpointed(split_join(member.select("fingerprint", "root", F.col("n").alias("n_rows")), named, "root", limit)
                       .select("fingerprint", "component_id", F.col("n_rows").alias("n")))
    return (split_join(prints, ids, "fingerprint", limit)
            .select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"))


def one_per_component(docs: DataFrame, n: int = SHINGLE, blocks: int = 2) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id of each component, with all its columns.

    Among rows with one doc_id the text with the smaller hash stays; a NULL doc_id is last. Whole rows are
    shuffled once, by doc_id and hash, which serves the choice and the cut of rows that repeat; rows
    that repeat very often are cut to one per task instead.
    """
    pair = {"_id": F.col("doc_id"), "_hash": F.xxhash64(F.coalesce("text", F.lit("")))}
    key = F.concat_ws("|", F.concat(F.lit("="), F.col("doc_id").cast("string")), pair["_hash"].cast("string"))
    prints = with_fingerprint(docs.select(*[c.alias(k) for k, c in pair.items()], key.alias("_key"), "text"), n)
    prints = checkpointed(prints.groupBy("_key").agg(
        *[F.first(c).alias(c) for c in ("_id", "_hash", "fingerprint")], F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct(F.isnull("_id").alias("none"), "_id", "_hash", "_key", "n"))
    firsts = prints.groupBy("fingerprint").agg(best.alias("best"))
    kept = checkpointed(classes(prints, blocks).join(firsts, "fingerprint").groupBy("root").agg(F.min("best").alias("best"))
                        .select("best._key", "best.n"))
    limit = hot_limit(prints.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"))
    hot = F.broadcast(prints.filter(F.col("n") > limit).select("_key"))
    hot_kept = F.broadcast(kept.filter(F.col("n") > limit).select("_key"))
    cold = rows.join(hot, "_key", "left_anti").join(kept.filter(F.col("n") <= limit), "_key", "left_semi")
    return (cold.groupBy("_key").agg(F.first("_row").alias("_row"))
            .unionByName(rows.join(hot_kept, "_key", "left_semi").groupBy("_key").agg(F.first("_row").alias("_row")))
            .select("_row.*"))
