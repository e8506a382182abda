"""Packing documents into sequences by non-negative least squares over length patterns.

Documents are tokenized and cut into pieces of at most ``CAPACITY`` tokens. Only the histogram
of piece lengths, at most ``CAPACITY`` numbers whatever the corpus, reaches the driver:

1. lengths are grouped into bins, and all patterns of a few bins that fill a sequence are enumerated;
2. non-negative least squares fits how often each pattern repeats to the counts per bin;
3. the repeats are rounded to what the counts allow, and exact lengths are dealt to them such that
   every sequence of a pattern is full (:mod:`plateful.llm.fitting`), in rounds over what is left;
4. the residual pieces go, longest first, to the smallest gap that holds them.

The plan says for each length which ranks go to which sequence and offset. Pieces get their rank
among those of their length from a sorted table, so one length may hold most of the rows.

Defined results: a NULL or empty text is the end token alone; a very long text is tokenized whole and cut; each row is packed on its own,
also where rows or doc_ids repeat; an empty table gives an empty result; other columns
are left out.
"""

import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plateful.llm.fitting import plan_windows
from plateful.llm.shared import released
from plateful.operators.keys import with_positions
from plateful.plans.staging import checkpointed

CAPACITY = 4096
BINS = 128
END = 1
VOCABULARY = "word_bpe_49k.json"
CACHED_UNITS = 300_000
BATCH = 512


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_signs() -> dict[int, str]:
    """For each character known here the signs by which a byte-level vocabulary writes its UTF-8 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    sign = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    known = [*range(33, 256), *range(0x2010, 0x2028)]
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in known}


BYTE_SIGNS = _byte_signs()


class UnitTokenizer:
    """Token ids of many texts at once, each distinct unit (letters, a digit, signs) encoded once.

    The vocabulary's merges never cross units, so the ids of a text are those of its units in
    turn. A text with other characters than those whose units are known here, or with what may be a
    special token, is encoded as a whole. The cache is emptied when it is full.
    """

    # The vocabulary's own units, but for runs of letters.
    SIGNS = "('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t-\r a-z0-9À-ÖØ-öø-ÿ]+)"
    OTHER = re.compile("[^!-~À-ÖØ-öø-ÿ‐-‧]|<\\|")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.units: dict[str, bytes | bool] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and where those of each text begin and end; NULL is empty."""
        texts = pc.fill_null(texts, "")
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), self.SIGNS, r" \1 ")
        split = pc.ascii_split_whitespace(spaced)
        coded = split.flatten().dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        used, offsets = coded.indices.to_numpy(), split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        whole = np.array([x is False for x in ids], dtype=bool)
        if whole.any():
            texts_whole = np.unique(np.searchsorted(offsets, np.flatnonzero(whole[used]), side="right") - 1)
        flat = np.frombuffer(b"".join(x or b"" for x in ids), "<u4")
        sizes = np.array([len(x or b"") for x in ids], dtype=np.int64) // 4
        ends = np.concatenate(([0], np.cumsum(sizes[used])))
        shift = (np.cumsum(sizes) - sizes)[used] - ends[:-1]
        found, bounds = flat[np.repeat(shift, sizes[used]) + np.arange(ends[-1])], ends[offsets]
        if whole.any():
            parts = np.split(found, bounds[1:-1])
            for i in texts_whole.tolist():
                parts[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
            found, bounds = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return found, bounds

    def _ids(self, units):
        if len(self.units) > CACHED_UNITS:
            self.units.clear()
        ids = [*map(self.units.get, units)]
        new = [(i, u) for i, (u, known) in enumerate(zip(units, ids)) if known is None]
        for i, u in new:
            known = not self.OTHER.search(u) and array("I", [t.id for t in self.merges(u.lower().translate(BYTE_SIGNS))]).tobytes()
            ids[i] = self.units[u] = known
        return ids


_TOKENIZERS: dict[str, UnitTokenizer] = {}


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece of each document (doc_id, text): doc_id, piece, start, length, ids_crc32, and ids if wanted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        tokenizer = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, UnitTokenizer(path))
        for batch in released(batches):
            for offset in range(0, batch.num_rows, BATCH):
                part = batch.slice(offset, BATCH)
                ids, bounds = tokenizer.encode(part.column("text"))
                raw = memoryview(ids).cast("B")
                sizes = np.diff(bounds) + 1
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                last = piece == n[row] - 1
                cuts = [(raw[a:b], end if e else b"") for a, b, e in zip(
                    (4 * (bounds[row] + start)).tolist(), (4 * (bounds[row] + start + length - last)).tolist(), last.tolist())]
                columns = [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                           pa.array([zlib.crc32(e, zlib.crc32(ids)) for ids, e in cuts], pa.int64())]
                if with_ids:
                    columns.append(pa.array([bytes(ids) + e for ids, e in cuts], pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def rounds(bins: int) -> tuple[tuple[int, int], ...]:
    """(bins in a sequence, documents in a pattern) of the rounds of the fit: few documents of finely rounded lengths, or more of coarse ones."""
    return ((bins // 2, 5), (3 * bins // 8, 6), (3 * bins // 4, 4), (5 * bins // 16, 7), (bins // 4, 8), (3 * bins // 16, 10))


def pack_plan(counts: dict[int, int], capacity: int = CAPACITY, bins: int = BINS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences) that hold exactly ``counts`` pieces per length."""
    plan = plan_windows(counts, capacity, rounds(bins))
    return [*plan.fitted, *plan.greedy]


def lookup(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: the first rank of each share, its first sequence, pieces per sequence, and where their offsets are."""
    shares, next_rank, sequence = defaultdict(list), Counter(), 0
    for lengths, n in plan:
        offsets = defaultdict(list)
        for length, offset in zip(lengths, np.cumsum((0, *lengths))):
            offsets[length].append(int(offset))
        for length, at in offsets.items():
            shares[length].append((next_rank[length], sequence, at))
            next_rank[length] += n * len(at)
        sequence += n
    found = {}
    for length, rows in shares.items():
        each = np.array([len(at) for _, _, at in rows])
        found[length] = (np.array([r for r, _, _ in rows]), np.array([s for _, s, _ in rows]), each,
                         np.cumsum(each) - each, np.array([o for _, _, at in rows for o in at]))
    return found


def pack(rows: DataFrame, order_by: list[str], capacity: int = CAPACITY, bins: int = BINS) -> DataFrame:
    """Add sequence_id and offset to ``rows`` with a ``length`` from 1 to ``capacity``.

    The plan is sent to all tasks; its size depends on ``capacity`` and not on the rows: a few
    runs per length and pattern.
    """
    rows = checkpointed(rows)
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = lookup(pack_plan(counts, capacity, bins))
    ranked = with_positions(rows, ["length"], order_by, "_rank")
    kept = rows.columns
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema],
                        "sequence_id long", "`offset` long"])

    def run(batches):
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                own = lengths == length
                first, base, each, start, offsets = places[int(length)]
                share = np.searchsorted(first, ranks[own], side="right") - 1
                within = ranks[own] - first[share]
                sequence[own] = base[share] + within // each[share]
                offset[own] = offsets[start[share] + within % each[share]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, path or vocabulary_path(), capacity), ["doc_id", "piece", "ids_crc32"], capacity)


def packed_sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, ids (array of token ids), doc_ids in order."""
    packed = pack(pieces(docs, path or vocabulary_path(), capacity, with_ids=True),
                  ["doc_id", "piece", "ids_crc32"], capacity)
    schema = f"sequence_id long, ids array<long>, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                parts = row["parts"]
                yield pa.RecordBatch.from_pylist([{
                    "sequence_id": row["sequence_id"],
                    "ids": np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").tolist(),
                    "doc_ids": [p["doc_id"] for p in parts]}])

    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")
    return packed.groupBy("sequence_id").agg(parts).mapInArrow(run, schema)
