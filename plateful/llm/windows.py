"""Packing documents into windows by fitting repeats of a few lengths that fill a window exactly.

A document of more than ``WINDOW`` tokens is cut into whole windows and a rest; others stay whole.
Only the histogram of piece lengths, at most ``WINDOW`` numbers whatever the corpus, reaches the
driver, which plans in rounds over what is left of it:

1. lengths are rounded to steps, and all combinations of up to ``depth`` steps that fill a window are enumerated;
2. non-negative least squares solves how often each combination repeats against the histogram of steps;
3. the repeats are rounded, and each combination is dealt exact lengths whose deviations from the
   steps cancel, so that every window dealt here is full to the last token;
4. lengths for which no partner is left go to the next round, which takes other steps.

When a round places little, the residual pieces are packed greedily: longest first, into the smallest
gap that holds them. The plan says for each length which ranks go to which window and offset;
a window counts as padded unless its tokens are a power of two.

Defined results: a NULL or empty text is the end token alone; every row is packed on its own, also where
rows or doc_ids repeat (equal pieces are interchangeable, so they may swap places between runs);
very long texts are tokenized whole, a window of ids at a time; an empty table
gives an empty result; other columns are left out, whatever their names.
"""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plateful.llm.fitting import Plan, plan_windows
from plateful.llm.packing import UnitTokenizer, vocabulary_path
from plateful.llm.shared import released
from plateful.operators.keys import with_positions
from plateful.plans.staging import checkpointed

WINDOW = 4096
END = 2
BATCH = 512
# (steps in a window, pieces in a combination) of the rounds in turn; the last is repeated.
ROUNDS = ((64, 5), (48, 6), (96, 4), (40, 7), (32, 8), (24, 10))

_TOKENIZERS: dict[str, UnitTokenizer] = {}


def cut_pieces(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Per piece of each document: doc_id, start, length, ids_crc32, doc_tokens, and ids if wanted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        tokenizer = _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, UnitTokenizer(path))
        for batch in released(batches):
            for offset in range(0, batch.num_rows, BATCH):
                part = batch.slice(offset, BATCH)
                ids, bounds = tokenizer.encode(part.column("text"))
                raw, rows, cuts, crcs, kept = memoryview(ids).cast("B"), [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    tokens = b - a + 1
                    for start in range(0, tokens, window):
                        length = min(window, tokens - start)
                        last = end if start + length == tokens else b""
                        own = raw[4 * (a + start):4 * (a + start + length - len(last) // 4)]
                        rows.append(i)
                        cuts.append((start, length, tokens))
                        crcs.append(zlib.crc32(last, zlib.crc32(own)))
                        if with_ids:
                            kept.append(bytes(own) + last)
                start, length, tokens = np.array(cuts, dtype=np.int64).reshape(-1, 3).T
                columns = [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(start), pa.array(length),
                           pa.array(crcs, pa.int64()), pa.array(tokens)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def places(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, for each run of ranks: its first rank, first window, pieces per window, and offsets.

    Ranks of a run fill one window after the other; a window may hold a length several times.
    """
    runs, ranks, sequence = defaultdict(list), Counter(), 0
    for lengths, n in (*plan.fitted, *plan.greedy):
        at, offset = defaultdict(list), 0
        for length in lengths:
            at[length].append(offset)
            offset += length
        for length, offsets in at.items():
            runs[length].append((ranks[length], sequence, offsets))
            ranks[length] += n * len(offsets)
        sequence += n
    return {length: (np.array([r for r, _, _ in found]), np.array([s for _, s, _ in found]),
                     np.array([len(o) for _, _, o in found]), np.cumsum([0, *(len(o) for _, _, o in found)]),
                     np.array([x for _, _, o in found for x in o]))
            for length, found in runs.items()}


def place_pieces(pieces: DataFrame, order_by: list[str], window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` with a ``length`` from 1 to ``window``.

    What is sent to the tasks is the plan, a bounded number of runs per length, however many rows there
    are. Ranks within a length come from one sort over the whole table, so a hot length is no task of its own.
    """
    pieces = checkpointed(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(plan_windows(counts, window, ROUNDS))
    ranked = with_positions(pieces, ["length"], order_by, "_rank")
    kept = pieces.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema),
                        "sequence_id long, `offset` long"])

    def run(batches):
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                first, start, each, from_, offsets = where[int(length)]
                run_ = np.searchsorted(first, ranks[own], side="right") - 1
                windows, nth = np.divmod(ranks[own] - first[run_], each[run_])
                sequence[own], offset[own] = start[run_] + windows, offsets[from_[run_] + nth]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def window_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return place_pieces(cut_pieces(docs, path or vocabulary_path(), window), ["doc_id", "start", "ids_crc32"], window)


def window_sequences(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """The windows themselves: sequence_id, ids (array of token ids, not padded), doc_ids in order."""
    placed = place_pieces(cut_pieces(docs, path or vocabulary_path(), window, with_ids=True),
                          ["doc_id", "start", "ids_crc32"], window)
    schema = f"sequence_id long, ids array<long>, doc_ids array<{docs.schema['doc_id'].dataType.simpleString()}>"

    def joined(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in row["parts"]), "<u4").tolist()
                yield pa.RecordBatch.from_pylist([{"sequence_id": row["sequence_id"], "ids": ids,
                                                   "doc_ids": [p["doc_id"] for p in row["parts"]]}])

    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts")
    return placed.groupBy("sequence_id").agg(parts).mapInArrow(joined, schema)
