"""Merkle manifest of documents: one tree per language, and one tree over the languages' roots.

A tree is a table of nodes per level. Every level is joined with itself on computed sibling places
(the place XOR 1 where two nodes make a parent, each slot of the run otherwise), and the rows in slot
zero emit the parents. Going down again, every node joins its parent and puts its own siblings ahead of the
parent's, so a leaf ends up with the digests that prove it: 32 bytes a sibling, bottom to top.

Nodes are joined on (part, place), which is unique, so no task holds a part. Each level is written
once, as Parquet, and has a ``width``-th of the rows below; the driver only knows the number of levels.
(Checkpoints would carry on Spark's size estimate of a join, the product of both sides, which over
some fifteen levels becomes a number too long to multiply.)
Digests are 64 hex characters where they are hashed and 32 bytes where they are moved.

Defined results: a NULL is hashed as ``-`` and an empty text as ``0:``; a very long text is hashed whole;
a NULL language is a language of its own, the first one; rows that tie in doc_id are ordered by their
leaf, and rows that repeat are leaves of their own; a NULL doc_id comes first and is never
tampered with; an empty table gives an empty manifest; other columns are left out, whatever their names.
"""

from uuid import uuid4

from pyspark.sql import Column, DataFrame, functions as F

from plateful.llm.shared import hot_limit, split_join
from plateful.operators.keys import with_positions
from plateful.plans.staging import checkpointed, remove_folder, shared_folder

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7
DIGEST = 32
# So many first places are broadcast.
FEW_PARTS = 100_000
# Levels that one job of the way down joins.
LEVELS_A_JOB = 6


def framed(column: Column) -> Column:
    """A value as hashed: its UTF-8 byte count, a colon and the value, or ``-`` for NULL."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    """The digest of some text, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def nothing() -> Column:
    return F.lit(bytearray())


def text_of(digests: Column | str) -> Column:
    """One digest, or several in a row, as lower-case hex text."""
    return F.lower(F.hex(digests))


def document_leaves(docs: DataFrame) -> DataFrame:
    """part, place, digest and doc_id of every document, and ``changed``, the leaf after tampering (NULL without)."""
    leaf = digest(*[framed(F.col(f)) for f in FIELDS])
    one_more = F.col("n_chars").cast("decimal(20,0)") + F.lit(1)
    changed = digest(*[framed(one_more if f == "n_chars" else F.col(f)) for f in FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    # Part of an absent language is empty and others begin with a sign, so parts sort as languages do.
    part = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = docs.select(part.alias("part"), "doc_id", leaf.alias("digest"), F.when(tampered, changed).alias("changed"))
    # Places over the whole table, less the first of the part: parts may be many, and one may hold most rows.
    placed = with_positions(checkpointed(rows), [], ["part", "doc_id", "digest"], "place")
    parts = checkpointed(placed.groupBy("part").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n")))
    n_rows, n_parts = parts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if n_parts <= FEW_PARTS:
        placed = placed.join(F.broadcast(parts.drop("n")), "part")
    else:
        placed = split_join(placed, parts, "part", hot_limit(n_rows))
    return placed.withColumn("place", F.col("place") - F.col("first_place")).drop("first_place")


def linked(nodes: DataFrame, width: int) -> DataFrame:
    """``nodes`` with ``siblings``, the digests of the other nodes of their run in order."""
    slot, found, digests = F.col("place") % width, nodes, []
    places = ([F.col("place").bitwiseXOR(F.lit(1))] if width == 2 else
              [F.when(slot != s, F.col("place") - slot + s) for s in range(width)])
    for s, place in enumerate(places):
        other = nodes.select(F.col("part").alias("_part"), F.col("place").alias("_place"), F.col("digest").alias(f"_{s}"))
        found = (found.withColumn("_sibling", place)
                 .join(other, (F.col("part") == F.col("_part")) & (F.col("_sibling") == F.col("_place")), "left")
                 .drop("_part", "_place", "_sibling"))
        digests.append(F.coalesce(f"_{s}", nothing()))
    return found.select(*nodes.columns, F.concat(*digests).alias("siblings"))


def is_root() -> Column:
    """A node without another one in its part; it stays as it is on higher levels."""
    return (F.col("place") == 0) & (F.length("siblings") == 0)


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def climb(leaves: DataFrame, folder: str, width: int = 2) -> list[DataFrame]:
    """All parts' trees by level, from the leaves to the roots, which stand alone in the last level, written to ``folder``.

    ``leaves`` has part, place (from 0 without a gap in each part) and digest; more columns stay on the first level.
    """
    top = leaves.agg(F.max("place")).first()[0]
    levels = []
    while top is not None:
        level = written(linked(nodes if levels else leaves, width), f"{folder}/{len(levels)}")
        levels.append(level)
        if top == 0:
            break
        made = digest(text_of("digest"), text_of("siblings"))       # slot zero: all siblings come after it
        nodes = level.filter(F.col("place") % width == 0).select(
            "part", F.floor(F.col("place") / width).alias("place"), F.when(is_root(), F.col("digest")).otherwise(made).alias("digest"))
        top //= width
    return levels


def descend(levels: list[DataFrame], above: DataFrame, folder: str, width: int = 2) -> DataFrame:
    """The first level with ``path`` and ``steps``: the siblings and slots from each leaf up.

    ``above`` has for every part what follows its root: path, steps, and columns that all its leaves get.
    A step is slot * width + number of siblings.
    """
    given = [c for c in above.columns if c not in ("part", "path", "steps")]
    upper = above.withColumn("place", F.lit(0).cast("long"))
    slot, others = F.col("place") % width, (F.length("siblings") / DIGEST).cast("long")
    for i, level in reversed([*enumerate(levels)]):
        if i == len(levels) - 1:
            parent = F.col("place")
        else:
            parent = F.floor(F.col("place") / width)
        upper = upper.select(F.col("part").alias("_part"), F.col("place").alias("_place"),
                             F.col("path").alias("_path"), F.col("steps").alias("_steps"), *given)
        step = F.when(is_root(), F.array().cast("array<int>")).otherwise(F.array((slot * width + others).cast("int")))
        kept = [c for c in level.columns if c not in ("siblings",)] if i == 0 else ["part", "place"]
        upper = (level.withColumn("_up", parent)
                 .join(upper, (F.col("part") == F.col("_part")) & (F.col("_up") == F.col("_place")))
                 .select(*kept, F.concat("siblings", "_path").alias("path"), F.concat(step, "_steps").alias("steps"), *given))
        if i and i % LEVELS_A_JOB == 0:
            upper = written(upper, f"{folder}/{i}-down")
    return upper


def folded(leaf: Column, path: Column, steps: Column, width: int = 2) -> Column:
    """The root, as hex text, that a leaf (hex text) and its path lead to."""
    def climbed(state, step):
        before = F.floor(step / width).cast("int") * DIGEST
        after = (step % width).cast("int") * DIGEST - before
        made = F.sha2(F.concat(text_of(F.substring(path, state["at"], before)), state["digest"],
                               text_of(F.substring(path, state["at"] + before, after))), 256)
        return F.struct(made.alias("digest"), (state["at"] + before + after).alias("at"))

    start = F.struct(leaf.alias("digest"), F.lit(1).alias("at"))
    return F.aggregate(steps, start, climbed, lambda state: state["digest"])


def proofs(docs: DataFrame, folder: str, width: int = 2) -> DataFrame:
    """Per document: part, place, doc_id, digest, changed, path, steps, subroot and root (32 bytes each).

    ``folder``, one that all executors share, gets the levels; the result reads them, so it goes first.
    """
    levels = climb(document_leaves(docs), f"{folder}/lower", width)
    if not levels:
        return _no_proofs(docs)
    subroots = with_positions(levels[-1].select(F.col("part").alias("_of"), "digest"), [], ["_of"], "place")
    upper = climb(subroots.withColumn("part", F.lit("")), f"{folder}/upper", width)
    root = upper[-1].first()["digest"]
    end = upper[-1].select("part", nothing().alias("path"), F.array().cast("array<int>").alias("steps"))
    above = descend(upper, end, f"{folder}/upper", width).select(
        F.col("_of").alias("part"), "path", "steps", F.col("digest").alias("subroot"))
    return descend(levels, above, f"{folder}/lower", width).withColumn("root", F.lit(root))


def _no_proofs(docs):
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.sparkSession.createDataFrame([], f"""part string, doc_id {kind}, digest binary, changed binary, place long,
        path binary, steps array<int>, subroot binary, root binary""")


def manifest_report(docs: DataFrame, width: int = 2) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` folds the leaf as tampered with, if it is, with the siblings of the untampered tree.
    The levels are removed once the report is written.
    """
    folder = f"{shared_folder(docs.sparkSession)}/merkle-{uuid4().hex}"
    own = text_of(F.coalesce("changed", "digest"))
    found = checkpointed(proofs(docs, folder, width).select(
        "doc_id", "digest", "subroot", "root", F.unhex(F.sha2(text_of("path"), 256)).alias("proof"),
        F.unhex(folded(own, F.col("path"), F.col("steps"), width)).alias("folded")))
    remove_folder(docs.sparkSession, folder)
    names = {"digest": "leaf", "subroot": "subroot", "root": "root", "proof": "proof_sha256", "folded": "folded_root"}
    return found.select("doc_id", *[text_of(c).alias(name) for c, name in names.items()],
                        (F.col("folded") == F.col("root")).alias("verified"))
