"""How filters interact: what each removes, and finds removed already, in every order of the filters.

Each document is judged once. One id table is stored per filter: the ids that fail it, with their part and
labels. What a filter removes after others does not depend on the order of those others, so every failing
id meets every set of other filters that may come first (a prefix): a left anti join with the id tables of the
prefix leaves what the filter removes, and their labels are what is lost; a left semi join leaves
what was redundant. Both joins go by id, and prefixes are put in after the exchange, so the narrow
id tables are shuffled once, evenly. Only counts per part, filter and prefix go on, to all orders.

Defined results: a NULL text counts as empty; very long texts are judged whole; a NULL part is the empty one;
rows that repeat count as often as they occur, and rows of one doc_id never make one another
copies; a NULL doc_id has no labels, is no copy and makes none; a label that repeats counts once; a
table without rows gives none; other columns are left out, whatever their names.
"""

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F, Window

from plateful.llm.shared import WORD
from plateful.plans.staging import checkpointed

# A key with more rows than both is hot. There are at most HOT_KEYS of those, so they may be broadcast.
HOT_ROWS = 1000
HOT_KEYS = 100_000
COUNTS = ["removed", "redundant", "good_lost", "toxic_lost"]


def document_filters() -> dict[str, Column]:
    """Failure conditions over ``words`` (array of words) and ``text`` (not NULL)."""
    n_words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.regexp_count("text", F.lit("[A-Z]"))
    return {"A": n_words < 100,
            "B": 100 * distinct < 80 * n_words,
            "C": 100 * capitals > 10 * F.char_length("text"),
            "D": F.col("text").rlike("[#$%&*|]")}


def split_by_heat(rows: DataFrame, key: str, counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hot rows, other rows, and the hot keys, a table of at most ``HOT_KEYS`` rows marked for broadcast.

    ``counts`` has the ``key`` and its number of rows as ``n``.
    """
    limit = max(HOT_ROWS, rows.count() // HOT_KEYS)
    hot = F.broadcast(counts.filter(F.col("n") > limit).select(key))
    return rows.join(hot, key, "left_semi"), rows.join(hot, key, "left_anti"), hot


def looked_up(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``rows`` left joined with ``table``, which has one row per key; hot keys are not shuffled."""
    hot_rows, other_rows, hot = split_by_heat(rows, key, counts)
    few = F.broadcast(table.join(hot, key, "left_semi"))
    return hot_rows.join(few, key, "left").unionByName(other_rows.join(table, key, "left"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document row: id, part, whether it fails A to E, and whether it is labelled good or toxic."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("id"), "doc_id", "part",
                                    F.unhex(F.sha2("text", 256)).alias("digest"),
                                    *[fails.alias(name) for name, fails in document_filters().items()]))
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    copies = checkpointed(copies.filter("n > 1"))
    rows = looked_up(rows, copies.select("digest", "first_id"), "digest", copies)
    rows = rows.withColumn("E", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))).drop("first_id", "digest")
    marks = (labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                  F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")))
    rows = checkpointed(rows)
    often = checkpointed(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(f"n > {HOT_ROWS}"))
    return checkpointed(looked_up(rows, marks, "doc_id", often).drop("doc_id").na.fill(False, ["good", "toxic"]))


def failing_ids(rows: DataFrame, filters: list[str]) -> dict[str, DataFrame]:
    """Per filter the stored table of the ids that fail it: id, part, good, toxic."""
    return {f: checkpointed(rows.filter(f).select("id", "part", "good", "toxic")) for f in filters}


def prefix_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Per part, filter and prefix (bits of the filters ahead) with any failing id: the ``COUNTS``."""
    bits = {f: 1 << i for i, f in enumerate(tables)}
    every = (1 << len(tables)) - 1
    failing = reduce(DataFrame.unionByName, [t.withColumn("bit", F.lit(bits[f])) for f, t in tables.items()])
    prefixes = F.filter(F.sequence(F.lit(0), F.lit(every)), lambda p: p.bitwiseAND(F.col("bit")) == 0)
    probes = failing.repartition("id").withColumn("prefix", F.explode(prefixes))
    ahead = failing.select(F.col("id").alias("_id"), F.col("bit").alias("_bit")).repartition("_id")
    met = (F.col("id") == F.col("_id")) & (F.col("prefix").bitwiseAND(F.col("_bit")) != 0)
    one = F.lit(1).cast("long")
    removed = probes.join(ahead, met, "left_anti").select(
        "part", "bit", "prefix", one.alias("removed"), (one - one).alias("redundant"),
        F.col("good").cast("long").alias("good_lost"), F.col("toxic").cast("long").alias("toxic_lost"))
    redundant = probes.join(ahead, met, "left_semi").select(
        "part", "bit", "prefix", (one - one).alias("removed"), one.alias("redundant"),
        (one - one).alias("good_lost"), (one - one).alias("toxic_lost"))
    keys = ["part", "bit", "prefix"]
    each = [t.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS]) for t in (removed, redundant)]
    return each[0].unionByName(each[1]).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def all_orders(parts: DataFrame, filters: list[str]) -> DataFrame:
    """``parts`` times all orders and steps: filter_order, step, bit and prefix of the filter at that step."""
    bits = {f: 1 << i for i, f in enumerate(filters)}
    steps = [(",".join(order), i + 1, bits[f], sum(bits[g] for g in order[:i]))
             for order in permutations(filters) for i, f in enumerate(order)]
    packed = F.split(F.lit(";".join("|".join(map(str, s)) for s in steps)), ";")
    rows = parts.withColumn("_step", F.explode(packed)).withColumn("_step", F.split("_step", "[|]"))
    return rows.select(*parts.columns, F.replace(F.col("_step")[0], F.lit(",")).alias("filter_order"),
                       *[F.col("_step")[i].cast("int").alias(c) for i, c in ((1, "step"), (2, "bit"), (3, "prefix"))])


def interactions(rows: DataFrame, filters: list[str]) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``rows`` has id, part, good, toxic and a boolean per filter. Parts are as many as they are; orders are
    as many as the filters allow, so filters should be few.
    """
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("_rows"))
    counts = checkpointed(prefix_counts(failing_ids(rows, filters)))
    found = all_orders(parts, filters).join(counts, ["part", "bit", "prefix"], "left").na.fill(0, COUNTS)
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    of_filter = Window.partitionBy("part", "bit")
    last = F.when(F.col("step") == len(filters), F.col("removed"))
    return (found.withColumn("kept", F.col("_rows") - F.sum("removed").over(so_far))
            .withColumn("unique_fails", F.max(last).over(of_filter)).withColumn("shapley", F.sum("removed").over(of_filter))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the filters A to E over ``documents`` by language."""
    return interactions(judged(docs, labels), ["A", "B", "C", "D", "E"])
