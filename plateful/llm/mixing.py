"""Mixing sources to target weights by capped water-filling.

Targets share a total by weight. A source whose share passes ``max_epochs`` times its size is
clamped there and its excess is shared again by weight among the others, until no share is
above its limit. Rows are then taken whole: each row of a source as often as the whole part
of target / size says, and a seeded part of the rows once more to fill the rest.

Defined results: a NULL text has size 0; a NULL source is a source of its own, placed last;
rows that repeat in doc_id and text draw the same lot, and where the cut falls among them as many of
them are taken as come nearest to the target; a very long text is one row that is taken or not; an empty table
gives an empty result; other columns are kept whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from plateful.llm.shared import broadcast_below, n_words
from plateful.operators.keys import with_positions
from plateful.plans.staging import checkpointed

LOTS = 4096


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Add ``weight``: the given weights in turn over ``source`` by code point, NULL last."""
    placed = with_positions(sources.withColumn("no_source", F.isnull("source")), [], ["no_source", "source"])
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    return placed.withColumn("weight", turn).drop("no_source", "position")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``sources`` (source_size, weight): ``total`` shared by weight under the limits.

    A pass sums the clamped limits and the open weights of all sources to one row, which
    gives the next level. Levels only rise, so a source once clamped stays so, and the loop
    ends with the pass that clamps no further one.
    """
    limit = F.col("source_size") * F.lit(float(max_epochs))

    def share(level):
        return F.col("weight") * F.lit(level[0]) / F.lit(level[1])

    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else share(level) >= limit
        found = sources.agg(F.count_if(over).alias("n"),
                            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)).alias("full"),
                            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open")).first()
        if found["n"] == clamped or not found["open"]:
            break
        clamped, level = found["n"], (total - found["full"], float(found["open"]))
    return sources.withColumn("target", limit if level is None else F.least(share(level), limit))


def lots(key: Column, seed: int) -> dict[str, Column]:
    """A seeded draw, the same on each run for the same text of ``key``, and two numbers from 0 to ``LOTS`` - 1 of it."""
    drawn = F.md5(F.concat(F.lit(f"{seed}|"), key))
    numbers = {name: F.conv(F.substr(drawn, F.lit(start), F.lit(3)), 16, 10).cast("int")
               for name, start in (("lot", 1), ("sublot", 4))}
    return {"draw": drawn, **numbers}


def cuts(rows: DataFrame, sources: DataFrame, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, target) with where the part of its rows taken once more ends.

    ``rows`` has source, size, lot and sublot. Sizes are summed per lot and, in the lot where
    the rest of the target ends, per sublot. Running sums go over at most ``LOTS`` rows, so
    no task orders the rows of a source. ``rest`` is what is left for the last sublot.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (sources.withColumn("whole", F.least(whole, F.lit(int(max_epochs))).cast("long"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    for name, level in (("last_lot", "lot"), ("last_sublot", "sublot")):
        plan = checkpointed(plan)
        open_rows = rows
        if level == "sublot":
            ends = broadcast_below(plan.select(F.col("source").alias("_of"), "last_lot"))
            open_rows = rows.join(ends, F.col("source").eqNullSafe(F.col("_of")) & (F.col("lot") == F.col("last_lot")))
        sums = open_rows.groupBy("source", level).agg(F.sum("size").alias("_size"))
        below = (F.sum("_size").over(Window.partitionBy("source").orderBy(level)) - F.col("_size"))
        ended = (sums.withColumn("_below", below)
                 .join(broadcast_below(plan.select(F.col("source").alias("_of"), "rest")),
                       F.col("source").eqNullSafe(F.col("_of")))
                 .filter((F.col("_below") <= F.col("rest")) & (F.col("rest") > 0)).groupBy("_of")
                 .agg(F.max(level).alias(name), F.max("_below").alias("_used")))
        plan = (plan.join(ended, F.col("source").eqNullSafe(F.col("_of")), "left")
                .withColumn("rest", F.col("rest") - F.coalesce("_used", F.lit(0))).drop("_of", "_used"))
    return plan.withColumns({"last_lot": F.coalesce("last_lot", F.lit(-1)),
                             "last_sublot": F.coalesce("last_sublot", F.lit(-1))})


def quotas(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source and draw in its last sublot: how many of the rows with this draw are taken once more.

    Rows with one draw are equal in doc_id and text. A sublot has few draws, some hundred where a source
    has ten billion rows, whatever number of rows each has; the nearest number of copies is taken.
    """
    ends = broadcast_below(plan.select(F.col("source").alias("_of"), "last_lot", "last_sublot", "rest"))
    here = F.col("source").eqNullSafe(F.col("_of")) & (F.col("lot") == F.col("last_lot")) & (F.col("sublot") == F.col("last_sublot"))
    draws = (rows.join(ends, here).groupBy("source", "draw", "rest")
             .agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.sum("size").alias("_sum")))
    below = F.sum("_sum").over(Window.partitionBy("source").orderBy("draw")) - F.col("_sum")
    nearest = F.floor(F.try_divide(F.col("rest") - below, F.col("size")) + F.lit(0.5))
    quota = F.greatest(F.lit(0), F.least(F.coalesce(nearest, F.lit(0)), F.col("n"))).cast("long")
    return draws.select(F.col("source").alias("_of"), F.col("draw").alias("_draw"), quota.alias("quota"))


def plan_mix(sized: DataFrame, share: float, max_epochs: float, weights: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Targets and cuts per source, and quotas, for ``sized`` (source, size, draw, lot, sublot), which is cheap to read again."""
    sources = cyclic_weights(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    sources = checkpointed(sources)
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    plan = checkpointed(cuts(sized, water_fill(sources, total, max_epochs), max_epochs))
    return plan, checkpointed(quotas(sized, plan))


def with_takes(rows: DataFrame, planned: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``rows`` (source, draw, lot, sublot, ...) with source_size, target and takes.

    Only the rows of the last sublots are numbered among those with their draw; the others take no part in that.
    """
    plan, quota = planned
    plan = broadcast_below(plan.withColumnRenamed("source", "_of").drop("weight", "rest"))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    last = (F.col("lot") == F.col("last_lot")) & (F.col("sublot") == F.col("last_sublot"))
    more = (F.col("lot") < F.col("last_lot")) | ((F.col("lot") == F.col("last_lot")) & (F.col("sublot") < F.col("last_sublot")))
    clear = rows.filter(~last).withColumn("takes", F.col("whole") + more.cast("long"))
    near = with_positions(rows.filter(last), ["draw"], [], "_nth")
    own = F.col("source").eqNullSafe(F.col("_of")) & (F.col("draw") == F.col("_draw"))
    near = (near.join(broadcast_below(quota), own, "left").drop("_of", "_draw")
            .withColumn("takes", F.col("whole") + (F.col("_nth") < F.col("quota")).cast("long")).drop("_nth", "quota"))
    return clear.unionByName(near).drop("whole", "last_lot", "last_sublot")


def draw_key() -> Column:
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))


def sized_documents(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size in words, draw, lot, sublot: all that the mix needs to know of a text."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       *[c.alias(n) for n, c in lots(draw_key(), seed).items()])


def mix_report(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0,
               weights: tuple[int, ...] = (3, 1, 2), seed: int = 11) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words the mix takes)."""
    sized = checkpointed(sized_documents(docs, seed))
    return (with_takes(sized, plan_mix(sized, share, max_epochs, weights))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("takes")).alias("taken"),
                    "source", "takes"))


def mix(docs: DataFrame, share: float = 1.5, max_epochs: float = 2.0,
        weights: tuple[int, ...] = (3, 1, 2), seed: int = 11) -> DataFrame:
    """The mixed documents: each row as often as it is taken, with all its columns."""
    sized = checkpointed(sized_documents(docs, seed))
    planned = plan_mix(sized, share, max_epochs, weights)
    rows = docs.select(F.struct("*").alias("_row"), "source", *[c.alias(n) for n, c in lots(draw_key(), seed).items()])
    taken = with_takes(rows, planned).filter("takes > 0")
    return (taken.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("takes").cast("int"))))
            .select("_row.*"))
