"""Secret scanning: three fixed kinds of secrets, and strings that a battery of tests takes for random.

Fixed kinds are found by pattern. Other candidates are runs of 20 or more letters, digits and signs of
base 64, with a letter among them, that no fixed span touches, also directly after an equals sign. For each the encoding is inferred from its characters, and three tests ask
whether it may be random in that alphabet: chi-squared uniformity, runs above and below the
middle, and serial correlation. Their smallest p-value, corrected for three independent tests, is uniform for
random strings and near 0 for names, paths and words.

Which candidates count is decided over the whole corpus, by encoding and length: in each such
class the p-values above one half tell how many different candidates are random (copies count once), and the cut
is the lowest at which the share of others among those kept stays under ``MAX_FALSE``. Short strings,
where the tests tell less, so need higher p-values than long ones. In a class of a few strings their number
tells little, and the doubt is theirs: they are kept, so ``MAX_FALSE`` holds for large classes only.

Defined results: a NULL or empty text has no spans; a very long text, or one with very many matches, is scanned
whole in time that grows with its length; rows that repeat have the same spans; an empty table gives an empty result; other columns are not read. Offsets are code points, ends exclusive.
"""

from pyspark.sql import Column, DataFrame, functions as F

from plateful.plans.staging import checkpointed

ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# Maximal runs of at least the least length are the same as all runs with the short ones dropped.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
# A run may stand directly after '=', as in KEY=value: padding belongs to the run before it.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}"

_DIGITS, _SMALL, _CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets in the order they are tried; each string has the first that holds all its characters. Strings without
# a digit, mostly names and paths, have their own: random ones are uniform in them too, and are judged among their like.
ALPHABETS = {
    **{name + signs: letters + signs for signs in ("", "-_", "+/", "+/-_")
       for name, letters in (("small", _SMALL), ("CAPITAL", _CAPITAL), ("letters", _CAPITAL + _SMALL))},
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _CAPITAL + "234567",
    "base36": _DIGITS + _SMALL, "BASE36": _DIGITS + _CAPITAL, "base62": _DIGITS + _CAPITAL + _SMALL,
    "base64": _CAPITAL + _SMALL + _DIGITS + "+/", "base64url": _CAPITAL + _SMALL + _DIGITS + "-_",
    "mixed": _CAPITAL + _SMALL + _DIGITS + "+/-_",
}
# p-values are judged in bins of 5 %; the lowest never counts.
BINS = 20
LEAST_BIN = 1
MAX_FALSE = 0.05


# Entries of an array that are added up one by one before blocks of them are.
BLOCK = 64


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` needs it for every entry of another array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, add) -> Column:
    """Running results of ``add`` over an array of bigints from 0 on.

    Appending to an array copies it, so entries are run through in blocks, and the blocks' results after that: the
    work grows with the array, not with its square.
    """
    longs = F.array().cast("array<bigint>")

    def one_by_one(own):
        def step(state, x):
            now = add(state["at"], x)
            return F.struct(now.alias("at"), F.concat(state["all"], F.array(now)).alias("all"))

        return F.aggregate(own, F.struct(F.lit(0).cast("bigint").alias("at"), longs.alias("all")), step, lambda s: s["all"])

    def in_blocks(own):
        starts = F.sequence(F.lit(1), F.size(own), F.lit(BLOCK))
        return F.transform(starts, lambda i: one_by_one(F.slice(own, i, F.lit(BLOCK))))

    def joined(blocks):
        ends = F.concat(F.array(F.lit(0).cast("bigint")), one_by_one(F.transform(blocks, lambda b: F.element_at(b, -1))))
        return let(ends, lambda before: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda x: add(F.get(before, i), x)))))

    whole = let(values.cast("array<bigint>"), lambda own: let(in_blocks(own), joined))
    return F.when(F.size(values) > 0, whole).otherwise(longs)


def found(text: Column, pattern: str, kind: str, group: int = 0, least: int = 1) -> Column:
    """Array of (start, place, end, kind, match) of all matches, leftmost first and not overlapping.

    A match counts if its ``group`` has ``least`` characters; others still use up their text.
    """
    kept = "array<struct<start:int,place:int,end:int,kind:string,match:string>>"
    each = F.zip_with(
        F.split(text, pattern, -1),
        F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                   lambda whole, part: F.struct(whole.alias("whole"), F.length(part).alias("size"))),
        lambda before, m: F.struct(F.length(before).alias("gap"), m["whole"].alias("match"), m["size"].alias("size")))

    def placed(parts):
        ends = running(F.transform(parts, lambda m: (m["gap"] + F.coalesce(F.length(m["match"]), F.lit(0))).cast("bigint")),
                       lambda a, x: a + x)
        spans = F.zip_with(parts, ends, lambda m, end: F.struct(
            (end - F.length(m["match"])).cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("place"),
            end.cast("int").alias("end"), F.lit(kind).alias("kind"), m["match"].alias("match"), m["size"].alias("size")))
        bare = F.transform(F.filter(spans, lambda x: x["size"] >= least),
                           lambda x: F.struct(x["start"], x["place"], x["end"], x["kind"], x["match"]))
        return bare.cast(kept)

    return F.when(text.rlike(pattern), let(each, placed)).otherwise(F.array().cast(kept))


def free_of(spans: Column, base: Column) -> Column:
    """The ``spans`` that no span of ``base`` touches; both ascend by start.

    Ends of spans and starts of base spans are put in one order; the farthest end of the base spans that begin
    before a span ends tells whether one reaches into it.
    """
    def entries(own):
        ends = F.transform(own, lambda c, i: F.struct(c["end"].alias("at"), F.lit(0).alias("later"), F.lit(0).cast("bigint").alias("reach"),
                                                      i.alias("nth")))
        starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("later"), b["end"].cast("bigint").alias("reach"),
                                                      F.lit(-1).alias("nth")))
        return F.array_sort(F.concat(ends, starts))

    def untouched(own, ordered):
        reach = running(F.transform(ordered, lambda e: e["reach"]), F.greatest)
        told = F.filter(F.zip_with(ordered, reach, lambda e, far: F.struct(e["nth"].alias("nth"), far.alias("far"))), lambda e: e["nth"] >= 0)
        # Spans ascend by end too, so what is told of them is in their own order.
        both = F.zip_with(own, told, lambda c, e: F.struct(c.alias("c"), (e["far"] <= c["start"]).alias("free")))
        return F.transform(F.filter(both, lambda x: x["free"]), lambda x: x["c"])

    return F.when((F.size(spans) > 0) & (F.size(base) > 0),
                  let(spans, lambda own: let(entries(own), lambda ordered: untouched(own, ordered)))).otherwise(spans)


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(found(text, ASSIGN, "assign", 2, 6), found(text, ACCESS, "access"),
                                 found(text, HEX, "hex")))


def tail(z: Column) -> Column:
    """Share of a standard normal beyond ``z`` on the upper side, to seven digits.

    The fixed numbers are a published rational approximation of the error function.
    """
    x = F.abs(z) / 2 ** 0.5
    t = 1 / (1 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    beyond = F.least(0.5 * series * F.exp(-x * x), F.lit(0.5))
    return F.when(z >= 0, beyond).otherwise(1 - beyond)


def encoding(core: Column) -> Column:
    choice = F.lit("mixed")
    for name, alphabet in reversed(ALPHABETS.items()):
        signs = "".join("\\" + c if c in "+/-" else c for c in alphabet)
        choice = F.when(core.rlike(f"^[{signs}]+$"), name).otherwise(choice)
    return choice


def randomness(core: Column, name: Column) -> Column:
    """p-value of the battery for strings of 20 or more characters in alphabet ``name``."""
    alphabet = F.element_at(F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair]), name)

    def total(array, of):
        return F.aggregate(array, F.lit(0.0), lambda a, x: a + of(x))

    def numbered(o):
        values = F.transform(o["chars"], lambda c: (F.instr(o["alphabet"], c) - 1).cast("double"))
        squares = total(F.array_distinct(o["chars"]),
                        lambda c: F.pow(F.length(core) - F.length(F.replace(core, c, F.lit(""))), F.lit(2.0)))
        return let(F.struct(F.length(o["alphabet"]).cast("double").alias("k"), F.size(o["chars"]).cast("double").alias("n"),
                            values.alias("values"), squares.alias("squares")), summed)

    def summed(o):
        high = total(o["values"], lambda v: (v >= o["k"] / 2).cast("double"))
        return let(F.struct(*[o[c].alias(c) for c in ("k", "n", "values", "squares")], high.alias("high"),
                            (total(o["values"], lambda v: v) / o["n"]).alias("mean")), tested_by)

    def tested_by(o):
        k, n, values, high, mean = (o[c] for c in ("k", "n", "values", "high", "mean"))
        spread = 2 / (9 * (k - 1))
        uneven = (F.pow((k / n * o["squares"] - n) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
        pairs = F.zip_with(F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values) - 1),
                           lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        turns = total(pairs, lambda p: ((p["a"] >= k / 2) != (p["b"] >= k / 2)).cast("double"))
        both = 2 * high * (n - high)
        expected, variance = both / n + 1, both * (both - n) / (n * n * (n - 1))
        runs = F.when((high > 0) & (high < n) & (variance > 0), F.abs((turns + 1 - expected) / F.sqrt(variance)))
        around = total(values, lambda v: (v - mean) * (v - mean))
        together = total(pairs, lambda p: (p["a"] - mean) * (p["b"] - mean))
        serial = F.when(around > 0, F.abs(together / around) * F.sqrt(n))
        return let(F.struct(uneven.alias("uneven"), runs.alias("runs"), serial.alias("serial")), lowest)

    def lowest(z):
        # A test that cannot be made, as with one letter only, speaks against randomness.
        two_sided = [F.when(z[t].isNotNull(), 2 * tail(z[t])).otherwise(0.0) for t in ("runs", "serial")]
        return 1 - F.pow(1 - F.least(tail(z["uneven"]), *two_sided, F.lit(1.0)), F.lit(3.0))

    chars = F.regexp_extract_all(core, F.lit("(?s)."), F.lit(0))
    return let(F.struct(alphabet.alias("alphabet"), chars.alias("chars")), numbered)


def candidates(text: Column, base: Column) -> Column:
    """Candidate spans that touch no base span, with their core (without padding) and encoding."""
    free = free_of(found(text, CANDIDATE, "random"), base)

    def described(c):
        core = F.rtrim(c["match"], F.lit("="))
        return F.struct(c["start"].alias("start"), c["place"].alias("place"), c["end"].alias("end"), c["kind"].alias("kind"),
                        core.alias("core"), encoding(core).alias("encoding"))

    return F.transform(free, described)


def tested(candidate_spans: Column) -> Column:
    """Candidates with the class they are judged in, the bin of their p-value and a hash that copies share."""
    def judged(c):
        p = randomness(c["core"], c["encoding"])
        return F.struct(c["start"].alias("start"), c["place"].alias("place"), c["end"].alias("end"), c["kind"].alias("kind"),
                        F.concat_ws(" ", c["encoding"], F.floor(F.log2(F.length(c["core"]))).cast("string")).alias("class"),
                        F.least(F.floor(p * BINS), F.lit(BINS - 1)).cast("int").alias("bin"), F.xxhash64(c["core"]).alias("core"))

    return F.transform(candidate_spans, judged)


def cuts(scanned: DataFrame, max_false: float = MAX_FALSE) -> DataFrame:
    """One row with a map from class to the lowest bin that counts. Classes are few: encodings by doublings of length."""
    # A hot class is cut to its different strings in each task before the shuffle.
    different = scanned.select(F.explode("tested").alias("c")).select("c.class", "c.core", "c.bin").distinct()
    counts = different.groupBy("class").agg(F.array(*[F.count_if(F.col("bin") == i) for i in range(BINS)]).alias("n"))

    def above(least):
        return F.aggregate(F.slice("n", F.lit(least + 1), F.lit(BINS - least)), F.lit(0).cast("long"), lambda a, x: a + x)

    # So many random ones may well be in the upper half: the score limit of a count, which holds for small ones too.
    half = above(BINS // 2)
    counts = counts.withColumn("random", (half + 1.35 + 1.64 * F.sqrt(half + 0.67)) / (BINS - BINS // 2))
    # Bins without candidates too: fewer of the random ones are expected above a higher bin.
    passing = [F.when(above(i) - F.col("random") * (BINS - i) <= max_false * above(i), i) for i in range(LEAST_BIN, BINS)]
    lowest = counts.select("class", F.coalesce(*passing).alias("bin")).filter(F.col("bin").isNotNull())
    return lowest.agg(F.map_from_entries(F.collect_list(F.struct("class", "bin"))).alias("cuts"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, max_false: float = MAX_FALSE) -> DataFrame:
    """Per document (doc_id, text): doc_id, base and spans as arrays of (start, place, end, kind)."""
    def bare(spans):
        return F.transform(spans, lambda s: F.struct(s["start"], s["place"], s["end"], s["kind"]))

    scanned = docs.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    scanned = scanned.select("doc_id", "base", tested(candidates(F.col("text"), F.col("base"))).alias("tested"))
    scanned = checkpointed(scanned.select("doc_id", bare(F.col("base")).alias("base"), "tested"))
    lowest = cuts(scanned, max_false).scalar()
    more = F.filter("tested", lambda c: c["bin"] >= F.element_at(F.col("cuts"), c["class"]))
    return (scanned.withColumn("cuts", lowest)
            .select("doc_id", "base", F.array_sort(F.concat("base", bare(more))).alias("spans")))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found_spans = scan(docs.select("doc_id", "text"))

    def n(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found_spans.select("doc_id", *map(n, KINDS[:3]), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                              _joined(F.col("spans")).alias("spans"))

