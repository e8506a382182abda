"""Language of web pages by Bayesian fusion of evidence.

The posterior of a language multiplies
* the likelihood of the page's text under a model of letter triples per language,
* the likelihood of the declared markup language and of the address suffix, and
* a prior of the host, smoothed towards its domain, and that towards the whole corpus.

How far a declaration, a suffix or a host can be trusted is not assumed but counted over all
pages, by grouped sums of the text posteriors. A page's own text is taken out of the sums that
serve as its prior, so it is not counted twice. Text models are fitted on a bounded sample of
labelled documents (``Sample``).

Defined results: a NULL or empty page has no text evidence; a very long page is read whole, in time that grows with
its length also where its tags are not closed; a NULL or odd address has host,
domain and suffix NULL, which are counted like any other value; without a declaration that is
counted as such; rows that repeat are judged alike; without labelled documents the language
is NULL; an empty table gives an empty result; other columns are not read.
"""

import html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plateful.llm.shared import broadcast_below
from plateful.plans.staging import checkpointed

# A text's words are not independent: more words than this add no further certainty.
CERTAIN_WORDS = 40
# Pages of a host, and of a domain, whose evidence weighs as much as that of the level above.
HOST_WEIGHT, DOMAIN_WEIGHT, FLAT_WEIGHT = 5.0, 20.0, 1.0
CACHED_WORDS = 300_000

_HIDDEN = "script|style|nav|header|footer|aside|noscript|title"
_OPENS = re.compile(rf"(?i)<!--|<({_HIDDEN})\b")
_CLOSES = {"!": re.compile("-->"), **{tag: re.compile(rf"(?i)</{tag}\s*>") for tag in [*_HIDDEN.split("|"), "article", "main"]}}
_MAIN_OPENS = re.compile(r"(?i)<(article|main)\b")
_TAG = re.compile(r"(?s)<[^>]*>")
_ROOT = re.compile(r"(?i)<html\b")
_LANG = re.compile(r"""(?i)\blang\s*=\s*["']?([a-z]{2,3})\b""")
_HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
_WORD = re.compile(r"[^\W\d_]+")


class Sample(NamedTuple):
    """Bounds of the labelled sample: documents per language and of all languages, longest text.

    Every language is in it; beyond some 60 languages each has fewer documents.
    """

    documents: int = 300
    max_chars: int = 20_000
    in_all: int = 20_000


class Model(NamedTuple):
    """Per letter triple the log-probability of its last letter in each language."""

    languages: list[str]
    triples: dict[str, np.ndarray]
    unseen: np.ndarray


def labelled_sample(docs: DataFrame, bounds: Sample = Sample()) -> DataFrame:
    """(lang, text): about ``bounds.documents`` documents of each language, chosen by a hash of doc_id.

    A language without a text of at most ``bounds.max_chars`` characters has the beginnings of its longer ones.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    short = F.length("text") <= bounds.max_chars
    counts = [(r["lang"], r["short"] or r["n"], r["short"] > 0) for r in known.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(short).alias("short")).collect()]
    if not counts:
        return docs.sparkSession.createDataFrame([], "lang string, text string")
    each = min(bounds.documents, max(1, bounds.in_all // len(counts)))
    only_long = [lang for lang, _, has_short in counts if not has_short]
    known = (known.filter(short | F.col("lang").isin(only_long))
             .withColumn("text", F.substr("text", F.lit(1), F.lit(bounds.max_chars))))
    rate = F.element_at(F.create_map(*[F.lit(x) for lang, n, _ in counts for x in (lang, each / n)]),
                        F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(2 ** 31)) / F.lit(float(2 ** 31))
    return (known.filter(draw < rate).select("lang", "text", draw.alias("draw")).orderBy("draw", "lang", "text")
            .limit(2 * each * len(counts)).select("lang", "text"))


def fit(rows: list[tuple[str, str]], smoothing: float = 0.1) -> Model | None:
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    counts = {lang: Counter() for lang in languages}
    for lang, text in rows:
        words = Counter(_WORD.findall(text.lower()))
        for word, n in words.items():
            padded = f"  {word} "
            for i in range(len(padded) - 2):
                counts[lang][padded[i:i + 3]] += n
    letters = len({t[2] for c in counts.values() for t in c}) + 1
    starts = {lang: Counter() for lang in languages}
    for lang, c in counts.items():
        for t, n in c.items():
            starts[lang][t[:2]] += n
    triples = {t: np.array([np.log((counts[lang][t] + smoothing) / (starts[lang][t[:2]] + smoothing * letters))
                            for lang in languages]) for t in sorted(set().union(*counts.values()))}
    return Model(languages, triples, np.full(len(languages), -np.log(letters)))


def shown(page: str) -> str:
    """``page`` without comments, scripts and menus, each from its opening to the first closing after it.

    A part that is not closed stays. After the first such one its kind is not looked for again, so pages of unclosed
    tags take no longer than others.
    """
    kept, at, unclosed = [], 0, set()
    for opening in _OPENS.finditer(page):
        kind = (opening[1] or "!").lower()
        if opening.start() < at or kind in unclosed:
            continue
        closing = _CLOSES[kind].search(page, opening.end())
        if closing is None:
            unclosed.add(kind)
        else:
            kept.append(page[at:opening.start()])
            at = closing.end()
    return " ".join([*kept, page[at:]])


def main_part(page: str) -> str:
    """What stands between the first article or main tag that is closed and the last closing of its kind; else all."""
    last = {tag: max((m.start() for m in _CLOSES[tag].finditer(page)), default=-1) for tag in ("article", "main")}
    for opening in _MAIN_OPENS.finditer(page):
        end = page.find(">", opening.end())
        if end < 0:
            break
        if last[opening[1].lower()] > end:
            return page[end + 1:last[opening[1].lower()]]
    return page


def declared_language(page: str) -> str | None:
    """The language that the first html tag with one declares."""
    at = 0
    while opening := _ROOT.search(page, at):
        at = page.find(">", opening.end())
        tag = page[opening.end():at if at >= 0 else len(page)]
        if found := _LANG.search(tag):
            return found[1].lower()
        if at < 0:
            break
    return None


def page_text(page: str) -> str:
    """Readable text of a page: its article or main part if it has one, without scripts and menus."""
    part = main_part(shown(page))
    tagged = part.rfind(">") + 1            # a sign that no bracket follows opens no tag
    return html.unescape(_TAG.sub(" ", part[:tagged]) + part[tagged:])


class Reader:
    """Log-likelihoods of texts; those of each distinct word are kept until the cache is full."""

    def __init__(self, model: Model):
        self.model, self.words = model, {}

    def _word(self, word):
        found = self.words.get(word)
        if found is None:
            padded = f"  {word} "
            found = sum((self.model.triples.get(padded[i:i + 3], self.model.unseen) for i in range(len(padded) - 2)),
                        np.zeros(len(self.model.languages)))
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            self.words[word] = found
        return found

    def __call__(self, text: str) -> np.ndarray:
        counted = Counter(_WORD.findall(text.lower()))
        n = counted.total()
        total = sum((k * self._word(w) for w, k in counted.items()), np.zeros(len(self.model.languages)))
        return total * min(1.0, CERTAIN_WORDS / n) if n else total


def evidence(pages: DataFrame, model: Model) -> DataFrame:
    """Per page: page_id, host, domain, suffix, declared, and text: the text posterior under equal priors."""
    kind = pages.schema["page_id"].dataType.simpleString()
    shared = pages.sparkSession.sparkContext.broadcast(model)
    names = ["page_id", "host", "domain", "suffix", "declared", "text"]

    def address(url):
        host = _HOST.match(url or "")
        labels = host.group(1).lower().strip(".").split(".") if host else []
        return (".".join(labels), ".".join(labels[-2:]), labels[-1]) if labels and labels[-1] else (None, None, None)

    def run(batches):
        reader = Reader(shared.value)
        for batch in batches:
            for offset in range(0, batch.num_rows, 256):
                part, rows = batch.slice(offset, 256), []
                for url, page in zip(part.column("url").to_pylist(), part.column("html").to_pylist()):
                    seen = reader(page_text(page or ""))
                    share = np.exp(seen - seen.max())
                    rows.append((*address(url), declared_language(page or ""),
                                 (share / share.sum()).tolist()))
                types = [pa.string()] * 4 + [pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=names)

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, host string, domain string, suffix string, declared string, text array<double>")


def _sums(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Per value of ``key``, NULL included, the summed text posteriors as an array."""
    sums = rows.groupBy(key).agg(*[F.sum(F.col("text")[i]).alias(f"_{i}") for i in range(n)])
    return sums.select(F.col(key).alias(f"of_{key}"), F.array(*[f"_{i}" for i in range(n)]).alias(f"by_{key}"))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _smoothed(own: Column, above: Column, weight: float) -> Column:
    size = _total(own)
    return F.zip_with(own, above, lambda x, up: (x + weight * up) / (size + weight))


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Add to ``evidence`` the posterior per language (array), the language and its probability."""
    n = len(languages)
    known = F.col("declared").isin(*languages)
    rows = checkpointed(rows.withColumn("claim", F.when(known, F.col("declared"))
                                        .when(F.col("declared").isNotNull(), F.lit("other"))))
    # A few numbers per language: pages in all, and distinct claims and suffixes that share them.
    sums = rows.agg(*[F.sum(F.col("text")[i]) for i in range(n)]).first()
    whole = [*sums, rows.filter(F.col("suffix").isNotNull()).select("suffix").distinct().count()]
    per_language = [x or 0.0 for x in whole[:n]]
    pages = F.array(*[F.lit(float(x)) for x in per_language])
    corpus = F.array(*[F.lit((x + FLAT_WEIGHT / n) / (sum(per_language) + FLAT_WEIGHT)) for x in per_language])
    tables = {key: checkpointed(_sums(rows, key, n)) for key in ("claim", "suffix", "domain", "host")}
    for key, table in tables.items():
        rows = rows.join(broadcast_below(table), F.col(key).eqNullSafe(F.col(f"of_{key}"))).drop(f"of_{key}")

    def others(column):
        return F.zip_with(F.col(column), F.col("text"), lambda x, own: F.greatest(x - own, F.lit(0.0)))

    def likelihood(column, values):
        return F.zip_with(_plus(others(column), F.transform(corpus, lambda c: c * FLAT_WEIGHT)), pages,
                          lambda x, all_pages: x / (all_pages + FLAT_WEIGHT * values))

    prior = _smoothed(others("by_host"), _smoothed(others("by_domain"), corpus, DOMAIN_WEIGHT), HOST_WEIGHT)
    joint = F.transform(F.arrays_zip(F.col("text").alias("text"), prior.alias("prior"),
                                     likelihood("by_claim", n + 2).alias("claim"),
                                     likelihood("by_suffix", whole[n] + 1).alias("suffix")),
                        lambda e: e["text"] * e["prior"] * e["claim"] * e["suffix"])
    posterior = F.transform("joint", lambda x: F.when(_total(F.col("joint")) > 0, x / _total(F.col("joint"))).otherwise(1 / n))
    named = F.array(*map(F.lit, languages))
    best = F.array_position("posterior", F.array_max("posterior"))
    likely = F.array_position("text", F.array_max("text"))
    return (rows.withColumn("joint", joint).withColumn("posterior", posterior)
            .select("page_id", F.element_at(named, best.cast("int")).alias("language"),
                    F.array_max("posterior").alias("probability"), F.element_at(named, likely.cast("int")).alias("text_language"),
                    "declared", "suffix", "host", "posterior"))


def identify(pages: DataFrame, docs: DataFrame, bounds: Sample = Sample()) -> DataFrame:
    """Per page: page_id, language, probability, text_language, declared, suffix, host."""
    sample = [(r["lang"], r["text"]) for r in labelled_sample(docs.select("doc_id", "lang", "text"), bounds).collect()]
    model = fit(sample)
    if model is None:
        return pages.select("page_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("language", "string"), ("probability", "double"), ("text_language", "string"), ("declared", "string"),
            ("suffix", "string"), ("host", "string"))])
    return fuse(evidence(pages, model), model.languages).drop("posterior")
