"""Language identification by fusing evidence: text, declared language, address suffix, host.

The text's likelihood under each language comes from hashed byte trigrams, counted over a bounded sample of labelled
documents (``SAMPLE`` per language, whole texts). From the text alone follow soft language counts, which grouped aggregates
add up for each declared language, address suffix, host and domain. They give the chance of a declaration or suffix in a
language, and a prior for the host that is smoothed with that of its domain, which is smoothed with the corpus. A page's own
share is taken out of the counts before they judge it. Bayes' rule puts the four together.

Labels are folded: case and what follows the first ``-`` or ``_`` do not count (``EN``, ``en-US`` and ``en_GB`` are ``en``).
There may be any number of languages: texts are scored against ``BLOCK`` languages at a time, so no task holds more of the
model; each row carries one number per language, and the driver their names and one block of the model.

Defined cases: without text (null, empty) the other evidence decides; a missing declaration, suffix or host adds nothing,
and a page without any gets the most frequent language of the corpus; without any labelled document no language is known (null); ties go to the first language by name; repeated rows
are counted and judged each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premisa.llm.common import ready, written
from premisa.llm.hashing import mix, parts

SAMPLE = 2000
BUCKETS = 1 << 15
#: Trigrams depend on each other: a text counts as this many independent ones at most.
EVIDENCE = 100.0
SMOOTHING = 5.0
#: Languages whose trigram table (128 KB each) a task holds at once.
BLOCK = 64

# Parts of a page that are not its text.
HIDDEN = r"(?is)<(script|style|nav|footer|aside|header|form|title)\b.*?</\1\s*>|<!--.*?-->|<[^>]+>"


def _trigrams(data: np.ndarray) -> np.ndarray:
    x = data.astype(np.uint64)
    if len(x) < 3:
        return np.zeros(0, dtype=np.int64)
    return (mix(x[:-2] << np.uint64(16) | x[1:-1] << np.uint64(8) | x[2:]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def folded(label: Column) -> Column:
    """A language label without case, region, script and white space around it; null if nothing is left."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(label.cast("string"))), r"^([^-_]*)", 1), F.lit(""))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, b, n): how often each label's texts of a batch hold each trigram."""
    for batch in batches:
        found: dict[str, np.ndarray] = {}
        of = batch.column("label").to_pylist()
        for first, data, offsets in parts(_lowered(batch.column("text"))):
            for i in range(len(offsets) - 1):
                grams = _trigrams(data[offsets[i] : offsets[i + 1]])
                total = found.setdefault(of[first + i], np.zeros(BUCKETS, dtype=np.int64))
                total += np.bincount(grams, minlength=BUCKETS)
                if len(found) > BLOCK:
                    yield from _sparse(found)
                    found = {}
        yield from _sparse(found)


def _sparse(found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for label, total in found.items():
        b = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(b), pa.string()), pa.array(b), pa.array(total[b])], ["label", "b", "n"])


def likelihoods(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[Broadcast]]:
    """The languages, by name, and their log trigram probabilities, one row per language, sent to the tasks in blocks."""
    ready(docs.sparkSession)
    known = docs.select(folded(F.col("lang")).alias("label"), "doc_id", F.col("text").cast("string").alias("text"))
    known = known.where("label is not null and text is not null")
    counts = written(known.groupBy("label").agg(F.count("*").alias("of")), "labels")
    languages = sorted(r["label"] for r in counts.select("label").collect())
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < F.least(F.lit(1.0), F.lit(sample) / F.col("of")) * (1 << 20)
    found = known.join(counts, "label").where(drawn).select("label", "text").mapInArrow(_counted, "label string, b long, n long")
    found = written(found.groupBy("label", "b").agg(F.sum("n").alias("n")), "trigrams")
    model = []
    for start in range(0, len(languages), BLOCK):
        block = languages[start : start + BLOCK]
        table = np.full((len(block), BUCKETS), 0.5)
        part = found.where(F.col("label").isin(block)).toArrow()  # at most BLOCK * BUCKETS rows
        rows = pc.index_in(part.column("label"), pa.array(block, pa.string())).to_numpy()
        table[rows, part.column("b").to_numpy()] += part.column("n").to_numpy()
        model.append(docs.sparkSession.sparkContext.broadcast(np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)))
    return languages, model


def _scores(sent: Broadcast, kept: list[str]):
    """Adds the tempered log-likelihoods of the languages of one block to ``fit``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            fits = np.zeros((batch.num_rows, len(table)))
            for first, data, offsets in parts(_lowered(batch.column("text"))):
                grams = _trigrams(data)
                low = np.minimum(offsets[:-1], len(grams))
                high = np.clip(offsets[1:] - 2, low, len(grams))
                temper = np.minimum(1.0, EVIDENCE / np.maximum(high - low, 1))
                for k, row in enumerate(table):
                    sums = np.concatenate([[0.0], np.cumsum(row[grams], dtype=np.float64)])
                    fits[first : first + len(low), k] = (sums[high] - sums[low]) * temper
            before = batch.column("fit").flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else fits
            fits = np.concatenate([before, fits], axis=1)
            n = fits.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, batch.num_rows * n + 1, n, dtype=np.int32)), pa.array(fits.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], [*kept, "fit"])

    return score


def scored(rows: DataFrame, model: list[Broadcast]) -> DataFrame:
    """``rows`` (id columns and ``text``) with ``fit``, the tempered log-likelihood of each language, instead of text."""
    ready(rows.sparkSession)
    rows = rows.withColumn("fit", F.array().cast("array<double>"))
    for i, sent in enumerate(model):
        kept = [c for c in rows.columns if c != "fit" and (c != "text" or i + 1 < len(model))]
        rows = rows.mapInArrow(_scores(sent, kept), T.StructType([*[rows.schema[c] for c in kept], rows.schema["fit"]]))
    return rows.drop("text")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages as (kind, id, declared, suffix, host, domain, text)."""
    html, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.lower(F.col("url").cast("string"))
    host = F.nullif(F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    folder = F.regexp_extract(url, r"^[^:]+://[^/]+/([a-z]{2})(?:/|$|[?#])", 1)
    declared = F.lower(F.regexp_extract(html, r"(?is)<html[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return pages.select(
        F.lit("page").alias("kind"), F.col("page_id").cast("long").alias("id"), F.nullif(declared, F.lit("")).alias("declared"),
        F.concat_ws("/", F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1), F.nullif(folder, F.lit(""))).alias("suffix"),
        host.alias("host"), F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"),
        F.regexp_replace(html, HIDDEN, " ").alias("text"),
    ).withColumn("suffix", F.nullif(F.col("suffix"), F.lit("")))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as the same: their lang is a declaration, their source the host; they have no address."""
    missing = F.lit(None).cast("string")
    return docs.select(
        F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id"), folded(F.col("lang")).alias("declared"),
        missing.alias("suffix"), F.col("source").cast("string").alias("host"), missing.alias("domain"), F.col("text").cast("string").alias("text"),
    )


def fused(evidence: DataFrame, languages: list[str], model: list[Broadcast]) -> DataFrame:
    """kind, id, declared, text_lang, lang, probability for each row of ``evidence``."""
    if not languages:  # no labelled document: nothing to tell apart
        nothing = F.lit(None).cast("string")
        return evidence.select("kind", "id", "declared", nothing.alias("text_lang"), nothing.alias("lang"), F.lit(None).cast("double").alias("probability"))
    return combined(scored(evidence, model), languages)


def _sums(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """The elementwise sum of the arrays ``own`` of each group, as ``name``."""
    each = rows.select(*by, F.posexplode("own").alias("k", "x")).groupBy(*by, "k").agg(F.sum("x").alias("x"))
    return each.groupBy(*by).agg(F.expr("transform(array_sort(collect_list(struct(k, x))), y -> y.x)").alias(name))


def combined(rows: DataFrame, languages: list[str]) -> DataFrame:
    """What ``fused`` gives, for evidence that has ``fit`` already."""
    n = len(languages)
    top = "array_max(fit)"
    rows = rows.withColumn("own", F.expr(f"transform(fit, x -> exp(x - {top}))"))
    rows = rows.withColumn("own", F.expr("transform(own, x -> x / aggregate(own, 0D, (a, y) -> a + y))"))
    rows = written(rows, "languages")
    total = (_sums(rows, [], "total").first() or [None])[0] or [0.0] * n
    corpus = [(x + 1.0) / (sum(total) + n) for x in total]
    table = rows
    for level in ("declared", "suffix", "domain", "host"):
        by = ["kind", level]
        table = table.join(_sums(rows.where(F.col(level).isNotNull()), by, f"{level}_n"), by, "left")
    for level in ("declared", "suffix", "domain", "host"):  # without the row's own share
        table = table.withColumn(f"{level}_n", F.expr(f"zip_with({level}_n, own, (a, b) -> greatest(a - b, 0D))"))
    prior = f"array({', '.join(f'{x!r}D' for x in corpus)})"
    size = lambda c: f"aggregate({c}, 0D, (a, x) -> a + x)"
    table = table.withColumn("prior", F.expr(prior))
    for level in ("domain", "host"):  # each level smoothed with the one above it
        table = table.withColumn("prior", F.expr(
            f"if({level}_n is null, prior, zip_with({level}_n, prior, (a, p) -> (a + {SMOOTHING}D * p) / ({size(f'{level}_n')} + {SMOOTHING}D)))"))
    table = table.withColumn("post", F.expr("zip_with(fit, prior, (x, p) -> x + ln(p))"))
    for level in ("declared", "suffix"):  # chance of the sign in a language, by its share among the sign's rows
        table = table.withColumn("post", F.expr(
            f"if({level}_n is null, post, zip_with(post, zip_with({level}_n, {prior}, (a, p) -> ln((a + {SMOOTHING}D * p) / ({size(f'{level}_n')} + {SMOOTHING}D)) - ln(p)), (x, y) -> x + y))"))
    table = table.withColumn("post", F.expr("transform(post, x -> exp(x - array_max(post)))"))
    names = F.array(*[F.lit(x) for x in languages])
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return table.select(
        "kind", "id", "declared", best(F.col("own")).alias("text_lang"), best(F.col("post")).alias("lang"),
        F.round(F.array_max("post") / F.expr(size("post")), 6).alias("probability"),
    )


def identified(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The language of every page and document: page_id or doc_id, declared, text_lang, lang, probability."""
    languages, model = likelihoods(docs)
    found = fused(page_evidence(pages).unionByName(document_evidence(docs)), languages, model)
    return found.select(
        F.expr("if(kind = 'page', id, null)").alias("page_id"), F.expr("if(kind = 'document', id, null)").alias("doc_id"),
        "declared", "text_lang", "lang", "probability",
    )
