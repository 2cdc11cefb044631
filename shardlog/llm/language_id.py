"""Language of web pages by Bayesian fusion of four kinds of evidence.

Likelihoods of the visible text under byte-trigram models of each language, the
language that the markup declares, the suffix of the address, and a prior of the host
that leans on its domain, and that on all pages. What a declaration or a suffix says,
and what hosts hold, is counted over all pages in grouped aggregations, by the
language their text alone points to; a page's own count is taken out again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlog.llm.common import extended, map_blocks, narrow, shifted_sums, texts_of
from shardlog.session import store

BLOCK_BYTES = 2 << 20
BUCKET_BITS = 14
# A model is a row of 2^14 numbers for each language; more languages are refused.
MOST_LANGUAGES = 256
# Trigrams overlap and depend on each other: a text counts as this many at most.
TEXT_EVIDENCE = 60.0
# Pages that a domain's, and a host's, parent counts for.
DOMAIN_PAGES, HOST_PAGES = 20.0, 5.0
# Pseudo-count of a declaration or suffix under each language.
SMOOTHING = 0.5

# What may begin something hidden, and where a script or style ends.
_HIDING = re.compile(rb"<(!--|(?:script|style)\b)?|&[#a-z0-9]{1,10};", re.I)
_ENTITY = re.compile(rb"&[#a-z0-9]{1,10};", re.I)
_CLOSING = {name: re.compile(rb"</" + name + rb"\s*>", re.I) for name in (b"script", b"style")}
_HTML = re.compile(rb"<html\b", re.I)
_LANG = re.compile(rb"\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", re.I)


@dataclass
class TextModel:
    languages: list[str]
    log_prob: np.ndarray  # (languages, buckets)


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """A bucket for the three bytes from each place on, but the last two places."""
    x = data.astype(np.uint32)
    return ((x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)) >> np.uint32(
        32 - BUCKET_BITS
    )


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts end to end with two blanks after each, and their starts."""
    low = [t.lower() for t in texts]
    starts = shifted_sums(np.array([len(t) + 2 for t in low], dtype=np.int64))
    return np.frombuffer(b"".join(t + b"  " for t in low), dtype=np.uint8), starts


class _Ends:
    """Ends of what is hidden in a text. What is not found from one place on is not
    looked for again from a later one, so all searches together read the text a few times."""

    def __init__(self, html: bytes):
        self.html, self.missing = html, set()

    def after(self, what: bytes, at: int) -> int | None:
        """The place after the next ``what``: a script's or style's closing tag, or a mark."""
        if what in self.missing:
            return None
        if what in _CLOSING:
            found = _CLOSING[what].search(self.html, at)
            end = found.end() if found else None
        else:
            place = self.html.find(what, at)
            end = None if place < 0 else place + len(what)
        if end is None:
            self.missing.add(what)
        return end


def visible_text(html: bytes) -> bytes:
    """The text without tags, comments, scripts, styles and entities, its blanks merged.

    A comment, script or style that is not closed is a tag; a tag that is not closed is
    text. The time taken grows with the length of the text, whatever is in it.
    """
    ends, shown, at = _Ends(html), [], 0
    while opened := _HIDING.search(html, at):
        begin, name, end = opened.start(), opened[1], None
        if opened[0].startswith(b"&"):
            end = opened.end()
        elif name:
            end = ends.after(b"-->" if name == b"!--" else name.lower(), opened.end())
        if end is None:
            end = ends.after(b">", begin + 1)
        if end is None:  # no tag ends from here on
            break
        shown.append(html[at:begin])
        at = end
    shown.append(_ENTITY.sub(b" ", html[at:]))
    return b" ".join(b" ".join(shown).split())


def declared_language(html: bytes) -> str | None:
    """The language that the first html tag with one declares."""
    at = 0
    while opened := _HTML.search(html, at):
        # A later tag that begins before this one's end lies inside it.
        end = html.find(b">", opened.end())
        end = len(html) if end < 0 else end
        found = _LANG.search(html, opened.end(), end)
        if found:
            return found[1].decode().lower()
        at = end
    return None


def _count_block(block: pa.RecordBatch) -> pa.RecordBatch:
    """Trigram counts of a block, one row for each (language, bucket) that occurs."""
    langs, owner = np.unique(np.array(block.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
    data, starts = _joined(texts_of(block))
    buckets = trigram_buckets(data).astype(np.int64)
    of = np.repeat(owner, np.diff(starts))[: len(buckets)]
    counts = np.bincount(of * (1 << BUCKET_BITS) + buckets, minlength=len(langs) << BUCKET_BITS)
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_pydict(
        {"lang": pa.array(langs[at >> BUCKET_BITS].tolist(), pa.string()), "bucket": pa.array(at & ((1 << BUCKET_BITS) - 1)), "n": pa.array(counts[at])}
    )


def train_text(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text") -> TextModel:
    """Trigram models of the languages of ``docs``, counted over all its rows. Rows
    without a language are no examples; a null text has no trigrams."""
    rows = narrow(docs, lang=lang_col, text=text_col).where("lang is not null")
    counts = map_blocks(rows, "text", BLOCK_BYTES, "lang string, bucket long, n long", _count_block).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = store(counts, "trigrams")
    languages = sorted(r.lang for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.full((len(languages), 1 << BUCKET_BITS), 0.5)
    # At most languages x buckets rows, both bounded.
    for r in counts.toLocalIterator():
        table[languages.index(r.lang), r.bucket] += r.n
    return TextModel(languages, np.log(table / table.sum(1, keepdims=True)).astype(np.float32))


def text_evidence(texts: list[bytes], model: TextModel, weight: float = TEXT_EVIDENCE) -> np.ndarray:
    """Tempered log-likelihoods (texts, languages); zeros for texts of no trigram. A
    text counts as ``weight`` trigrams at most, all of its trigrams alike."""
    if not texts or not model.languages:
        return np.zeros((len(texts), len(model.languages)))
    data, starts = _joined(texts)
    buckets = trigram_buckets(data)
    # Trigrams inside a text, its end included; none of an empty one.
    sizes = np.maximum(np.diff(starts) - 2, 0)
    out = np.zeros((len(texts), len(model.languages)))
    for i, row in enumerate(model.log_prob):
        sums = np.concatenate([[0.0], np.cumsum(row[buckets], dtype=np.float64)])
        out[:, i] = sums[starts[:-1] + sizes] - sums[starts[:-1]]
    return out * np.minimum(1, weight / np.maximum(sizes, 1))[:, None]


def _read_block(block: pa.RecordBatch, model: TextModel, weight: float) -> pa.RecordBatch:
    pages = texts_of(block, "html")
    evidence = text_evidence([visible_text(p) for p in pages], model, weight)
    best = [model.languages[i] for i in evidence.argmax(1)] if model.languages else [None] * len(pages)
    return pa.RecordBatch.from_pydict(
        {
            **{c: block.column(c) for c in ("id", "host", "domain", "suffix")},
            "declared": pa.array([declared_language(p) for p in pages], pa.string()),
            "evidence": pa.array(list(evidence), pa.list_(pa.float64())),
            "text_lang": pa.array([b if e.any() else None for b, e in zip(best, evidence)], pa.string()),
        }
    )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _tally(pages: DataFrame, by: str, languages: list[str]) -> DataFrame:
    """How many pages of each language by their text, for each value of ``by``."""
    counts = [F.sum((F.col("text_lang") == lang).cast("double")) for lang in languages]
    named = F.array(*[F.coalesce(c, F.lit(0.0)) for c in counts]) if languages else F.array().cast("array<double>")
    # Written down, so that the join has its own shuffle, which can be split.
    return store(pages.where(F.col(by).isNotNull()).groupBy(by).agg(named.alias(f"{by}_tally")), f"{by}-tally")


def identify(
    pages: DataFrame, model: TextModel, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", text_weight: float = TEXT_EVIDENCE
) -> DataFrame:
    """Per page: id, language, probability, text_lang, declared, suffix, host and
    posterior (one probability for each of ``model.languages``). The likelihood of a
    text is that of all its trigrams, tempered to ``text_weight`` of them, as they overlap.

    A null or empty html has no text evidence and declares nothing; a null address, or
    one without a host, has no suffix and the prior of all pages. Ties go to the
    language that sorts first. Equal rows each count as a page. Without languages in
    the model the language is null.
    """
    languages = model.languages
    host = host_of(F.col("url"))
    labels = F.split("host", r"\.")
    rows = narrow(pages, id=id_col, url=url_col, html=html_col).select("id", F.nullif(host, F.lit("")).alias("host"), "html")
    rows = rows.select(
        "id", "host", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".").alias("domain"), F.element_at(labels, -1).alias("suffix"), "html"
    )
    read = store(
        map_blocks(
            rows, "html", BLOCK_BYTES, extended(rows, "declared string, evidence array<double>, text_lang string", without=("html",)),
            lambda b: _read_block(b, model, text_weight),
        ),
        "pages",
    )
    if not languages:
        return read.select(
            "id", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"), "text_lang", "declared", "suffix", "host", F.array().cast("array<double>").alias("posterior")
        )
    total = [F.sum((F.col("text_lang") == lang).cast("double")) for lang in languages]
    overall = [float(x or 0) for x in read.agg(*total).first()]
    joined = read
    for by in ("host", "domain", "suffix", "declared"):
        joined = joined.join(_tally(read, by, languages), by, "left")
    own = F.array(*[F.coalesce((F.col("text_lang") == lang).cast("double"), F.lit(0.0)) for lang in languages])
    everyone = F.array(*[F.lit(x) for x in overall])

    def others(tally: Column) -> Column:
        """A tally without the page itself."""
        return F.zip_with(tally, own, lambda n, o: n - o)

    def sum_of(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def leaning(tally: Column, parent: Column, pages_of_parent: float) -> Column:
        """Shares of a tally, with its parent's as so many pages more."""
        n = sum_of(tally)
        return F.zip_with(tally, parent, lambda c, p: (c + pages_of_parent * p) / (n + pages_of_parent))

    spoken_by = others(everyone)
    n_all = sum_of(spoken_by)
    base = F.transform(spoken_by, lambda c: (c + SMOOTHING) / (n_all + SMOOTHING * len(languages)))
    # Step by step, so that no expression is worked out again inside the next.
    step = joined.withColumn("base", base).withColumn("spoken_by", spoken_by)
    step = step.withColumn("domain_prior", F.when(F.col("domain_tally").isNull(), F.col("base")).otherwise(leaning(others(F.col("domain_tally")), F.col("base"), DOMAIN_PAGES)))
    step = step.withColumn("prior", F.when(F.col("host_tally").isNull(), F.col("domain_prior")).otherwise(leaning(others(F.col("host_tally")), F.col("domain_prior"), HOST_PAGES)))

    def says(tally: str) -> Column:
        """Log probability of the page's value under each language."""
        share = F.zip_with(others(F.col(tally)), F.col("spoken_by"), lambda c, n: F.log((c + SMOOTHING) / (n + 2 * SMOOTHING)))
        return F.when(F.col(tally).isNull(), F.array_repeat(F.lit(0.0), len(languages))).otherwise(share)

    fused = F.transform(F.col("prior"), lambda p: F.log(p))
    for more in (F.col("evidence"), says("suffix_tally"), says("declared_tally")):
        fused = F.zip_with(fused, more, lambda a, b: a + b)
    step = step.withColumn("fused", fused)
    raised = F.transform(F.col("fused"), lambda x: F.exp(x - F.array_max("fused")))
    step = step.withColumn("raised", raised).withColumn("mass", sum_of(F.col("raised")))
    step = step.withColumn("posterior", F.transform("raised", lambda x: x / F.col("mass")))
    names = F.array(*[F.lit(lang) for lang in languages])
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return step.select(
        "id", F.element_at(names, best).alias("language"), F.array_max("posterior").alias("probability"), "text_lang", "declared", "suffix", "host", "posterior"
    )
