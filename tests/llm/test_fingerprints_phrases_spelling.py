"""Fingerprints, phrases and spelling variants against plain Python, on small and odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardlog.llm import one_permutation, phrases, spelling

DOCS = "doc_id long, text string"


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def plain_fingerprint(hashes):
    """The packed bins of one text, from its shingle hashes."""
    bins = {}
    for h in hashes:
        b, v = h % one_permutation.BINS, (h % 2**64) >> 11
        bins[b] = min(v, bins.get(b, v))
    values = []
    for i in range(one_permutation.BINS if bins else 0):
        at = next(b for b in [i, *(one_permutation.asked(i, t) for t in range(one_permutation.BINS))] if b in bins)
        values.append(bins[at] % (1 << one_permutation.LOW_BITS))
    whole = len(values) // 8 * 8
    # The last long is filled from its right end.
    return "".join(f"{v:02x}" for v in values[:whole]) + "".join(f"{v:02x}" for v in values[whole:]).rjust(16 if bins else 0, "0")


def test_fingerprints_are_those_of_plain_python(spark):
    rng = random.Random(1)
    texts = ["", None, " .. ", "one", "one two", "a b c d e", "É日本 ü ß x y z"] + [prose(rng, rng.choice([7, 30, 300, 3000]), "ab cd ef gh ij kl mn op".split()) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    hashed = one_permutation.add_fingerprint(df, F.col("text"), "fp").select(
        one_permutation.shingles_of(one_permutation.words_of(F.col("text"))).alias("s"), one_permutation.hex_of(F.col("fp")).alias("fp")
    )
    for r in hashed.collect():
        assert r.fp == plain_fingerprint(r.s)


def test_likeness_is_near_the_share_of_common_shingles(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    rows, want = [], []
    for share in (0.0, 0.3, 0.8, 1.0):
        for n in (40, 400, 2000):
            a = [rng.choice(words) for _ in range(n)]
            b = a[: int(n * share)] + [rng.choice(words) for _ in range(n - int(n * share))]
            grams = [{tuple(x[i : i + 5]) for i in range(n - 4)} for x in (a, b)]
            rows.append((" ".join(a), " ".join(b)))
            want.append(len(grams[0] & grams[1]) / len(grams[0] | grams[1]))
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    df = one_permutation.add_fingerprint(one_permutation.add_fingerprint(df, F.col("a"), "x"), F.col("b"), "y")
    got = [r.v for r in df.select(one_permutation.likeness(F.col("x"), F.col("y")).alias("v")).collect()]
    assert np.abs(np.array(got) - want).max() < 0.13
    assert [g for g, w in zip(got, want) if w == 1] == [1.0] * 3


@pytest.mark.parametrize("chunk_rows", [1, 3, 256])
def test_edited_texts_follow_the_ids_downwards(spark, chunk_rows, monkeypatch):
    rng = random.Random(3)
    docs = [(i * i * 7 - 50, prose(rng, rng.randrange(30), "aé b ccc dd".split())) for i in range(23)] + [(10**15, None), (-4, ""), (5, "x" * 50_000)]
    monkeypatch.setattr(one_permutation.with_next, "__defaults__", (chunk_rows, 8192))
    got = {r.id: r for r in one_permutation.compare_edited(spark.createDataFrame([*docs, (5, "x" * 50_000), (None, "abcd")], DOCS)).collect()}
    order = sorted(docs, reverse=True)
    assert len(got) == len(docs) + 1
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        assert (got[i].n_chars, got[i].edited) == (len(text), text[: len(text) - half] + following[:half])
    assert (got[None].edited, got[None].near_next) == ("ab", 0.0)


def test_fingerprints_of_odd_tables(spark):
    one = spark.createDataFrame([(1, "a b c d e f", "x", 2)], "doc_id long, text string, fingerprint string, chunk int")
    r = one_permutation.compare_edited(one).collect()[0]
    assert (r.edited, r.near_next) == ("a b c a b c", 1.0)
    assert one_permutation.compare_edited(one.limit(0)).count() == 0
    two = spark.createDataFrame([(3, "p q"), (3, "r s"), (1, "t u")], DOCS)
    assert sorted(r.edited for r in one_permutation.compare_edited(two).collect()) == ["p r", "r t", "t p"]


def plain_phrases(docs, least, longest):
    found, totals = Counter(), Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\n-\r]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(w)
            found.update((lang or "und", k, " ".join(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return {(*key, n) for key, n in found.items() if n >= least} | {(lang, 0, "", n) for lang, n in totals.items()}


@pytest.mark.parametrize("filter_bits, sample, lowered", [(16, 8, 0.4), (6, 3, 0.1), (16, 10**6, 0.4), (16, 4, 50.0)])
def test_phrases_are_counted_whole(spark, filter_bits, sample, lowered):
    rng = random.Random(4)
    docs = [(prose(rng, rng.randrange(60), ["the", "The", "a.", "b", "é,", "c\td", "x\x1cy", "new\nyork", "q!"]), rng.choice(["en", "de", None])) for _ in range(120)]
    docs += [(None, "en"), ("", None), ("of the day " * 400, "en"), ("in fine " * 30, "fr")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, text string, lang string")
    got = phrases.frequent_phrases(df, least=12, sample=sample, lowered=lowered, filter_bits=filter_bits, block_bytes=500).collect()
    want = plain_phrases(docs, 12, 5)
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got if r.k or r.n} == {w for w in want if w[1] or w[3]}


def test_phrases_missed_by_the_sample_take_a_further_pass(spark, monkeypatch):
    passes = []
    count = phrases.count_phrases
    monkeypatch.setattr(phrases, "count_phrases", lambda *a, **k: passes.append(1) or count(*a, **k))
    df = spark.createDataFrame([(i, "a b c d e f", "en") for i in range(20)], "doc_id long, text string, lang string")
    got = phrases.frequent_phrases(df, least=20, sample=10**9).where("k = 5").collect()
    assert [(r.phrase, r.n) for r in sorted(got)] == [("a b c d e", 20), ("b c d e f", 20)]
    # the sample, the words, and all that these open up
    assert len(passes) == 3


def test_collocations_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, k string, phrase string")
    assert phrases.collocations(phrases.frequent_phrases(empty)).count() == 0
    found = [("en", 0, "", 10**15), ("en", 1, "a", 10**13), ("en", 1, "b", 10**13), ("en", 2, "a b", 10**13)]
    rows = phrases.collocations(spark.createDataFrame(found, "lang string, k int, phrase string, n long")).collect()
    assert [(r.rank, r.a, r.n, r.score) for r in rows] == [(1, 10**13, 10**15, 100_000)]


def plain_words(docs, every=31):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain_variants(words, times=10):
    letters = {c for w in words for c in w}
    near = {}
    for w in words:
        cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        near[w] = ({a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters}) & set(words) - {w}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] is not None else None))
    return out


@pytest.mark.parametrize("depth, chunk", [(None, 1 << 15), (1, 7), (3, 50), (5, 1 << 15)])
def test_variants_are_those_of_plain_python(spark, depth, chunk):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abeéÿtn") for _ in range(rng.randrange(6, 11))) for _ in range(40)] + ["a" * 100, "a" * 99, "a" * 70 + "b" * 29]
    words = {}
    for s in stems:
        words[s] = rng.choice([2, 30, 500, 10_000])
        for _ in range(12):
            i = rng.randrange(len(s))
            words[rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice("abé") + s[i:], s[:i] + rng.choice("tnÿ") + s[i + 1 :], s[:i] + s[i + 1 :][::-1]])] = rng.choice([2, 3, 40, 600])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.variants(df, depth=depth, chunk=chunk).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len(words)
    assert {tuple(r) for r in got} == plain_variants(words)


def test_words_with_slips(spark):
    rng = random.Random(6)
    pool = ["Straßen", "wörterbuch", "ABCDEFGH", "Éclairées", "question", "qu×stion", "sixsix", "x" * 3000]
    docs = [(rng.randrange(5), " ,1".join(rng.choice(pool) for _ in range(30))) for _ in range(60)] + [(None, "question question"), (1, None), (2, "")]
    df = spark.createDataFrame([(*d, "y") for d in docs], "doc_id long, text string, word string")
    assert {r.word: r.n for r in spelling.words_with_slips(df).collect()} == plain_words(docs)
    assert spelling.variants(spelling.words_with_slips(df.limit(0))).count() == 0


def test_one_edit():
    for a, b, near in [("abc", "abc", 0), ("abc", "abd", 1), ("abc", "ab", 1), ("ab", "abc", 1), ("abc", "xabc", 1), ("abc", "bac", 0), ("abc", "a", 0), ("aab", "ab", 1)]:
        a, b = a.encode(), b.encode()
        assert spelling.one_edit(a, b) == bool(near)
        assert spelling.verified(spelling.Words(pa.array([a.decode(), b.decode()])), np.array([0]), np.array([1]))[0] == bool(near)


def test_edited_text_digest(spark):
    r = one_permutation.compare_edited(spark.createDataFrame([(2, "héllo"), (1, "wörld")], DOCS)).where("id = 2").select(F.sha2("edited", 256)).first()[0]
    assert r == hashlib.sha256("hélwö".encode()).hexdigest()
