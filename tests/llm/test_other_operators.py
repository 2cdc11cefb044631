"""Archives, vectors, languages and segmentations against brute force."""

import gzip
import hashlib
import math
import re
import time
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shardlog.llm import language_id, segmentation, topk, warc
from shardlog.llm.common import table
from shardlog.llm.piece_lattice import Lattices, Units, Vocabulary
from shardlog.llm.polyhash import mixed
from shardlog.llm.queries import QUERIES as LLM
from shardlog.session import scratch_path

LONG = "<p>" + "é" * 200


def test_archives_keep_every_payload(spark):
    rows = [(1, "http://a/ b\r\n", LONG), (2, None, LONG), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", LONG), (6, "u", "WARC/1.1\r\n\r\n" * 20), (1, "x", LONG)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = Counter((r.id, r.payload_bytes, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode()) for r in warc.round_trip(pages, with_payload=True).collect())
    n = len(LONG.encode())
    assert got == Counter(
        [(1, n, "response", None, LONG), (1, n, "response", None, LONG), (2, n, "revisit", 1, None), (None, n, "revisit", 1, None), (3, 0, "response", None, ""),
         (4, 5, "response", None, "short"), (5, 5, "response", None, "short"), (6, 240, "response", None, "WARC/1.1\r\n\r\n" * 20)]
    )
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_normaliser_takes_monolithic_and_split_streams(spark, tmp_path):
    records = [warc.encode_record(str(i), "u", b"x" * i * 1000, i * 1000, __import__("hashlib").sha256(b"x" * i * 1000).hexdigest(), None) for i in range(5)]
    (tmp_path / "a").write_bytes(gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join(records[3:])))
    manifest = spark.createDataFrame([(str(tmp_path / "a"),)], "path string")
    folder = scratch_path(spark, "t")
    done = warc.normalise(manifest, folder)
    assert done.first().n_records == 5
    assert sorted(r.id for r in warc.read_archives(done, folder).collect()) == list("01234")
    (tmp_path / "b").write_bytes(gzip.compress(b"".join(records))[:-20])
    with pytest.raises(Exception, match="ends inside"):
        warc.normalise(spark.createDataFrame([(str(tmp_path / "b"),)], "path string"), folder)


@pytest.mark.parametrize("values", [1 << 20, 100])
def test_top_k_equals_all_products(spark, values):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan"), 0.0, 0.0, 0.0]), (203, [float("inf")] * 4), (None, [1.0] * 4), (204, [1.0, 2.0]), (205, [1.0]), (0, rows[0][1])]
    # Equal rows with the greatest products of all: each copy takes a place.
    rows += [(301, [9.0, 9.0, -9.0, 9.0])] * 3 + [(302, [-9.0, 9.0, 9.0, 9.0])] * 7
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, norm int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, pivots=5, query_values=values).collect()}
    whole = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = {}
    for q, v in set(whole):
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
            want |= {(q, n): (i, -s) for n, (s, i) in enumerate(scored[:5], start=1)}
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_products_that_are_not_exact_are_refused(spark):
    df = spark.createDataFrame([(10, [3e17, 0.0]), (11, [1e17, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exact below"):
        topk.top_k(df, F.col("vec_id") % 10 == 0).collect()


def test_languages(spark, sf_dir):
    model = language_id.train_text(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = language_id.identify(pages, model).collect()
    assert np.mean([r.language == r.declared for r in got]) >= 0.98
    assert all(abs(sum(r.posterior) - 1) < 1e-9 and r.probability == max(r.posterior) for r in got)


def test_language_evidence_is_fused_as_stated(spark):
    docs = spark.createDataFrame([("en", "the thing is the other"), ("de", "der die das und nicht"), (None, "x"), ("de", None)], "lang string, text string")
    model = language_id.train_text(docs)
    assert model.languages == ["de", "en"]
    rows = [(i, "http://a.b.de/x", "<html lang='de'>und nicht das") for i in range(6)] + [(6, "http://a.b.de/x", "<html lang=de>"), (7, "http://c.com", "the other thing"), (8, None, None), (9, "nonsense", "<html lang=en>the thing")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    got = {r.id: r for r in language_id.identify(pages, model).collect()}
    # Page 6 has no words: declaration, suffix and host tell.
    n = [6.0, 2.0]  # pages by text: page 8 and 6 have none
    base = [(c + 0.5) / (sum(n) + 1.0) for c in n]
    domain = [(c + 20 * p) / (6 + 20) for c, p in zip((6, 0), base)]
    prior = [(c + 5 * p) / (6 + 5) for c, p in zip((6, 0), domain)]
    says = [(c + 0.5) / (m + 1.0) for c, m in zip((6, 0), n)]
    mass = [p * s * s for p, s in zip(prior, says)]
    assert got[6].language == "de" and got[6].text_lang is None and abs(got[6].probability - mass[0] / sum(mass)) < 1e-9
    assert got[7].language == "en" and got[8].language == "de" and abs(got[8].probability - base[0] / sum(base)) < 1e-9
    assert got[9].declared == "en" and got[9].suffix is None
    assert language_id.identify(pages.limit(0), model).count() == 0
    assert language_id.identify(pages, language_id.train_text(docs.limit(0))).first().language is None


@pytest.fixture(scope="module")
def flat():
    """Scores that differ little, so that many segmentations are likely."""
    return Vocabulary(segmentation.MODEL, 1e-5)


def all_segmentations(text, vocabulary):
    units = Units([text], vocabulary)
    lattices = Lattices(units.codes, units.sizes, vocabulary)

    def paths(unit, at):
        if at == lattices.begin[unit + 1]:
            yield ()
            return
        for e in range(lattices.first[at], lattices.first[at + 1]):
            for rest in paths(unit, at + int(lattices.length[e])):
                yield (e, *rest)

    out = {}
    for choice in product(*[list(paths(u, int(lattices.begin[u]))) for u in units.number]):
        edges = [e for path in choice for e in path]
        ids = [int(i) for e in edges for i in lattices.ids[lattices.id_at[e] : lattices.id_at[e] + lattices.n_ids[e]]]
        out[tuple(ids)] = math.exp(lattices.log_p[edges].sum())
    return out


def test_lattice_holds_every_segmentation(flat):
    text = "then, a\nab"
    exact = all_segmentations(text, flat)
    pieces = {flat.bytes_of[i].decode(): i for i in flat.ids.tolist()}
    whole = "▁" + text.replace(" ", "▁")

    def split(at):
        if at == len(whole):
            yield ()
        if whole[at : at + 1] == "\n":
            yield from ((int(flat.byte_ids[10]), *rest) for rest in split(at + 1))
        for end in range(at + 1, len(whole) + 1):
            if whole[at:end] in pieces:
                yield from ((pieces[whole[at:end]], *rest) for rest in split(end))

    assert set(exact) == set(split(0)) and abs(sum(exact.values()) - 1) < 1e-9


@pytest.mark.parametrize("nodes", [16, 1])
def test_samples_are_drawn_without_replacement(flat, nodes):
    text, n = "a then, an", 12_000
    exact = all_segmentations(text, flat)
    samples = segmentation.encode_block([text] * n, mixed(np.arange(n, dtype=np.uint64)), 3, flat, nodes)
    ids = [[tuple(s["ids"][a:b].tolist()) for a, b in zip(s["cuts"], s["cuts"][1:])] for s in samples]
    assert all(len({a, b, c}) == 3 for a, b, c in zip(*ids))
    assert (samples[0]["perturbed"] > samples[1]["perturbed"]).all() and (samples[1]["perturbed"] > samples[2]["perturbed"]).all()
    first, second = Counter(ids[0]), Counter(ids[1])
    for seg, p in exact.items():
        assert abs(first[seg] / n - p) < 5 * math.sqrt(p / n) + 1e-3
        q = sum(a * p / (1 - a) for s, a in exact.items() if s != seg)
        assert abs(second[seg] / n - q) < 5 * math.sqrt(q / n) + 1e-3
    # Inclusion scores weigh samples so that their sums estimate sums over all segmentations.
    weights = sum(np.exp(s["log_prob"] - s["log_inclusion"]) for s in samples)
    assert abs(weights.mean() - 1) < 0.02


def test_samples_run_out(flat):
    exact = all_segmentations("the", flat)
    # Some pieces of the model have a score of minus a billion: no probability is left.
    possible = sum(p > 0 for p in exact.values())
    samples = segmentation.encode_block(["the", "", "\n"], np.arange(3, dtype=np.uint64), len(exact) + 2, flat, 2)
    assert [int(sum(s["alive"][t] for s in samples)) for t in range(3)] == [possible, 1, 1]
    assert samples[0]["log_inclusion"][0] == 0


def test_segmentations_of_odd_rows(spark):
    texts = [None, "", " ", "  lead", "tail \n", "日本語 💥\u0001", "a▁b", "x" * 5000, "the " * 3000, "\r\n\t"]
    docs = spark.createDataFrame([(None if i == 1 else i, t, "r") for i, t in enumerate(texts)], "doc_id long, text string, rank string")
    rows = segmentation.segmentations(docs, with_ids=True).collect()
    assert all(r.round_trip for r in rows) and {r.id for r in rows} == {None, 0, *range(2, 10)}
    assert all(sum(r.id == i for r in rows) == 2 for i in (3, 7, 8)) and sum(r.id == 0 for r in rows) == 1
    again = segmentation.segmentations(docs.repartition(3)).collect()
    assert sorted(r.ids_sha256 for r in again) == sorted(r.ids_sha256 for r in rows)
    assert segmentation.segmentations(docs.limit(0)).count() == 0


def test_a_declared_language_is_found_wherever_it_stands():
    late = b"<!-- " + b"x" * 10_000 + b' --><html class="a" lang="de-AT">'
    assert language_id.declared_language(late) == "de"
    assert language_id.declared_language(b"x" * 10_000) is None


@pytest.mark.parametrize("run", [LLM["op3_sentencepiece"], lambda spark, sf_dir: corpus_pipeline.tokens(spark, table(spark, sf_dir, "documents"), sf_dir)])
def test_results_hold_the_piece_ids(spark, sf_dir, run):
    rows = run(spark, sf_dir).collect()
    assert rows and all(len(r.ids) == r.n_pieces for r in rows)
    assert all(r.ids_sha256 == hashlib.sha256(np.array(r.ids, dtype="<i4").tobytes()).hexdigest() for r in rows)


def test_any_text_may_be_the_id_of_a_record(spark):
    ids = ["a\r\nWARC-Type: revisit", "", "b>", "50%25 é", None]
    pages = spark.createDataFrame([(i, "u", LONG) for i in ids], "page_id string, url string, html string")
    got = {r.id: (r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == {i: ("response", None) if i == "" else ("revisit", "") for i in ids}


def by_patterns(html):
    """The hidden parts as patterns, which take long on tags that are not closed."""
    hidden = re.compile(rb"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>|&[#a-z0-9]{1,10};", re.S | re.I)
    found = re.search(rb"<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", html, re.I)
    return b" ".join(hidden.sub(b" ", html).split()), found[1].decode().lower() if found else None


def test_hidden_parts_of_pages_equal_patterns():
    parts = [b"<", b">", b"<!--", b"-->", b"<script", b"</script >", b"<STYLE ", b"</style", b" ", b"x", b"&amp;", b"&", b"<html ", b"lang=", b"'de'", b" lang = en", b"</Script>", b"-", b"<!-->"]
    rnd = np.random.default_rng(3)
    for n in rnd.integers(0, 25, 4000):
        html = b"".join(parts[i] for i in rnd.integers(0, len(parts), n))
        assert (language_id.visible_text(html), language_id.declared_language(html)) == by_patterns(html), html


@pytest.mark.parametrize("piece", [b"<script ", b"<!-- ", b"<html ", b"<", b"<style></script>", b"<html lang ", b"</script   <script>"])
def test_pages_of_unclosed_tags_take_linear_time(piece):
    html = piece * (1_000_000 // len(piece))
    start = time.process_time()
    language_id.visible_text(html)
    language_id.declared_language(html)
    assert time.process_time() - start < 2
