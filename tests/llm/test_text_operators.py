"""Operators on documents against brute force, on small and odd inputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shardlog.llm import decontamination, licenses, line_crf, line_dedup, simhash, suffix_dedup
from shardlog.llm.components import connected

DOCS = "doc_id long, text string"
ODD = [(None, "a b c"), (1, None), (2, ""), (3, " \n\n "), (4, "x " * 3000), (4, "x " * 3000), (5, "é日本 ü"), (6, None)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def hits(doc, items, window):
    own, marked, found = words(doc), set(), set()
    for item_id, text in items:
        w = words(text)
        n = min(window, len(w))
        wins = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        at = [i for i in range(len(own) - n + 1) if tuple(own[i : i + n]) in wins] if n else []
        marked |= {i + k for i in at for k in range(n)}
        found |= {str(item_id)} if at and item_id is not None else set()
    return len(own), len(marked), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontamination(spark, block_bytes):
    rng = random.Random(2)

    def text(n):
        return " ".join(rng.choice("a B c, d".split()) for _ in range(n))

    items = [(i, text(rng.randrange(9))) for i in range(12)] + [(None, text(6)), (3, text(5)), (40, None), (41, "")]
    docs = ODD + [(10 + i, text(rng.randrange(40))) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_matches(spark.createDataFrame(docs, DOCS), bench, window=4, block_bytes=block_bytes).collect()
    want = Counter(map(repr, ((d, *hits(t, items, 4)) for d, t in docs)))
    assert Counter(repr((r.id, r.n_words, r.n_hit, r.item_ids)) for r in got) == want
    for r in got:
        assert all(m.n_words >= 1 and m.doc_word + m.n_words <= r.n_words for m in r.matches)


def test_decontamination_of_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_words long, matches string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontamination.decontaminate(docs, none).collect()] == [(1, "a b", 5, "x")]
    assert decontamination.decontaminate(docs.limit(0), none).count() == 0
    bench = spark.createDataFrame([(1, "A b")], "item_id long, text string")
    assert decontamination.decontaminate(docs, bench).count() == 0


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps):
    """id -> smallest id of its component, by all pairs."""
    ids, root = list(fps), {i: i for i in fps}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 3:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def test_simhash_groups_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fps = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    got = simhash.near_groups(docs).select("id", simhash.hex_of(F.col("fp")).alias("h"), "component_id", "keeper").collect()
    assert {r.id: r.h for r in got} == {i: f"{f:016x}" for i, f in fps.items()}
    want = components(fps)
    assert {r.id: r.component_id for r in got} == want
    assert {r.id for r in got if r.keeper} == set(want.values())


@pytest.mark.parametrize("group", [1 << 14, 16])
def test_links_of_dense_fingerprints(spark, group):
    rng = random.Random(4)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        fps |= {f} | {f ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 6))) for _ in range(6)}
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), depth=5, group=group)
    members = {r.node: r.root for r in connected(links).collect()}
    want = components(dict(enumerate(fps)))
    groups = Counter(want.values())
    got = Counter(members.get(s[0], s[0]) for s in signed)
    assert sorted(got.values()) == sorted(groups.values())


def test_simhash_of_odd_rows(spark):
    rows = [(*r, 7) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_groups(docs).collect()
    blank = {r.id for r in got if r.component_id == 1}
    assert blank == {1, 2, 3, 6} and len(got) == len(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "None"]
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_chains_and_stars_connect(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}


def kept_bytes(rows, length):
    seen = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest(), left))
    return out


@pytest.mark.parametrize(("length", "gram", "group"), [(12, 4, 1 << 15), (12, 4, 3), (20, 6, 1 << 15), (20, 6, 1), (40, 16, 2)])
def test_repeated_strings_equal_brute_force(spark, length, gram, group):
    rng = random.Random(length)

    def text(n):
        return "".join(rng.choice(["ab", "ba", "é", "a", "bb ", " "]) for _ in range(n))

    base = [text(40) for _ in range(6)]
    rows = ODD[:4] + [(4, "x " * 40), (4, "x " * 40)]
    for i in range(100):
        part = rng.choice(base)
        rows.append((10 + i, rng.choice([part, text(20), text(9) + part[rng.randrange(20) :] + text(5), "a" * rng.randrange(60)])))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS), length=length, gram=gram, group=group, keep_text=True).collect()
    assert Counter(repr((*r[:5], bytes(r[5]))) for r in got) == Counter(map(repr, kept_bytes(rows, length)))


def test_repeated_strings_at_frequent_grams(spark):
    """One passage in many texts, and one gram before and after different bytes."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(70))

    def text(n):
        return "".join(rng.choice("xyz") for _ in range(n))

    rows = [(i, text(rng.randrange(30)) + passage + text(rng.randrange(30))) for i in range(60)]
    rows += [(100 + i, text(20) + passage[30:50] + text(20)) for i in range(60)] + [(200 + i, passage[:35] + text(4)) for i in range(60)]
    rows += [(300 + i, rng.choice(["ab", "abc", "a"]) * rng.randrange(5, 60) + text(3)) for i in range(40)]
    for group in (1, 8):
        got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS), length=32, gram=16, group=group, keep_text=True).collect()
        assert Counter(repr((*r[:5], bytes(r[5]))) for r in got) == Counter(map(repr, kept_bytes(rows, 32)))


def test_groups_stay_whole_when_a_join_is_split(spark):
    """Adaptive execution may split a large partition of a join; the groups of a gram may not."""
    split_all = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
    }
    rng = random.Random(3)
    rows = []
    for gram in range(100):
        shared = rng.randbytes(32)
        rows += [(gram, bytes([gram, k]), 1, 0, 1, bytes([k]) + shared) for k in range(4)]
    segments = spark.createDataFrame(rows, "gram long, digest binary, place int, first int, last int, segment binary")
    before = {k: spark.conf.get(k, None) for k in split_all}
    try:
        for k, v in split_all.items():
            spark.conf.set(k, v)
        got = suffix_dedup.frequent_spans(segments, 32, 8, ()).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted((bytes(r.digest), r.start, r.stop) for r in got) == sorted((r[1], 1, 33) for r in rows)


@pytest.mark.parametrize("unit", ["a", "ab", "abcde", "0123456789" * 3, "".join(map(chr, range(33, 125)))])
def test_texts_of_one_period_have_few_anchors(unit):
    for front, back in (("", ""), ("qrst" * 3 + "!", " end of it")):
        text = np.frombuffer((front + unit * (1_000_000 // len(unit)) + back).encode(), dtype=np.uint8)
        (_, _, first, last), spans = suffix_dedup.anchors_of(text, 400, 64)
        assert int((last - first + 400).sum()) < 300_000
        assert spans and sum(b - a for a, b in spans) > 990_000


@pytest.mark.parametrize(("length", "gram"), [(12, 4), (40, 16), (400, 64)])
def test_every_string_has_an_anchor_or_is_in_a_span(length, gram):
    rng = random.Random(gram)
    for _ in range(60):
        units = ["".join(rng.choice("ab c") for _ in range(rng.randrange(1, 9))) for _ in range(4)]
        text = "".join(rng.choice(units) * rng.randrange(1, 2 * length) for _ in range(4)).encode()
        (_, _, first, last), spans = suffix_dedup.anchors_of(np.frombuffer(text, dtype=np.uint8), length, gram)
        starts = [i for a, b in zip(first.tolist(), last.tolist()) for i in range(a, b + 1)]
        seen = Counter(text[i : i + length] for i in range(len(text) - length + 1))
        inside = {i for a, b in spans for i in range(a, b - length + 1)}
        assert len(starts) == len(set(starts)) and set(starts) | inside == set(range(len(text) - length + 1))
        assert all(seen[text[i : i + length]] > 1 for i in inside)
        # Every string keeps an anchor somewhere, for other texts to meet it.
        assert {text[i : i + length] for i in starts} == set(seen)


def test_repeats_leave_no_table_and_take_odd_tables(spark):
    docs = spark.createDataFrame([(i, "abcdefgh" * 9, "x") for i in range(2)], "digest long, text string, gram string")
    before = spark.catalog.listTables()
    got = suffix_dedup.remove_repeats(docs, id_col="digest", length=20, gram=8).collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in got] == [(72, 72, 1)] * 2
    assert suffix_dedup.remove_repeats(docs.limit(0), id_col="digest").count() == 0
    assert spark.catalog.listTables() == before


def test_colliding_hashes_fall_back_to_the_bytes(monkeypatch):
    segments, groups = [b"abcdef", b"abcxyz", b"abcdef"], np.zeros(3, dtype=np.int64)
    zero = np.zeros(3, dtype=np.int64)
    want = suffix_dedup.repeated_starts(segments, zero, zero, zero, groups, 6)
    monkeypatch.setattr(suffix_dedup.Sorter, "common", lambda self, x, y, most: most)
    got = suffix_dedup.repeated_starts(segments, zero, zero, zero, groups, 6)
    assert sorted(got[0]) == sorted(want[0]) == [0, 2]


def test_lines(spark):
    rows = [(2, "a\nb\nc\nd"), (1, "x\na\nb\nc"), (3, "b\nc\nd\nq\na\nb\nc"), (4, "a\nb"), (5, None), (6, ""), (7, "\n\n\n\n"), (8, "\n\n\n\n"), (9, "a\nb\nc"), (9, "a\nb\nc")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lines int, n_chars long")
    got = {(r.id, r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {
        (2, 4, 3, "d"), (1, 4, 0, "x\na\nb\nc"), (3, 7, 6, "q"), (4, 2, 0, "a\nb"), (5, 0, 0, None), (6, 1, 0, ""), (7, 5, 0, "\n\n\n\n"), (8, 5, 0, "\n\n\n\n"), (9, 3, 3, "")
    }
    kept = line_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert {r.doc_id: r.n_chars for r in kept.collect()}[2] == 1
    assert line_dedup.without_repeats(docs.limit(0)).count() == 0


def test_licenses(spark):
    header = dict(licenses.TEMPLATES)["Apache-2.0-header"]
    split = header.split()
    edited = " ".join(["zzz", *split[:30], "oops", *split[31:]])
    docs = spark.createDataFrame(
        [*ODD, (20, "Foo. " * 30 + header), (21, edited), (22, "bar Released  under the mit license"), (23, " ".join(split[:20]))], DOCS
    )
    templates = licenses.template_table(spark)
    got = {(r.id, r.license) for r in licenses.scan(docs, templates).collect()}
    apache = {(i, name) for i in (20, 21) for name in ("Apache-2.0", "Apache-2.0-header")}
    assert got == apache | {(22, "MIT"), (23, "Apache-2.0")}
    assert {(r.id, r.license) for r in licenses.scan(docs, templates, lookup=10).collect()} == got
    assert licenses.scan(docs, templates.limit(0)).count() == 0 and licenses.scan(docs.limit(0), templates).count() == 0
    with pytest.raises(ValueError, match="fewer"):
        licenses.scan(docs, spark.createDataFrame([("short", "one two")], "license string, text string"))


def test_license_scan_has_no_python(spark, sf_dir):
    from shardlog.llm.queries import QUERIES

    for name in ("op4_license_scan", "op10_line_dedup"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def brute_marginals(emit, moves):
    import itertools

    n = len(emit)
    total, good = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        p = np.exp(sum(emit[i, y] for i, y in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total += p
        good += p * np.array(labels)
    return good / total, np.log(total)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    lines = np.array([3, 1, 6, 4])
    emit, moves = rng.normal(size=(14, 2)), rng.normal(size=(2, 2))
    alpha, beta, z = line_crf.marginals(emit, moves, lines)
    at = 0
    for c, n in enumerate(lines):
        good, log_z = brute_marginals(emit[at : at + n], moves)
        assert np.allclose(np.exp(alpha[at : at + n, 1] + beta[at : at + n, 1] - z[c]), good) and np.isclose(z[c], log_z)
        at += n


def test_quality_is_right_on_held_out_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = line_crf.train(docs, labels)
    scored = line_crf.score(docs, model).withColumnRenamed("id", "doc_id").join(labels, "doc_id").where(line_crf.held_out(F.col("doc_id")))
    rows = scored.select("score", "quality").collect()
    assert np.mean([(r.score >= 0.5) == r.quality for r in rows]) >= 0.95
    odd = spark.createDataFrame([(*r, 0.1) for r in ODD], "doc_id long, text string, score double")
    scores = line_crf.score(odd, model).collect()
    assert len(scores) == len(ODD) and all(0 <= r.score <= 1 for r in scores)
    assert line_crf.keep_good(odd, model).columns == odd.columns
    assert line_crf.train(docs.limit(0), labels) is None and line_crf.score(odd, None).first().score == 0.5


def test_slopes_of_the_classifier_are_those_of_its_likelihood():
    rng = np.random.default_rng(5)
    lines, y, weight = np.array([3, 1, 5]), np.array([0, 1, 1]), np.array([0.5, 0.2, 0.3])
    observed, at = rng.normal(size=(9, 4)), rng.normal(size=12)

    def likelihood(p):
        weights, moves, total, begin = p[:8].reshape(4, 2), p[8:].reshape(2, 2), 0.0, 0
        for n, label, w in zip(lines, y, weight):
            emit = observed[begin : begin + n] @ weights
            total += w / n * (emit[:, label].sum() + (n - 1) * moves[label, label] - brute_marginals(emit, moves)[1])
            begin += n
        return total

    got = line_crf.slopes(observed, lines, y, weight, at[:8].reshape(4, 2), at[8:].reshape(2, 2))
    want = [(likelihood(at + d) - likelihood(at - d)) / 2e-5 for d in np.eye(12) * 1e-5]
    assert np.allclose(got, want, atol=1e-6)


def test_classifier_learns_from_the_last_lines_of_long_documents(spark):
    good, bad = ["A calm sentence with plain words."] * 600, ["## 77 $$ 77 $$ 77"] * 600
    rows = [(i, "\n".join(good + (bad if i % 2 else good)), 1 - i % 2) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = line_crf.train(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    seen = spark.createDataFrame([(1, "\n".join(good)), (2, "\n".join(bad))], DOCS)
    scores = {r.id: r.score for r in line_crf.score(seen, model).collect()}
    assert scores[2] < 0.1 and scores[1] > 0.5
