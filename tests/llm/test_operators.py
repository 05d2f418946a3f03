"""The ten operators on awkward small tables and against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from crawldelta.llm import blocks, components, decontam, html_text, langid, licenses, pieces, quality, secrets, simhash, tokenbin
from crawldelta.llm.scratch import new_folder
from tests.llm.conftest import DDL, LONG, ROWS

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---------------------------------------------------------------- 1 secrets

OPEN = [
    ("assign", re.compile(secrets.RULES["assign"][1], re.IGNORECASE | re.ASCII), lambda m: len(m[2]) >= 8),
    ("access", re.compile(secrets.RULES["access"][1]), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(secrets.RULES["hex"][1]), lambda m: len(m[0]) >= 32),
]


def plain_spans(text):
    found = [(m.start(), i, m.end(), k) for i, (k, rx, ok) in enumerate(OPEN) for m in rx.finditer(text or "") if ok(m)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_secrets_match_the_open_patterns(docs):
    got = rows(secrets.secret_report(docs).select("doc_id", "spans", "base_sha256"))
    want = [(d, plain_spans(t), hashlib.sha256(plain_spans(t).encode()).hexdigest()) for d, t, *_ in ROWS]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("text", [
    "token=token:abcdefgh1", "SECRET : 'abcdefgh'", "api_key=short", "AKIA" + "A" * 11, "AKIA" + "AKIA" * 4,
    "x" * 5 + "0123456789abcdef" * 3 + "g", "paſſword=abcdefghij", "apikey=" + "a" * 40, "üü token=\"abcdefgh\"",
])
def test_secret_edges(text):
    spans = secrets.find_spans(text, list(secrets.FINDERS))
    assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans) == plain_spans(text)


def test_ledger_scans_only_unseen_blobs_and_rules(spark, docs, monkeypatch):
    ledger = new_folder(spark, "ledger-test")
    distinct = len({t or "" for _, t, *_ in ROWS})
    assert secrets.update_ledger(docs, ledger) == distinct
    assert secrets.update_ledger(docs, ledger) == 0
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "token=abcdefgh99")], "doc_id long, text string"))
    assert secrets.update_ledger(more, ledger) == 1
    monkeypatch.setitem(secrets.RULES, "hex", (2, secrets.RULES["hex"][1]))
    assert secrets.update_ledger(more, ledger) == distinct + 1
    found = {r.doc_id: r.spans for r in secrets.scan_versions(more, ledger).collect()}
    assert [s.kind for s in found[99]] == ["assign"] and len(found[12]) == 3


# ---------------------------------------------------------------- 2 html

PAGE = """<!DOCTYPE html><html lang="en"><head><title>no</title><script>var a="<p>no</p>";</script></head><body class="ads-off">
<nav>no</nav><div class="cookie notice">no</div><article><h1>One &amp; two</h1><p>Three<b>four</b>
 five<br>six</p><div class="comments"><p>no</p></div><aside>no</aside><form>no</form><p>se<!-- no -->ven &#56;&nbsp;nine</article><footer>no</footer>"""


def test_article_blocks_in_order():
    assert " ".join(html_text.read_page(PAGE).article) == "One & two Threefour five six seven 8 nine"


@pytest.mark.parametrize("source", [None, "", "plain < text", "<", "<article", "<article>x", "</p></div>", "<p " + "a" * 100_000, "<b>" * 20_000, "<script>never closed"])
def test_any_source_is_read(source):
    html_text.read_page(source)


def test_suffix_buckets_equal_plain_runs():
    rng = random.Random(3)
    streams = [[rng.choice("abc") for _ in range(rng.randint(0, 40))] or [""] for _ in range(12)]
    for least in (1, 3, 8):
        got = {(i, run) for i, _, run in html_text.repeated_runs(streams, least)}
        assert got == {(i, " ".join(s[k : k + least])) for i, s in enumerate(streams) for k in range(len(s) - least + 1)}


def test_host_boilerplate_goes_and_unique_runs_stay(spark):
    notice = "we use small files to make this site work for all readers"
    body = lambda i: " ".join(f"own{i}x{k}" for k in range(20))
    data = [(i, f"http://h.example/{i}", f"<div><p>{body(i)}</p><p>{notice}</p></div>") for i in range(6)]
    data += [(50, "http://other.example/1", f"<div>{notice}</div>"), (51, None, None), (52, "http://h.example/9", ""), (0, *data[0][1:])]
    data += [(60, "http://h.example/60", f"<article>{notice}</article>")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    for bound in (html_text.SEGMENT_TOKENS, 40):
        got = rows(html_text.extract(pages, segment_tokens=bound).select("page_id", "text"))
        want = [(i, body(i)) for i in range(6)] + [(50, notice), (51, ""), (52, ""), (0, body(0)), (60, notice)]
        assert got == sorted(want, key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- 3 simhash


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    cut = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in cut]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_match_plain_counting(docs):
    got = rows(simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits().alias("f")))
    assert got == sorted(((d, f"{plain_simhash(t):016x}") for d, t, *_ in ROWS), key=repr)


def components_of(fps):
    label = dict(fps)
    ids = sorted({i for i, _ in fps})
    parent = {i: i for i in range(len(fps))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a][1] ^ fps[b][1]).bit_count() <= 2:
            parent[find(a)] = find(b)
    low = defaultdict(list)
    for i, (d, _) in enumerate(fps):
        low[find(i)].append(d)
    assert label and ids
    return [min(low[find(i)]) for i in range(len(fps))]


def test_components_match_all_pairs(spark):
    rng = random.Random(5)
    fps = []
    for start in [rng.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]:
        f = start
        for _ in range(12):
            fps.append(f)
            for _ in range(rng.choice((0, 1, 2, 3))):
                f ^= 1 << rng.randrange(64)
    data = [(i, f - 2**64 if f >= 2**63 else f) for i, f in enumerate(fps)]
    table = spark.createDataFrame(data, "doc_id long, fp long")
    groups = {r.fp: r.component_id for r in simhash.near_groups(table).collect()}
    assert [groups[f] for _, f in data] == components_of(list(enumerate(fps)))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(7, 7), (5, 4), (None, 3)], "a long, b long")
    assert {tuple(r) for r in components.roots(edges).collect()} == {(i, 0) for i in range(201)}
    assert components.roots(edges.limit(0)).count() == 0


def test_one_of_each_near_group_stays(docs, no_docs):
    left = simhash.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 6, 9, 10, 11, 12, 13]
    assert {r.text_key for r in left.collect()} == {"x"}
    assert simhash.drop_near_duplicates(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(docs).columns == docs.columns


# ---------------------------------------------------------------- 4 licences


def test_license_forms(spark):
    mit = licenses.TEXTS["MIT"]
    data = [
        (1, "x\nreleased under the   MIT Licence\ny"), (2, "Copyright (c) 2020 Me\n" + mit.upper()), (3, " ".join(mit.split())),
        (4, None), (5, ""), (6, "Licensed under the Apache License, Version 2.0, really"), (7, "All rights reserved."),
        (None, "Licensed under CC BY-NC 4.0.\r\nLicensed under CC BY-NC 4.0"), (1, "Released under the MIT License."),
    ]
    found = rows(licenses.license_matches(spark.createDataFrame(data, "doc_id long, text string").withColumn("digest", F.lit(1))))
    want = [(1, "MIT", "line", 2), (1, "MIT", "text", 1), (2, "MIT", "text", 1), (3, "MIT", "text", 1), (3, "MIT", "line", 1), (None, "CC-BY-NC-4.0", "line", 2)]
    assert found == sorted(want, key=repr)


# ---------------------------------------------------------------- 5 languages


def test_language_evidence(spark):
    en, de = "the house and the garden of the king " * 6, "das haus und der garten ist nicht für die " * 6
    docs = spark.createDataFrame([(1, en, "en", "a"), (2, de, "de", "b"), (3, None, None, None), (4, "", "en", "a"), (5, "ja", None, "b")], DDL)
    langs, table = langid.train_text(docs)
    assert langs == ["de", "en"] and np.allclose(np.exp(table.astype(float)).sum(0), 1, atol=1e-3)
    page = lambda tag, body: f'<html lang="{tag}"><article>{body}</article>'
    pages = [(i, f"http://x{i % 3}.example.de/{i}", page("de-AT", de)) for i in range(20)] + [(i, f"http://y.example.uk/{i}", page("en", en)) for i in range(20, 40)]
    pages += [(40, "http://x1.example.de/e", page("de", "")), (41, "http://y.example.uk/e", "<p></p>"), (42, None, None), (43, "http://x1.example.de/n", page("de", en))]
    table_of = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("lang", F.lit("zz"))
    got = {r.doc_id or r.page_id + 100: r for r in langid.identify(langid.document_rows(docs).unionByName(langid.page_rows(table_of)), langs, table).collect()}
    assert len(got) == 49 and all(0 < r.confidence <= 1 for r in got.values())
    assert got[1].lang == "en" and got[2].lang == "de" and got[140].lang == "de" and got[141].lang == "en" and got[143].lang == "en"
    assert langid.identify(langid.document_rows(docs), [], np.zeros((langid.PAIRS, 0))).where("lang is null").count() == 5
    assert langid.identify(langid.document_rows(docs.limit(0)), langs, table).count() == 0


def test_text_support_is_a_plain_sum():
    rng = np.random.default_rng(1)
    table = np.log(rng.dirichlet(np.ones(langid.PAIRS), 2).T + 1e-12)
    raw = "Äpfel und Birnen".lower().encode()
    plain = sum(table[a * 256 + b] for a, b in zip(raw, raw[1:]))
    assert np.allclose(langid.text_support("Äpfel und Birnen", table), plain - plain.max())


# ---------------------------------------------------------------- 6 quality


def test_pooled_features_match_plain_loops():
    rng = np.random.default_rng(2)
    net = quality.Network(rng.normal(size=(quality.WIDTH, 257, 3)), rng.normal(size=3), rng.normal(size=6), 0.1)
    for size in (0, 1, 5, 6, 7, 63, 64, 65, 447, 448, 449, 511, 512, 513, 1000, 130_000):
        text = rng.integers(0, 257, size).astype(np.int32)
        plain = []
        for s in quality.chunk_starts(size):
            part = text[s : s + quality.CHUNK]
            acts = [sum(net.taps[k, part[i + k]] for k in range(quality.WIDTH)) for i in range(len(part) - quality.WIDTH + 1)] if size < 2000 else None
            if acts is None:
                m = sum(net.taps[k].take(part[k : len(part) - quality.WIDTH + 1 + k], axis=0) for k in range(quality.WIDTH))
                plain.append(np.maximum(m.max(0) + net.bias, 0))
            else:
                plain.append(np.maximum(np.max(acts, 0) + net.bias, 0) if acts else np.zeros(3))
        want = np.concatenate((np.mean(plain, 0), np.max(plain, 0)))
        assert np.allclose(net.pooled(text, net.pairs()), want)


def test_every_symbol_is_in_a_chunk():
    for n in range(1, 3000):
        starts = quality.chunk_starts(n)
        assert starts[0] == 0 and starts[-1] + quality.CHUNK >= n and (np.diff(starts) == quality.STEP).all()


def test_quality_is_learnt_and_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality_report(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    out = got[got.held_out]
    assert ((out.score >= 0.3) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    assert (out.predicted == out.quality).mean() > 0.9 and (out[out.quality == 1].predicted == 1).mean() > 0.95


def test_quality_without_labels(docs, no_docs, spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = quality.quality_report(docs, labels)
    assert got.count() == len(ROWS) and got.where("score < 0.3 or score is null").count() == 0
    assert quality.drop_low_quality(docs, labels).columns == docs.columns
    assert quality.quality_report(no_docs, labels).count() == 0


# ---------------------------------------------------------------- 7 token ids


def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids + [0]


def test_shards_round_trip(spark, docs, no_docs):
    for size in (tokenbin.SHARD_BYTES, 200):
        folder = new_folder(spark, "shards")
        tokenbin.write_shards(docs, folder, BPE, size)
        start, want = 0, []
        for d, ids in sorted(((d, plain_ids(t)) for d, t, *_ in ROWS), key=lambda x: x[0]):
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert rows(tokenbin.token_report(spark, folder)) == sorted(want, key=repr)
        wanted = spark.createDataFrame([(d,) for d in (11, 13, 13, 6, None, -5, 0, 99)], "doc_id long")
        got = {r.doc_id: r.ids for r in tokenbin.lookup(spark, folder, wanted).collect()}
        assert got == {d: plain_ids(t) for d, t, *_ in ROWS if d in (11, 13, 6)}
    folder = new_folder(spark, "shards")
    tokenbin.write_shards(no_docs, folder, BPE)
    assert tokenbin.token_report(spark, folder).count() == 0


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 10, 1000, 5000):
        keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n)).view(np.uint64)
        slots = tokenbin.find_slots(keys, tokenbin.build_index(keys), len(keys))
        assert sorted(slots.tolist()) == list(range(len(keys)))


@pytest.mark.parametrize("text", [" a", "a ", "a  b", "a\n b", "a \nb", "a\t b c", "a   ", " ", "", "it's 5 o'clock  ok", "x <|endoftext|> y", "  a b", "a\r\n b", "é è"])
def test_cut_encoding_equals_whole(text):
    assert np.frombuffer(tokenbin.encode_bytes([text], BPE)[0], "<u4").tolist() == plain_ids(text)


# ---------------------------------------------------------------- 8 exact duplicates


def plain_groups():
    by = defaultdict(list)
    for d, t, *_ in ROWS:
        by[t or ""].append(d)
    return sorted(((d, max(by[t or ""]), len(by[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in ROWS), key=repr)


def weak(column):
    """A hash that many blocks share."""
    return F.xxhash64(column) % 3


@pytest.mark.parametrize("size,block_hash", [(4096, F.xxhash64), (16, F.xxhash64), (1000, weak)])
def test_exact_groups_by_any_block(docs, size, block_hash):
    found = blocks.exact_groups(docs, size, block_hash)
    assert rows(found.select("doc_id", "keep_id", "group_size", "text_sha256")) == plain_groups()
    kept = Counter(r.text_sha256 for r in found.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t, *_ in ROWS})


def test_exact_duplicates_go(docs, no_docs):
    left = blocks.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and {r["__sha"] for r in left.collect()} == {"x"}
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 7, 8, 9, 10, 11, 12, 13]
    assert blocks.exact_groups(no_docs).count() == 0 and blocks.drop_exact_duplicates(no_docs).count() == 0


# ---------------------------------------------------------------- 9 decontamination


def plain_words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def plain_cut(text):
    w = plain_words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_containment_matches_brute_force(spark):
    rng = random.Random(9)
    word = lambda: rng.choice([f"w{i}" for i in range(400)])
    items = [(i, " ".join(word() for _ in range(rng.choice((3, 5, 8, 20, 60))))) for i in range(40)] + [(40, None), (41, ""), (None, "a b c d e f")]
    docs = [(0, None), (1, ""), (None, "x a b c d e f y")]
    for d in range(2, 120):
        w = [word() for _ in range(rng.choice((0, 4, 50, 400)))]
        for _ in range(rng.randint(0, 2)):
            own = plain_words(items[rng.randrange(40)][1])
            if rng.random() < 0.6 and own:
                own[rng.randrange(len(own))] = word()
            at = rng.randint(0, len(w))
            w[at:at] = own
        docs.append((d, " ".join(w).title()))
    docs.append(docs[5])
    want = []
    for d, t in docs:
        for i, it in items:
            a, b = plain_cut(it), plain_cut(t)
            if a and len(a & b) / len(a) >= 0.8 - 1e-9:
                want.append((d, i, round(len(a & b) / len(a), 9)))
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(7)).withColumn("h", F.lit(1))
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(7))
    got = decontam.contained_items(table, tests).select("doc_id", "item_id", F.round("containment", 9))
    assert rows(got) == sorted(want, key=repr) and len(want) > 20
    left = decontam.drop_contaminated(table, tests)
    assert left.columns == table.columns and left.count() == len([1 for d, _ in docs if d not in {w[0] for w in want}])
    assert decontam.contained_items(table, tests.limit(0)).count() == 0 and decontam.contained_items(table.limit(0), tests).count() == 0


def test_decontamination_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = decontam.contained_items(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))._jdf.queryExecution().toString()
    plan += licenses.license_matches(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- 10 pieces


def plain_best(model, text, n):
    """All segmentations of a marked text, best scores first."""

    def paths(at):
        if at == len(text):
            yield 0.0, ()
        for end in range(at + 1, len(text) + 1):
            if hit := model.scores.get(text[at:end]):
                for s, ids in paths(end):
                    yield hit[0] + s, (hit[1], *ids)
        if at < len(text) and text[at] not in model.scores:
            score, own = model._spelled(text[at])
            for s, ids in paths(at + 1):
                yield score + s, (*own, *ids)

    return sorted(paths(0), key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["ab", "the cat", "a  b", "tion's", "x\ny", "▁a", "漢 a", "aaaa", " a", "in the in"])
@pytest.mark.parametrize("n", [1, 3, 7])
def test_n_best_matches_enumeration(text, n):
    model = pieces.Lattice(PIECES, n)
    got = model.encode(text)
    assert len({b for _, b in got}) == len(got)
    for score, ids in got:
        assert model.decode(np.frombuffer(ids, "<i4").tolist()) == text
    if pieces.SPACE not in text:
        every = plain_best(model, (" " + text).replace(" ", pieces.SPACE), n)
        assert np.allclose([s for s, _ in got], [s for s, _ in every[:n]], rtol=0, atol=1e-3)
        known = {ids: s for s, ids in every}
        assert all(np.isclose(known[tuple(np.frombuffer(b, "<i4").tolist())], s, rtol=0, atol=1e-3) for s, b in got)


def test_parts_scored_together_equal_one_by_one():
    rng = random.Random(8)
    model = pieces.Lattice(PIECES, 2)
    for size in (1, 2, 5, 17, 40):
        parts = ["".join(rng.choice("▁theandiç漢\n.") for _ in range(size)) for _ in range(60)]
        for part, (ids, score, loss) in zip(parts, zip(*model.table.score_all(parts, size, model))):
            alone = model._viterbi(part)
            assert np.isclose(score, alone[1]) and (loss == alone[2] or np.isclose(loss, alone[2]))
            own = {i: s for s, i in model.scores.values()}
            assert sum(own.get(i, -pieces._BYTE_COST) for i in np.frombuffer(ids, "<i4").tolist()) == pytest.approx(score)


def test_documents_round_trip(docs, no_docs):
    coded = pieces.encode_documents(docs, PIECES)
    found = coded.collect()
    assert len(found) == len(ROWS) and all(r.round_trip and r.n_pieces == len(r.ids) and all(o.score <= r.score for o in r.others) for r in found)
    back = rows(pieces.decode_documents(coded, PIECES))
    assert back == sorted(((d, t or "") for d, t, *_ in ROWS), key=repr)
    assert pieces.encode_documents(no_docs, PIECES).count() == 0
    assert LONG in {t for _, t in back}
