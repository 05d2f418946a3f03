"""Alignment against plain loops over whole texts; fragments of any cuts in any bracketing."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from crawldelta.llm import align, scratch
from tests.llm.conftest import DDL, LONG, ROWS, with_clashes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = [
    (20, "a  b\n\nc\td <|endoftext|><s></s><unk> <0x41> \x00 \u200b", "en", "s"), (21, "\u2581marked", "en", "s"), (22, "\u6f22\u5b57" * 50, "zh", "s"),
    (23, " lead and trail ", "en", "s"), (24, "\U0001f9d1\u200d\U0001f680 emoji \u0301 marks", "en", "s"), (None, "no number at all", None, None),
    (25, " ", "en", "s"), (25, "  ", "en", "s"), (26, "=" * 300 + " \n" * 40, "en", "s"), (27, "\u6f22 \n\u5b57 x\ny z\nw " * 400, "zh", "s"),
    (28, "word " * 500 + "\u2581 breaks a long one " + "word " * 500, "en", "s"), (29, "x" * 3000, "en", "s"),
]


def plain_tokens(text):
    a, b = align.vocabularies(A, B)
    raw = (" " + text).encode()
    own = []
    for vocabulary, source in ((a, " " + text), (b, text)):
        at, tokens = 0, []
        for i in vocabulary.encode([source])[0].tolist():
            tokens.append((at, at + len(vocabulary.raw[i]), i))
            at += len(vocabulary.raw[i])
        if b"".join(vocabulary.raw[i] for _, _, i in tokens) != raw:
            return None
        own.append(tokens)
    return own


def plain_report(rows):
    seen, held = [], defaultdict(int)
    for doc_id, text, *_ in rows:
        tokens = plain_tokens(text) if text else None
        if tokens is None:
            seen.append((doc_id, None))
            continue
        a, b = tokens
        common = {e for _, e, _ in a} & {e for _, e, _ in b}
        texts = []
        for side in (a, b):
            own = [[]]
            for _, end, i in side:
                own[-1].append(str(i))
                if end in common:
                    own.append([])
            texts.append([",".join(x) for x in own[:-1]])
        groups = list(zip(*texts))
        j, links = 0, []
        for s, e, i in a:
            while j < len(b) and b[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        for pair in set(links):
            held[pair] += 1
        seen.append((doc_id, (len(a), len(b), groups, links)))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, told in seen:
        if told is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = told
        text = ";".join("|".join(g) for g in groups)
        best = sum(held[p] == most[p[0]] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def every(spark):
    return with_clashes(spark.createDataFrame(ROWS + MORE, DDL).repartition(3)).withColumn("pair", F.lit("x")).withColumn("ok", F.lit("x"))


@pytest.mark.parametrize("size,fan_in", [(align.RANGE, align.FAN_IN), (700, 2), (64, 3)])
def test_report_matches_plain_loops(every, size, fan_in):
    most = None if size == align.RANGE else 80 * size
    docs = every.withColumn("text", F.substring("text", 1, most)) if most else every
    got = sorted(map(tuple, align.alignment_report(docs, A, B, size, fan_in).collect()), key=repr)
    assert got == plain_report([(d, t[:most] if t else t) for d, t, *_ in ROWS + MORE])


@pytest.mark.parametrize("bound", [0, 40])
def test_counts_beyond_the_broadcast_bound(every, monkeypatch, bound):
    want = plain_report([(d, t[:3000] if t else t) for d, t, *_ in ROWS + MORE])
    monkeypatch.setattr(scratch, "BROADCAST_ROWS", bound)
    docs = every.withColumn("text", F.substring("text", 1, 3000))
    assert sorted(map(tuple, align.alignment_report(docs, A, B, 700, 2).collect()), key=repr) == want


def test_no_documents(spark, no_docs):
    assert align.alignment_report(no_docs, A, B).count() == 0


def test_real_groups_cover_the_text(spark):
    docs = spark.createDataFrame([(1, LONG, "en", "s")], DDL)
    made = align.align(docs, A, B, 5000, 2)
    sections = sorted(made.sections.collect(), key=lambda r: r.at)
    assert len(sections) > 20
    a, b = align.vocabularies(A, B)
    for vocabulary, column in ((a, "a_ids"), (b, "b_ids")):
        assert b"".join(vocabulary.raw[i] for r in sections for i in r[column]).decode() == " " + LONG
    for r in sections:
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes)
        assert len(r.a_sizes) <= align.ROW_GROUPS
    tokens, groups = sum(len(r.a_ids) + len(r.b_ids) for r in sections), sum(len(r.a_sizes) for r in sections)
    assert made.cut_links.agg(F.sum("times")).first()[0] == tokens - groups and made.links.count() == 0


@pytest.mark.parametrize("text", [t for _, t, *_ in ROWS + MORE if t])
@pytest.mark.parametrize("size", [1, 5, 40, 1000])
def test_ranges_are_encoded_as_the_whole(text, size):
    if len(text) > 20_000:
        text = text[:9000]
    a, b = align.vocabularies(A, B)
    own = align.ranges(text, size)
    assert [i for x, _, _, _ in own if x for i in a.encode([x])[0].tolist()] == a.encode([" " + text])[0].tolist()
    assert [i for _, _, y, _ in own if y for i in b.encode([y])[0].tolist()] == b.encode([text])[0].tolist() or "\u2581" in text
    raw = (" " + text).encode()
    assert all(raw[at:].startswith(x.encode()) for x, at, _, _ in own) and all(raw[at:].startswith((" " * bool(y) + y).encode()) for _, _, y, at in own)


def test_ids_are_those_of_the_file(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    rng = random.Random(1)
    signs = "aAeE tT\n\t'sdl09.,;%$#\u00e9\u00df\u6f22\u0301\U0001f600_-"
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()] + [t for _, t, *_ in ROWS + MORE if t]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 400))) for _ in range(3000)] + ["x" * 5000 + " y", " " * 3000 + "z", "ab" * 4000]
    a = align.vocabularies(A, B)[0]
    assert [x.tolist() for x in a.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [len(r) for r in a.raw] == a.sizes.tolist() and len(set(a.raw)) == len(a.raw)


def plain_closed(tokens):
    """Every group as bytes of its begin and its ids."""
    sizes = align.groups_of(tokens)
    x = y = 0
    out = []
    for m, n in zip(*sizes):
        out.append((tuple(tokens.a_ids[x : x + m].tolist()), tuple(tokens.b_ids[y : y + n].tolist()), int(tokens.a_ends[x + m - 1])))
        x, y = x + m, y + n
    return out


@pytest.mark.parametrize("seed", range(40))
def test_any_cuts_and_any_bracketing_give_the_same_groups(seed):
    rng = random.Random(seed)
    length = rng.choice((1, 2, 10, 200))

    def side():
        ends = sorted(rng.sample(range(1, length), rng.randint(0, length - 1) // rng.choice((1, 3)))) + [length]
        return np.array([rng.randrange(9) for _ in ends], np.int32), np.array(ends, np.int64)

    whole = align.Tokens(*side(), *side())
    want = plain_closed(whole)
    # Each tokenizer is cut at places of its own.
    k = rng.randint(1, 9)
    cuts = [[0, *sorted(rng.randint(0, len(whole[c])) for _ in range(k - 1)), len(whole[c])] for c in (0, 2)]
    parts = [align.Tokens(whole[0][p:q], whole[1][p:q], whole[2][r:s], whole[3][r:s]) for p, q, r, s in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])]
    made = [align.split(t, i == 0) for i, t in enumerate(parts)]
    fragments, closed = [m[0] for m in made], [m[1] for m in made]
    while len(fragments) > 1:
        i = rng.randrange(len(fragments) - 1)
        both, between = align.compose(fragments[i], fragments[i + 1])
        fragments[i : i + 2] = [both]
        closed.append(between)
    groups = sorted((g for t in closed if len(t.a_ids) for g in plain_closed(t)), key=lambda g: g[2])
    assert groups == want and not len(fragments[0].tail.a_ids) and not len(fragments[0].head.a_ids)
