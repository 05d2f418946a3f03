"""Token shards of rows that share a doc_id, hold the end id in their text, or have no doc_id."""

from __future__ import annotations

import random
import re
import string
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from crawldelta.llm import tokenbin
from crawldelta.llm.queries import tokenizer_file
from crawldelta.llm.scratch import new_folder
from tests.llm.test_operators import BPE, plain_ids, rows

DATA = [(5, "Hello! you"), (5, "Hello! you"), (5, "!"), (5, None), (7, "! !"), (1, "one")]
UNKEYED = [(None, "no ! key"), (None, "no ! key"), (None, None), (None, "more " * 50)]


@pytest.mark.parametrize("size", [tokenbin.SHARD_BYTES, 40])
@pytest.mark.parametrize("data", [DATA, DATA + UNKEYED, UNKEYED])
def test_repeated_and_missing_keys(spark, data, size):
    folder = new_folder(spark, "keys")
    tokenbin.write_shards(spark.createDataFrame(data, "doc_id long, text string").repartition(3), folder, BPE, size)
    got = tokenbin.token_report(spark, folder).collect()
    told = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr)
    want = [(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in ((d, plain_ids(t)) for d, t in data)]
    assert told == sorted(want, key=repr)
    # One document begins where the one before ends, and those without a key come last.
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order[:-1]]]).tolist()
    keys = [r.doc_id for r in in_order]
    assert keys == sorted((k for k in keys if k is not None)) + [None] * keys.count(None)
    asked = spark.createDataFrame([(5,), (7,), (None,), (99,)], "doc_id long")
    found = {r.doc_id: len(r.ids) for r in tokenbin.lookup(spark, folder, asked).collect()}
    assert found == {k: sum(len(plain_ids(t)) for d, t in data if d == k) for k in (5, 7) if any(d == k for d, _ in data)}


def test_words_of_letters_are_encoded_without_the_splitter(monkeypatch):
    path, seen, plain = tokenizer_file("byte_bpe_50k.json"), [], tokenbin._encoded
    monkeypatch.setattr(tokenbin, "_ENCODERS", {})
    monkeypatch.setattr(tokenbin, "_encoded", lambda model, parts: seen.extend(parts) or plain(model, parts))
    rng = random.Random(7)
    every = "".join(chr(c) for c in range(0x21, 0x260))
    words = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 12))) for signs in (string.ascii_letters, "éßñäøÿƀɏaE", every, "жд漢字ªµº×÷'sɐ") for _ in range(600)]
    rng.shuffle(words)
    texts = [" ".join(words[i : i + 40]) for i in range(0, len(words), 40)] + ["", " ", "a", " a", "É", "a\nb", "it's don't 'tis x1y2"]
    model = Tokenizer.from_file(path)
    want = [np.array([*model.encode(t, add_special_tokens=False).ids, tokenbin.END_ID], "<u4").tobytes() for t in texts]
    assert tokenbin.encode_bytes(texts, path) == want
    assert seen and not [p for p in seen if re.fullmatch(" ?[A-Za-zÀ-ÖØ-öø-ɏ]{2,}", p) and p in {w for t in texts for w in (t.split(" "))}]
