"""Token-id output: raw id payloads in shards with a minimal perfect hash index.

A written folder is a Parquet table with one row per shard, so any file system
that Spark writes to will do and a lost task leaves nothing behind:

  shard      integer name; shards in ascending name hold ascending doc_ids, and last the documents without one
  n_docs, n_ids, first_doc (null in a shard of documents without doc_id, whose index is empty)
  payload    the documents' ids, unsigned 32-bit little-endian, end to end
  keys       the documents' ids (signed 64-bit little-endian) in payload order
  sizes      number of ids (u64) of each document in payload order, also of those that share a key
  displace   the hash index: one displacement (u32) per bucket of four keys
  stored     per slot: fingerprint (u32) of the key whose slot it is
  offsets    per slot: first id of the key's documents in the payload (u64)
  lengths    per slot: number of ids (u64) of all documents of the key
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawldelta.llm.scratch import ship_code

#: Fixed value: the id that ends each document. A text may hold it as well: documents are never cut by it.
END_ID = 0

#: A shard is closed at this many bytes of ids; one longer document makes a longer shard.
SHARD_BYTES = 4 << 20

#: Encoded pieces of text remembered in one Python worker.
REMEMBERED = 450_000

#: Bytes of text encoded together.
ENCODED_AT_ONCE = 8 << 20

_SHARD = pa.schema(
    [("shard", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_doc", pa.int64())]
    + [(c, pa.binary()) for c in ("payload", "keys", "sizes", "displace", "stored", "offsets", "lengths")]
)
_SHARD_DDL = (
    "shard long, n_docs long, n_ids long, first_doc long, payload binary, keys binary, "
    "sizes binary, displace binary, stored binary, offsets binary, lengths binary"
)

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are written in the machine's own 32-bit form, which must be little-endian")

# ---------------------------------------------------------------- encoding

_ENCODERS: dict[str, tuple] = {}
#: Neighbouring white space, white space other than spaces and line ends, the
#: opening of a special token and the cut's own sign: such texts are encoded whole.
_UNSURE = r"[ \n][ \n]|<\||[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


#: Where letters end, and where they begin after another sign; an apostrophe may belong to the letters after it.
_KINDS = (r"(\pL)([^\pL \n\x00])", r"([^\pL \n'\x00])(\pL)")


#: Letters after one space at most: a part that the splitter leaves whole, in any version of Unicode.
_LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

#: The sign that stands for each byte in a byte-level vocabulary; a line end stays.
_OTHERS = sorted({*range(256)} - {*range(33, 127), *range(161, 173), *range(174, 256)})
_SIGNS = {b: chr(256 + i) for i, b in enumerate(_OTHERS) if b != 10}


def _encoder(path: str) -> tuple:
    """The tokenizer, the same for lines of parts, the bytes of each id, and the ids of the pieces of text seen so far."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        model = Tokenizer.from_file(path)
        by_line = Tokenizer(model.model)
        by_line.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        vocabulary = model.get_vocab(with_added_tokens=False)
        n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        n_bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        _ENCODERS[path] = model, by_line, n_bytes, [pa.array([], pa.large_string()), pa.array([], pa.large_binary())]
    return _ENCODERS[path]


def _as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _encoded(model, parts: list[str]) -> list[bytes]:
    """Ids of parts without line ends. They are encoded as lines of one text: a line end is a part of its own."""
    out = []
    (line_end,) = model.encode("\n", add_special_tokens=False).ids
    for low in range(0, len(parts), 1000):
        some = parts[low : low + 1000]
        ids = np.array(model.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == line_end)
        if len(ends) != len(some) - 1:
            raise ValueError("a part was not encoded as one line")
        raw, cuts = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
        out += [raw[4 * a + 4 : 4 * b] for a, b in zip(cuts, cuts[1:])]
    return out


def _encoded_letters(by_line, n_bytes: np.ndarray, words: list[str]) -> list[bytes]:
    """Ids of words of `_LETTERS`. No splitter has to look at them; the bytes of the ids tell where a word ends."""
    out = []
    for low in range(0, len(words), 1000):
        raw = "\n".join(words[low : low + 1000]).encode()
        signs = raw.decode().replace(" ", _SIGNS[32]) if raw.isascii() else raw.decode("latin-1").translate(_SIGNS)
        ids = np.array(by_line.encode_batch_fast([signs], add_special_tokens=False)[0].ids, "<u4")
        ends = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) == 10), len(raw))
        ends -= np.arange(len(ends))
        reached = np.cumsum(n_bytes[ids])
        last = np.searchsorted(reached, ends)
        if reached[-1] != ends[-1] or not np.array_equal(reached[last], ends):
            raise ValueError("a word was not encoded by itself")
        coded, cuts = ids.tobytes(), [0, *(4 * last + 4).tolist()]
        out += [coded[a:b] for a, b in zip(cuts, cuts[1:])]
    return out


def _learn(words: list[str], model, by_line, n_bytes: np.ndarray) -> list[bytes]:
    """The ids of distinct new pieces of text, by the parts that the tokenizer's own splitter makes of them."""
    import public_tokenizers
    import regex

    letters = [w for w in words if _LETTERS.fullmatch(w)]
    letters.sort(key=str.isascii)
    found = dict(zip(letters, _encoded_letters(by_line, n_bytes, letters)))
    split = regex.compile(public_tokenizers.PATTERN).findall
    others = set(words).difference(letters)
    mixed = {w: split(w) for w in others if not w.lstrip(" ").isalpha()}
    fresh = {p for own in mixed.values() for p in own}
    fresh.update(w for w in others if w not in mixed)
    lines = [p for p in fresh.difference(letters) if not p.isspace()]
    found.update(zip(lines, _encoded(model, lines)))
    for p in fresh.difference(found):
        found[p] = _as_bytes(model.encode(p, add_special_tokens=False).ids) if p else b""
    return [b"".join([found[p] for p in mixed[w]]) if w in mixed else found[w] for w in words]


def encode_bytes(texts: list[str | None] | pa.Array, tokenizer: str) -> list[bytes]:
    """Each text's ids with the end id, as unsigned 32-bit little-endian integers.

    The tokenizer's own splitter always begins anew at a space before a
    non-space and at a single line end, and between letters and other signs;
    so texts are cut there, each distinct piece of the batch is looked up once,
    and each distinct part is encoded once per worker. Texts with white space
    beside white space, or with the opening of a special token, are encoded
    whole.
    """
    model, by_line, n_bytes, memo = _encoder(tokenizer)
    column = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
    unsure = pc.match_substring_regex(column, _UNSURE)
    whole = np.flatnonzero(unsure.to_numpy(zero_copy_only=False)).tolist()
    apart = [column[i].as_py() for i in whole]
    if whole:
        column = pc.if_else(unsure, pa.scalar("", pa.large_string()), column)
    marked = pc.replace_substring(pc.replace_substring(column, "\n", "\x00\n\x00"), " ", "\x00 ")
    for kinds in _KINDS:
        marked = pc.replace_substring_regex(marked, kinds, "\\1\x00\\2")
    cut = pc.split_pattern(marked, "\x00")
    coded, offsets = cut.flatten().dictionary_encode(), cut.offsets.to_numpy() - cut.offsets[0].as_py()
    del column, marked, cut  # the texts with their cuts are larger than all that follows
    known, known_ids = memo
    place = pc.index_in(coded.dictionary, value_set=known)
    lacking = coded.dictionary.filter(place.is_null())
    if len(lacking):
        learnt = _learn(lacking.to_pylist(), model, by_line, n_bytes)
        known, known_ids = pa.concat_arrays([known, lacking]), pa.concat_arrays([known_ids, pa.array(learnt, pa.large_binary())])
        place = pc.replace_with_mask(place, place.is_null(), pa.array(np.arange(len(known) - len(lacking), len(known)), pa.int32()))
    found = known_ids.take(place)
    # The present batch's pieces are the likeliest to come again.
    memo[:] = (known, known_ids) if len(known) <= REMEMBERED else (coded.dictionary, found)
    ids = found.take(coded.indices)
    at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset :][offsets].tolist()
    data = memoryview(ids.buffers()[2] or b"")
    end = np.array([END_ID], "<u4").tobytes()
    out = [bytes(data[a:b]) + end for a, b in zip(at, at[1:])]
    for i, e in zip(whole, model.encode_batch_fast(apart, add_special_tokens=False)):
        out[i] = _as_bytes(e.ids) + end
    return out


# ---------------------------------------------------------------- the index


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over the keys, salted."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _slots(keys: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = _mix(keys, 2) + displacement.astype(np.uint64) * (_mix(keys, 3) | np.uint64(1))
    return ((spread ^ (spread >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> np.ndarray:
    """Displacements of a minimal perfect hash of distinct 64-bit keys: n keys to the slots 0..n-1.

    Keys fall into buckets of four on average; large buckets first, each takes
    the smallest displacement that puts its keys on free slots.
    """
    n = len(keys)
    buckets = max(1, -(-n // 4))
    of = (_mix(keys, 1) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    sizes = np.bincount(of, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    taken = np.zeros(n, bool)
    displace = np.zeros(buckets, "<u4")
    step = np.arange(64, dtype=np.uint64)
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        own = keys[order[starts[b] : starts[b] + sizes[b]]]
        low, tries = 0, step
        while True:
            # All of one round's displacements at once: a row for each.
            put = _slots(np.tile(own, len(tries)), np.repeat(tries, len(own)), n).reshape(len(tries), -1)
            ok = ~taken[put].any(1)
            if len(own) > 1:
                ordered = np.sort(put, 1)
                ok &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
            if ok.any():
                hit = int(np.argmax(ok))
                displace[b] = int(tries[hit])
                taken[put[hit]] = True
                break
            low += len(tries)
            tries = np.arange(low, low + min(4 * len(tries), 1 << 14), dtype=np.uint64)
    return displace


def find_slots(keys: np.ndarray, displace: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key, in constant time; a key that was not indexed gets the slot of another."""
    return _slots(keys, displace[(_mix(keys, 1) % np.uint64(len(displace))).astype(np.int64)], n)


def key_print(keys: np.ndarray) -> np.ndarray:
    """The 32-bit fingerprint stored in a key's slot."""
    return (_mix(keys, 4) >> np.uint64(32)).astype("<u4")


# ---------------------------------------------------------------- writing


def _shard_row(name: int, keys: list[int | None], parts: list[bytes]) -> pa.RecordBatch:
    """A shard of documents that all have a key, or all have none."""
    ids = np.array([k for k in keys if k is not None], "<i8")
    counts = np.array([len(p) // 4 for p in parts], "<u8")
    begin = np.concatenate(([0], np.cumsum(counts)[:-1])).astype("<u8")
    distinct, first = np.unique(ids, return_index=True)
    as_keys = distinct.view(np.uint64)
    n = len(distinct)
    # Documents that share a key lie side by side and are opened together.
    length = np.add.reduceat(counts, first).astype("<u8") if n else np.zeros(0, "<u8")
    displace = build_index(as_keys)
    slot = find_slots(as_keys, displace, n) if n else np.zeros(0, np.int64)
    stored, offsets, lengths = np.zeros(n, "<u4"), np.zeros(n, "<u8"), np.zeros(n, "<u8")
    stored[slot], offsets[slot], lengths[slot] = key_print(as_keys), begin[first], length
    columns = [[name], [len(keys)], [int(counts.sum())], [keys[0]], [b"".join(parts)], [ids.tobytes()]]
    columns += [[x.tobytes()] for x in (counts, displace, stored, offsets, lengths)]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SHARD)], schema=_SHARD)


def _pieces_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of a few million bytes of text, or one longer text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + ENCODED_AT_ONCE, "right")))
        yield batch.slice(low, high - low)
        low = high


def write_shards(docs: DataFrame, folder: str, tokenizer: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode docs(doc_id, text) and write the shards in ascending doc_id.

    Null texts count as empty and hold the end id alone. Rows that share a
    doc_id are ordered by their text's hash. Documents without a doc_id have no
    key: they come last, in shards of their own, in the order of their texts'
    hashes. An empty table writes a folder without shards.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, keys, parts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for some in _pieces_of(batch):
                for key, part in zip(some.column("doc_id").to_pylist(), encode_bytes(some.column("text"), tokenizer)):
                    if keys and (key is None) != (keys[-1] is None) or held >= shard_bytes and (key is None or key != keys[-1]):
                        yield _shard_row(name, keys, parts)
                        name, keys, parts, held = name + 1, [], [], 0
                    keys.append(key)
                    parts.append(part)
                    held += len(part)
        if keys:
            yield _shard_row(name, keys, parts)

    ship_code(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = F.col("doc_id").asc_nulls_last()
    # Rows that share a key stay together; those without one need not.
    ranged = rows.repartitionByRange(key, F.when(F.col("doc_id").isNull(), F.xxhash64("text")).asc())
    ranged = ranged.sortWithinPartitions(key, F.xxhash64("text"), "text")
    ranged.mapInArrow(shards, _SHARD_DDL).write.option("compression", "snappy").parquet(folder)


def read_shards(spark, folder: str) -> DataFrame:
    """The shard rows of a folder."""
    return spark.read.schema(_SHARD_DDL).parquet(folder)


# ---------------------------------------------------------------- reading


def shard_starts(shards: DataFrame) -> DataFrame:
    """(shard, base): ids of all shards before it. Summed within the writing task's shards and then over the tasks."""
    sizes = shards.select("shard", "n_ids", F.shiftright("shard", 32).alias("task"))
    of_task = sizes.groupBy("task").agg(F.sum("n_ids").alias("ids"))
    before = (Window.unboundedPreceding, -1)
    earlier = F.sum("ids").over(Window.orderBy("task").rowsBetween(*before))
    tasks = of_task.select("task", F.coalesce(earlier, F.lit(0)).alias("task_base"))
    within = F.sum("n_ids").over(Window.partitionBy("task").orderBy("shard").rowsBetween(*before))
    inner = sizes.withColumn("within", F.coalesce(within, F.lit(0)))
    return inner.join(tasks, "task").select("shard", (F.col("within") + F.col("task_base")).alias("base"))


def _opened(pdf_row) -> tuple:
    part = {c: np.frombuffer(getattr(pdf_row, c), t) for c, t in (("displace", "<u4"), ("stored", "<u4"), ("offsets", "<u8"), ("lengths", "<u8"))}
    return part["displace"], part["stored"], part["offsets"], part["lengths"]


def _entries(shard: int, row) -> pa.RecordBatch:
    """Every document of a shard, looked up through the index; of a shard without keys, one after another."""
    every, sizes = np.frombuffer(row.keys_, "<i8"), np.frombuffer(row.sizes, "<u8").astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    if not len(every):
        return _told(shard, pa.nulls(len(sizes), pa.int64()), begin, sizes, row.payload)
    keys, first, place = np.unique(every, return_index=True, return_inverse=True)
    displace, stored, offsets, lengths = _opened(row)
    as_keys = keys.view(np.uint64)
    slot = find_slots(as_keys, displace, len(stored))
    if not np.array_equal(stored[slot], key_print(as_keys)):
        raise ValueError(f"shard {shard}: the index does not hold its keys")
    if not np.array_equal(np.add.reduceat(sizes, first), lengths[slot].astype(np.int64)):
        raise ValueError(f"shard {shard}: the index does not hold its documents' lengths")
    # Documents that share a key lie side by side from the key's place on.
    starts = offsets[slot].astype(np.int64)[place] + begin - begin[first][place]
    return _told(shard, pa.array(every), starts, sizes, row.payload)


def _told(shard: int, doc_ids: pa.Array, starts: np.ndarray, sizes: np.ndarray, payload: bytes) -> pa.RecordBatch:
    raw = memoryview(payload)
    ends = zip((4 * starts).tolist(), (4 * (starts + sizes)).tolist())
    crcs = [zlib.crc32(raw[a:b]) for a, b in ends]
    columns = [np.full(len(sizes), shard), starts, sizes, np.array(crcs, np.int64)]
    shards, *others = [pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays([shards, doc_ids, *others], names=_ENTRY)


_ENTRY = ["shard", "doc_id", "begin", "n_tokens", "ids_crc32"]


def token_report(spark, folder: str) -> DataFrame:
    """Per document, read from the files through the index: doc_id, start, n_tokens, ids_crc32.

    Documents that share a doc_id have a row each, as have those without one.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one shard's bytes at a time
                row = batch.slice(i, 1).to_pylist()[0]
                yield _entries(row["shard"], SimpleNamespace(**row))

    ship_code(spark)
    shards = read_shards(spark, folder)
    parts = shards.select("shard", "payload", F.col("keys").alias("keys_"), "sizes", "displace", "stored", "offsets", "lengths")
    docs = parts.mapInArrow(told, ", ".join(f"{c} long" for c in _ENTRY))
    starts = shard_starts(shards.select("shard", "n_ids"))
    return docs.join(starts, "shard").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark, folder: str, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of the wanted keys(doc_id): constant-time access in the shard whose range holds the key.

    Keys that the files lack, and null keys, give no row; a repeated wanted key
    gives one; of rows that share a key all ids come as one array.
    """

    def got(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for row in pdf.itertuples():
                displace, stored, offsets, lengths = _opened(row)
                wanted = np.unique(np.array(row.wanted, np.int64))
                as_keys = wanted.view(np.uint64)
                slot = find_slots(as_keys, displace, len(stored))
                ids = np.frombuffer(row.payload, "<u4")
                # A fingerprint rules out almost every foreign key; the stored keys rule out the rest.
                own = np.isin(wanted, np.frombuffer(row.keys_, "<i8")) & (stored[slot] == key_print(as_keys))
                for key, s in zip(wanted[own].tolist(), slot[own].tolist()):
                    low = int(offsets[s])
                    found.append((key, ids[low : low + int(lengths[s])].astype(np.int64)))
            yield pd.DataFrame(found, columns=["doc_id", "ids"])

    ship_code(spark)
    shards = read_shards(spark, folder)
    listed = shards.where("first_doc is not null").select("shard", F.col("first_doc"))
    # The shard of a key is the last one that begins at or before it; shards of one task follow one another.
    marks = listed.select(F.col("first_doc").alias("at"), "shard", F.lit(None).cast("long").alias("key"))
    wanted = keys.select("doc_id").where("doc_id is not null").distinct()
    asked = wanted.select(F.col("doc_id").alias("at"), F.lit(None).cast("long").alias("shard"), F.col("doc_id").alias("key"))
    slices = marks.unionByName(asked).repartitionByRange("at").withColumn("slice", F.spark_partition_id())
    last = F.last("shard", ignorenulls=True)
    order = [F.col("at"), F.col("shard").asc_nulls_last()]
    local = slices.withColumn("near", last.over(Window.partitionBy("slice").orderBy(*order)))
    ends = local.groupBy("slice").agg(F.max("shard").alias("top"))
    carried = ends.select("slice", F.max("top").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    placed = local.where("key is not null").join(carried, "slice").select("key", F.coalesce("near", "carried").alias("shard"))
    groups = placed.where("shard is not null").groupBy("shard").agg(F.collect_list("key").alias("wanted"))
    columns = ["payload", F.col("keys").alias("keys_"), "displace", "stored", "offsets", "lengths", "wanted"]
    return shards.join(groups, "shard").select(*columns).mapInPandas(got, "doc_id long, ids array<long>")
