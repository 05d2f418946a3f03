"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from crawldelta.llm.scratch import ship_code

#: Segmentations given for each text.
N_BEST = 3

#: The sign for a space inside pieces, and the form of byte pieces.
SPACE = "▁"
BYTE_PIECE = "<0x%02X>"

#: Segments remembered in one Python worker, and the longest that is.
REMEMBERED = 150_000
_LONGEST = 64
#: Stands for the space sign itself, which is no space.
_LITERAL = None
#: In a text with a space in front: what is not cut and looked up in Arrow.
_UNSURE = re.compile(f"{SPACE}|  |\x00")

#: As many parts of one length are scored together; fewer are scored one by one.
_TOGETHER = 24

#: Below every piece's score, for each byte of a character that no piece holds.
_BYTE_COST = 1e6

#: Where a text is cut: before a space sign, and between letters and other signs.
_CUT = regex.compile(rf"{SPACE}+\p{{L}}*|\p{{L}}+|[^\p{{L}}{SPACE}]+")
_KINDS = (rf"(\pL)([^\pL{SPACE}\x00])", rf"([^\pL{SPACE}\x00])(\pL)")
_MODELS: dict[tuple[str, int], "Lattice"] = {}


class PieceTable:
    """All pieces as rows of code points with a hash index, to score many parts of one length at once."""

    def __init__(self, scores: dict[str, tuple[float, int]]):
        pieces = list(scores)
        self.longest = max(map(len, pieces))
        self.codes = np.zeros((len(pieces), self.longest), np.uint32)
        for i, p in enumerate(pieces):
            self.codes[i, : len(p)] = [ord(c) for c in p]
        self.scores = np.array([scores[p][0] for p in pieces])
        self.ids = np.array([scores[p][1] for p in pieces], np.int32)
        hashes = np.zeros(len(pieces), np.uint64)
        lengths = np.array([len(p) for p in pieces])
        for k in range(self.longest):
            on = lengths > k
            hashes[on] = self._add(hashes[on], self.codes[on, k])
        order = np.argsort(hashes)
        self.hashes, self.order, self.lengths = hashes[order], order, lengths[order]
        # Where the hashes with the same leading bits begin.
        self.begin = np.searchsorted(self.hashes, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
        self.most = int(np.diff(np.append(self.begin, len(pieces))).max())

    @staticmethod
    def _add(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The hashes of strings with one more character."""
        h = (hashes ^ codes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def _find(self, hashes: np.ndarray, rows: np.ndarray, start: int, length: int) -> np.ndarray:
        """Row of the piece that equals each string, -1 without one. A hash leads there; the characters decide."""
        found = np.full(len(hashes), -1, np.int64)
        at = self.begin[(hashes >> np.uint64(48)).astype(np.int64)]
        left = np.arange(len(hashes))
        for _ in range(self.most):
            at, left = at[(ok := at < len(self.hashes))], left[ok]
            seen = self.hashes[at]
            hit = (seen == hashes[left]) & (self.lengths[at] == length)
            found[left[hit]] = self.order[at[hit]]
            go = (seen < hashes[left]) | (seen == hashes[left]) & ~hit
            at, left = at[go] + 1, left[go]
            if not len(left):
                break
        some = np.flatnonzero(found >= 0)
        same = (self.codes[found[some], :length] == rows[some, start : start + length]).all(1)
        found[some[~same]] = -1
        return found

    def score_all(self, parts: list[str], size: int, model: "Lattice") -> tuple[list[bytes], list[float], list[float]]:
        """What Lattice._viterbi gives for each of the parts, all of one length, in columns."""
        rows = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, size)
        count = len(parts)
        edges: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # start, end, score, piece
        for start in range(size):
            hashes = np.zeros(count, np.uint64)
            for end in range(start + 1, min(size, start + self.longest) + 1):
                hashes = self._add(hashes, rows[:, end - 1])
                piece = self._find(hashes, rows, start, end - start)
                score = np.where(piece >= 0, self.scores[piece], -np.inf)
                edges.append((start, end, score, piece))
        ahead = np.full((size + 1, count), -np.inf)
        ahead[0] = 0
        back = np.zeros((size + 1, count), np.int64)
        via = np.zeros((size + 1, count), np.int64)
        for start, end, score, piece in edges:
            total = ahead[start] + score
            better = total > ahead[end]
            ahead[end][better] = total[better]
            back[end][better] = start
            via[end][better] = piece[better]
        behind = np.full((size + 1, count), -np.inf)
        behind[size] = 0
        for start, end, score, _ in reversed(edges):
            np.maximum(behind[start], score + behind[end], out=behind[start])
        on = np.zeros((size + 1, count), bool)  # ends of the best path's pieces
        at, every = np.full(count, size), np.arange(count)
        ids = np.zeros((count, size), "<i4")  # filled from the right
        steps = np.zeros(count, np.int64)
        for _ in range(size):
            live = every[(at > 0) & np.isfinite(ahead[size])]
            if not len(live):
                break
            end = at[live]
            on[end, live] = True
            steps[live] += 1
            ids[live, size - steps[live]] = self.ids[via[end, live]]
            at[live] = back[end, live]
        second = np.full(count, -np.inf)
        for start, end, score, _ in edges:
            used = on[end] & (back[end] == start)
            np.maximum(second, np.where(used, -np.inf, ahead[start] + score + behind[end]), out=second)
        raw = ids.tobytes()
        best = ahead[size].tolist()
        with np.errstate(invalid="ignore"):  # no path at all
            lost = (ahead[size] - second).tolist()
        out = [raw[4 * (size * (i + 1) - n) : 4 * size * (i + 1)] for i, n in enumerate(steps.tolist())]
        for i in np.flatnonzero(ahead[size] == -np.inf).tolist():  # a character that no piece holds
            out[i], best[i], lost[i] = model._viterbi(parts[i])
        return out, best, lost


class Lattice:
    """The pieces of one model file and their scores.

    A text gets a space in front, spaces become the space sign, and every path
    of pieces through the characters is a segmentation; its score is the sum of
    the pieces' scores. Characters that no piece holds, and the space sign
    itself where it stands in a text, are written as byte pieces, so that
    decoding gives back every text. No piece goes on past a non-space into a
    space, or holds letters beside other signs, so texts are cut there and the
    parts' segmentations combined.
    """

    def __init__(self, path: str, n: int = N_BEST):
        import sentencepiece

        self.n = n
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
        self.scores = {model.id_to_piece(i): (model.get_score(i), i) for i in range(size) if not special[i]}
        self.byte_ids = [model.piece_to_id(BYTE_PIECE % b) for b in range(256)]
        self.bytes_of = [b"" if special[i] else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for value, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([value])
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece holds a space after other characters; texts can't be cut at spaces")
        self.longest = max(map(len, self.scores))
        self.trie: dict = {}
        for piece, (score, _) in self.scores.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = score
        self.table = PieceTable(self.scores)
        self.inside = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        if any(a != SPACE and a.isalpha() != b.isalpha() for a, b in self.inside):
            raise ValueError("a piece holds letters beside other signs; texts can't be cut there")
        self._forget()

    def _spelled(self, char: str) -> tuple[float, tuple[int, ...]]:
        raw = char.encode("utf-8", "surrogatepass")
        return -_BYTE_COST * len(raw), tuple(self.byte_ids[b] for b in raw)

    def edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end position the (start, score, ids) of what can end there."""
        get, ends = self.scores.get, [[] for _ in range(len(text) + 1)]
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                if hit := get(text[start:end]):
                    ends[end].append((start, hit[0], (hit[1],)))
            if text[end - 1] not in self.scores:
                ends[end].append((end - 1, *self._spelled(text[end - 1])))
        return ends

    def best_of(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best (score, ids) of a marked text, best first; ties in the order of the search, which is always the same.

        Forward: the best score to each position. Backward: A-star from the
        end, where a partial path's bound is its own score plus the forward
        score of its position, which is exact; so paths come out in order. Of
        equal bounds the one nearest to the start goes on, and a position goes
        on n times at most: later paths through it are behind n others. So the
        heap grows with the text's length only.
        """
        ends = self.edges(text)
        ahead = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start, score, _ in ends[end]:
                if ahead[start] + score > ahead[end]:
                    ahead[end] = ahead[start] + score
        found, made, left = [], 0, [n] * (len(text) + 1)
        heap = [(-ahead[-1], len(text), 0, 0.0, None)]
        while heap and len(found) < n:
            _, at, _, behind, link = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while link:
                    ids.extend(link[0])
                    link = link[1]
                found.append((behind, tuple(ids)))
                continue
            if not left[at]:
                continue
            left[at] -= 1
            for start, score, own in ends[at]:
                made += 1
                heapq.heappush(heap, (-(ahead[start] + behind + score), start, -made, behind + score, (own, link)))
        return found

    def _viterbi(self, part: str) -> tuple[bytes, float, float]:
        """(ids as bytes, score, loss of the second best) by the forward and the backward scores of every edge.

        The second best path uses an edge off the best one; the best path
        through an edge scores forward + edge + backward.
        """
        size = len(part)
        ahead, back, edges = [0.0] + [-np.inf] * size, [0] * (size + 1), []
        for start in range(size):
            here, node = ahead[start], self.trie
            for end in range(start, size):
                node = node.get(part[end])
                if node is None:
                    break
                score = node.get("")
                if score is not None:
                    edges.append((start, end + 1, score))
                    if here + score > ahead[end + 1]:
                        ahead[end + 1], back[end + 1] = here + score, start
            if part[start] not in self.scores:
                score = self._spelled(part[start])[0]
                edges.append((start, start + 1, score))
                if here + score > ahead[start + 1]:
                    ahead[start + 1], back[start + 1] = here + score, start
        behind, second = [-np.inf] * size + [0.0], -np.inf
        for start, end, score in reversed(edges):
            rest = score + behind[end]
            if rest > behind[start]:
                behind[start] = rest
        ids, on, at = [], set(), size
        while at:
            start = back[at]
            on.add((start, at))
            piece = part[start:at]
            ids.append((self.scores[piece][1],) if piece in self.scores else self._spelled(piece)[1])
            at = start
        for start, end, score in edges:
            through = ahead[start] + score + behind[end]
            if through > second and (start, end) not in on:
                second = through
        flat = [i for own in reversed(ids) for i in own]
        return np.array(flat, "<i4").tobytes(), ahead[size], ahead[size] - second

    def _forget(self) -> None:
        """What is remembered: each segment's place in the columns of ids, scores and losses of the second best."""
        self.place: dict[str | None, int] = {}
        self.ids: list[bytes] = []
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self._remember([""], [b""], [0.0], [np.inf])  # between two cuts
        score, ids = self._spelled(SPACE)
        self._remember([_LITERAL], [np.array(ids, "<i4").tobytes()], [score], [np.inf])

    def _remember(self, segs: list, ids: list[bytes], scores: list[float], losses: list[float]) -> None:
        self.place.update(zip(segs, range(len(self.ids), len(self.ids) + len(segs))))
        self.ids += ids
        self.score = np.concatenate((self.score, scores))
        self.loss = np.concatenate((self.loss, losses))

    def learn(self, segs: Iterable[str | None]) -> None:
        """Remember the segments that are new; those of one length are scored together."""
        new = set(segs).difference(self.place)
        if len(self.ids) + len(new) > REMEMBERED:
            self._forget()
            new = set(segs).difference(self.place)
        by_length: dict[int, list[str]] = {}
        for seg in new:
            by_length.setdefault(len(seg), []).append(seg)
        for length, same in by_length.items():
            if length <= _LONGEST and len(same) >= _TOGETHER:
                self._remember(same, *self.table.score_all(same, length, self))
            else:
                self._remember(same, *map(list, zip(*map(self._viterbi, same))))

    def segments(self, text: str | None) -> list[str]:
        """A raw text's segments in order. The space sign itself is no space: it stands as a segment of its own."""
        if not text:
            return []
        if SPACE not in text:
            return _CUT.findall((" " + text).replace(" ", SPACE))
        found: list[str] = []
        for i, plain in enumerate((" " + text).split(SPACE)):
            found += [_LITERAL] * bool(i)
            found += _CUT.findall(plain.replace(" ", SPACE))
        return found

    def encode_many(self, texts: list[str | None]) -> list[list[tuple[float, bytes]]]:
        """encode() of each text. Texts with single spaces only are cut in Arrow, and each distinct segment is looked up once."""
        spaced = [" " + (t or "") for t in texts]
        easy = [i for i, t in enumerate(spaced) if len(t) > 1 and not _UNSURE.search(t)]
        out: list = [None] * len(texts)
        for i, found in zip(easy, self._encode_easy([spaced[i] for i in easy]) if easy else []):
            out[i] = found
        for i, found in enumerate(out):
            if found is None:
                segs = self.segments(texts[i])
                self.learn(segs)
                out[i] = self._ranked(segs)
        return out

    def _encode_easy(self, spaced: list[str]) -> Iterator[list[tuple[float, bytes]]]:
        marked = pc.replace_substring(pa.array(spaced, pa.large_string()), " ", f"\x00{SPACE}")
        for kinds in _KINDS:
            marked = pc.replace_substring_regex(marked, kinds, "\\1\x00\\2")
        cut = pc.split_pattern(marked, "\x00")
        coded = cut.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.learn(words)
        places = list(map(self.place.__getitem__, words))
        ids = pa.array([self.ids[i] for i in places], pa.large_binary()).take(coded.indices)
        begin = np.frombuffer(ids.buffers()[1], np.int64)
        raw = memoryview(ids.buffers()[2] or b"")
        score, loss = self.score[places][at], self.loss[places][at]
        ends = cut.offsets.to_numpy()
        ends = (ends - ends[0]).tolist()
        for low, high in zip(ends, ends[1:]):
            first, last = int(begin[low]), int(begin[high])
            best, total = bytes(raw[first:last]), float(score[low:high].sum())
            found = [(total, best)]
            if self.n > 1:
                own, most = loss[low:high], min(self.n - 1, high - low)
                free = [low + i for i in sorted(np.argpartition(own, most - 1)[:most].tolist()) if own[i] < np.inf]
                places = [(int(begin[i]) - first, int(begin[i + 1]) - first) for i in free]
                found += self._others(total, best, [words[at[i]] for i in free], places)
            yield found

    def _others(self, total: float, best: bytes, free: list[str], places: list[tuple[int, int]]) -> list[tuple[float, bytes]]:
        """The next best of a text, which differ from the best only in these segments, at these places of its ids."""
        lists = []
        for seg, (low, high) in zip(free, places):
            ranked = [(s, np.array(ids, "<i4").tobytes()) for s, ids in self.best_of(seg, self.n)]
            # The chosen one of equally good segmentations stands first, and only once.
            lists.append([(ranked[0][0], best[low:high]), *[r for r in ranked if r[1] != best[low:high]]][: self.n])
        base = sum(ranked[0][0] for ranked in lists)
        out = []
        for score, choice in choices([[s for s, _ in ranked] for ranked in lists], self.n)[1:]:
            parts, at = [], 0
            for (low, high), k, ranked in zip(places, choice, lists):
                parts += [best[at:low], ranked[k][1]]
                at = high
            out.append((total - base + score, b"".join([*parts, best[at:]])))
        return out

    def encode(self, text: str | None) -> list[tuple[float, bytes]]:
        """The n best (score, ids as little-endian 32-bit bytes) of a whole text, best first; one empty one without text."""
        return self.encode_many([text])[0]

    def _ranked(self, segs: list[str]) -> list[tuple[float, bytes]]:
        """The n best of a text's remembered segments."""
        places = [self.place[seg] for seg in segs]
        best = [self.ids[i] for i in places]
        total = float(self.score[places].sum())
        out = [(total, b"".join(best))]
        n = self.n
        if n == 1 or not segs:
            return out
        # Only the n - 1 segments that lose least by their second best can differ in the n best.
        free: list[int] = []
        for seg in heapq.nsmallest(n - 1, dict.fromkeys(segs), key=lambda s: self.loss[self.place[s]]):
            at = -1
            while len(free) < n - 1 and self.loss[self.place[seg]] < np.inf:
                try:
                    at = segs.index(seg, at + 1)
                except ValueError:
                    break
                free.append(at)
        free.sort()
        ends = np.cumsum([0, *map(len, best)]).tolist()
        return out + self._others(total, out[0][1], [segs[i] for i in free], [(ends[i], ends[i + 1]) for i in free])

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of a segmentation, byte pieces included."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw[1:].decode("utf-8", "surrogatepass")

    def spells(self, ids: list[bytes], texts: list[str | None]) -> list[bool]:
        """True where decoding a text's ids gives the text."""
        flat = np.frombuffer(b"".join(ids), "<i4")
        spelled = pa.array(self.bytes_of, pa.large_binary()).take(pa.array(flat))
        begin = np.frombuffer(spelled.buffers()[1], np.int64)
        raw = memoryview(spelled.buffers()[2] or b"").cast("B")
        ends = begin[np.cumsum([0, *[len(b) // 4 for b in ids]])].tolist()
        plain = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        return [raw[a:b] == t for a, b, t in zip(ends, ends[1:], plain)]


def choices(lists: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best sums of one score from each list, each list best first, with the places chosen."""
    start = (0,) * len(lists)
    heap = [(-sum(s[0] for s in lists), start)]
    seen, out = {start}, []
    while heap and len(out) < n:
        lost, at = heapq.heappop(heap)
        out.append((-lost, at))
        for i, scores in enumerate(lists):
            if at[i] + 1 < len(scores):
                nxt = at[:i] + (at[i] + 1,) + at[i + 1 :]
                if nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (lost + scores[at[i]] - scores[at[i] + 1], nxt))
    return out


def lattice(path: str, n: int = N_BEST) -> Lattice:
    """The model's lattice, read once per worker."""
    if (path, n) not in _MODELS:
        _MODELS[path, n] = Lattice(path, n)
    return _MODELS[path, n]


_RANKED = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))
_DDL = "doc_id long, n_pieces long, ids array<int>, score double, others array<struct<score:double,ids:array<int>>>, round_trip boolean"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("score", pa.float64()), ("others", _RANKED)]
    + [("round_trip", pa.bool_())]
)


def _lists(parts: list[bytes]) -> pa.Array:
    counts = np.array([0, *(len(p) // 4 for p in parts)], np.int64).cumsum()
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32()))


def encode_documents(docs: DataFrame, model: str, n: int = N_BEST) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids and score (the best segmentation), others (the next n - 1), round_trip.

    round_trip tells that decoding the ids gives the text again. Null and empty
    texts have no pieces, score 0 and no others; a text of few segmentations has fewer others;
    repeated rows stay repeated; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model, n)
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                texts = batch.column("text").to_pylist()
                ranked = own.encode_many(texts)
                best = [r[0][1] for r in ranked]
                same = own.spells(best, texts)
                every = [x for r in ranked for x in r[1:]]
                structs = pa.StructArray.from_arrays(
                    [pa.array([s for s, _ in every], pa.float64()), _lists([b for _, b in every])], names=["score", "ids"]
                )
                offsets = pa.array(np.array([0, *[len(r) - 1 for r in ranked]]).cumsum(), pa.int32())
                columns = [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(b) // 4 for b in best], pa.int64()),
                    _lists(best),
                    pa.array([r[0][0] for r in ranked], pa.float64()),
                    pa.ListArray.from_arrays(offsets, structs),
                    pa.array(same, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    ship_code(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, _DDL)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model)
        for batch in batches:
            texts = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    ship_code(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
