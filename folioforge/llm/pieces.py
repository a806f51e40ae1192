"""SentencePiece encoding and decoding by suffix-array matching.

The distinct segments of a batch's texts are concatenated and their suffixes sorted; every piece of the vocabulary is binary-searched for
its range of suffixes, which are its occurrences. These edges are sorted by position and relaxed. For a unigram model that is the path of
greatest score: edges are relaxed in order of their ends, all segments at once. For a model of scored merges, the
applicable edge of best score, the leftmost of equals, is settled in each segment, round by round, until none is left. An edge
applies if its ends are borders of present symbols and just one border lies between.

A segment is a run of blanks (U+2581) and what follows up to the next blank. No piece of such a model holds a blank after another
character (checked on loading), so no merge crosses segments, and segments can be matched once, however often they occur.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
ROOM = 200_000  # segments whose ids a task remembers
CHARS = 400_000  # characters that are indexed at once, if no segment is longer
ROUNDS = 24


def default_model() -> str:
    """The public vocabulary that every machine here has. Elsewhere pass a path: one that executors can open, or a file's name that
    SparkContext.addFile has shipped."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def local_path(path: str) -> str:
    """On an executor: the file itself, or where addFile put it."""
    from pyspark import SparkFiles

    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def model_type(data: bytes) -> int:
    """1: unigram, 2: merges, of a vocabulary file (field 3 of its second field, in protocol buffers)."""

    def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def number() -> int:
            nonlocal at
            n = shift = 0
            while True:
                n |= (b[at] & 127) << shift
                at, shift = at + 1, shift + 7
                if b[at - 1] < 128:
                    return n

        while at < len(b):
            tag = number()
            if tag & 7 == 0:
                yield tag >> 3, number()
            else:
                size = number() if tag & 7 == 2 else 8 if tag & 7 == 1 else 4
                yield tag >> 3, b[at : at + size]
                at += size

    kind = 1
    for field, value in fields(data):
        if field == 2 and isinstance(value, bytes):
            kind = next((v for f, v in fields(value) if f == 3 and isinstance(v, int)), kind)
    return kind


class Model:
    """A vocabulary file's pieces and scores. Identity normalisation, a blank put before the text, byte fallback if there are byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        self.unigram = (kind := model_type(data)) == 1
        if kind not in (1, 2):
            raise ValueError("neither a unigram model nor one of merges")
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unk = sp.unk_id()
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        usual = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(re.search(f"[^{BLANK}]{BLANK}", self.pieces[i]) for i in usual):
            raise ValueError("a piece holds a blank after another character")
        self.id_of = {self.pieces[i]: i for i in usual}
        if BLANK not in self.id_of:
            raise ValueError("no piece for a blank")
        scores = sorted({sp.get_score(i) for i in usual}, reverse=True)
        self.score = np.array([sp.get_score(i) for i in range(n)], np.float32)
        self.unknown = np.float32(min(scores, default=0.0) - 10)  # of a character without a piece, on a path
        order = {s: r for r, s in enumerate(scores)}
        self.alphabet = {c: k + 2 for k, c in enumerate(sorted({c for p in self.id_of for c in p}))}  # 0: border, 1: any other
        if len(self.alphabet) > 65_000:
            raise ValueError("more characters than 16-bit codes")
        self.codes = np.ones(0x110000, np.uint16)
        self.codes[[ord(c) for c in self.alphabet]] = list(self.alphabet.values())
        self.long = np.array([i for i in usual if len(self.pieces[i]) > 1], np.int64)
        self.length = np.array([len(self.pieces[i]) for i in self.long], np.int32)
        self.rank = np.array([order[sp.get_score(int(i))] for i in self.long], np.int32)
        self.words = -(-int(self.length.max(initial=1)) // 4)
        self.low, self.high = self.packed(0), self.packed(0xFFFF)
        self.single = np.full(len(self.alphabet) + 2, -1, np.int64)
        self.single[[k for c, k in self.alphabet.items() if c in self.id_of]] = [self.id_of[c] for c in self.alphabet if c in self.id_of]
        self.raw = [b"" if sp.is_control(i) else bytes((int(p[3:5], 16),)) if sp.is_byte(i) else p.replace(BLANK, " ").encode() if i != self.unk else " ⁇ ".encode() for i, p in enumerate(self.pieces)]

    def packed(self, pad: int) -> list[np.ndarray]:
        """Pieces as 64-bit words of four 16-bit codes, first character first."""
        m = np.full((len(self.long), 4 * self.words), pad, np.uint64)
        for r, i in enumerate(self.long):
            m[r, : self.length[r]] = self.codes[[ord(c) for c in self.pieces[i]]]
        m = m.reshape(len(self.long), self.words, 4)
        return list((m[:, :, 0] << np.uint64(48) | m[:, :, 1] << np.uint64(32) | m[:, :, 2] << np.uint64(16) | m[:, :, 3]).T)

    def edges(self, text: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all occurrences of pieces of two characters or more, sorted by position. room: characters up to the segment's end."""
        n = len(text)
        t = np.concatenate([text, np.zeros(4 * self.words + 4, np.uint16)]).astype(np.uint64)
        four = t[:-3] << np.uint64(48) | t[1:-2] << np.uint64(32) | t[2:-1] << np.uint64(16) | t[3:]
        # a suffix ends with its segment: of four characters the first so many count
        count = np.array([0, 0xFFFF << 48, 0xFFFFFFFF << 32, 0xFFFFFFFFFFFF << 16, 0xFFFFFFFFFFFFFFFF], np.uint64)
        keys = [four[4 * j : 4 * j + n] & count[np.clip(room - 4 * j, 0, 4)] for j in range(self.words)]
        suffix = np.argsort(keys[0])
        for j in range(1, self.words):  # stretches that are equal so far and go on, by their next characters
            same = np.ones(n - 1, bool)
            for k in keys[:j]:
                same &= k[suffix[1:]] == k[suffix[:-1]]
            tied = np.flatnonzero((np.r_[False, same] | np.r_[same, False]) & (room[suffix] > 4 * j))
            if not len(tied):
                break
            run = np.cumsum(np.r_[True, ~same])
            whole = np.flatnonzero(np.isin(run, np.unique(run[tied]))) if len(tied) < n // 8 else np.flatnonzero(np.r_[False, same] | np.r_[same, False])
            suffix[whole] = suffix[whole][np.lexsort((keys[j][suffix[whole]], run[whole]))]
        keys = [k[suffix] for k in keys]

        def bound(piece: list[np.ndarray], after: bool) -> np.ndarray:
            lo, hi = np.zeros(len(piece[0]), np.int64), np.full(len(piece[0]), n)
            while (open_ := lo < hi).any():
                mid = np.minimum((lo + hi) // 2, n - 1)
                less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
                for k, p in zip(keys, piece, strict=True):
                    k = k[mid]
                    less |= same & (k < p)
                    same &= k == p
                less |= same & after
                lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
            return lo

        lo, hi = bound(self.low, False), bound(self.high, True)
        some = np.flatnonzero(hi > lo)
        count = (hi - lo)[some]
        piece = np.repeat(some, count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[some], count)
        start, size = suffix[at], self.length[piece]
        order = np.argsort(start * 4 * (self.words + 1) + size)
        start, piece = start[order].astype(np.int32), piece[order].astype(np.int32)
        return start, start + size[order], piece

    def segment(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of piece ids of each segment, and all their ids one after the other."""
        joined = "\0".join(segments) + "\0"
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        first = np.cumsum(size + 1) - size - 1
        text = self.codes[chars]
        text[first + size] = 0
        start, end, piece = self.edges(text, np.repeat((first + size).astype(np.int32), size + 1) - np.arange(len(text), dtype=np.int32))
        if self.unigram:
            return self._best(text, chars, first, size, start, end, piece)
        border = np.ones(len(text) + 1, np.int8)
        owner = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)[start]
        rank = self.rank[piece]
        symbol = self.single[text]  # at each border: the id of the symbol that starts there, -1 for a character without one
        for _ in range(ROUNDS):
            if not len(start):
                break
            before = np.concatenate([[0], np.cumsum(border, dtype=np.int32)])
            inner = before[end] - before[start + 1]
            alive = np.flatnonzero((border[start] & border[end]).astype(bool) & (inner > 0))
            start, end, rank, owner, piece, inner = start[alive], end[alive], rank[alive], owner[alive], piece[alive], inner[alive]
            now = np.flatnonzero(inner == 1)
            if not len(now):
                start = start[:0]
                break
            key = rank[now].astype(np.int64) * len(text) + start[now]
            group = np.flatnonzero(np.r_[True, np.diff(owner[now]) != 0])
            best = np.minimum.reduceat(key, group)
            own = np.repeat(best, np.diff(np.r_[group, len(now)]))
            won = now[key == own]
            symbol[start[won]] = self.long[piece[won]]
            for j in range(1, int((end[won] - start[won]).max())):  # the one border inside goes
                p = start[won] + j
                border[p[p < end[won]]] = 0
        if len(start):
            _settle(border, symbol, start, end, rank, self.long[piece])
        at = np.flatnonzero(border[:-1])
        at = at[text[at] != 0]
        return self._spelt(symbol[at], chars[at], at, first, len(segments))

    def _best(self, text: np.ndarray, chars: np.ndarray, first: np.ndarray, size: np.ndarray, start: np.ndarray, end: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """segment() for a unigram model: paths of greatest score, of equals the one whose last piece is longest. A character without a piece can
        always be stepped over, at a score below any piece's. Scores are summed within a segment; the library sums over a whole text, so where
        paths are equal but for rounding it may choose another."""
        inside = np.flatnonzero(text != 0)
        one = self.single[text[inside]]
        start, end = np.concatenate([start, inside]), np.concatenate([end, inside + 1])
        ids = np.concatenate([self.long[piece], one])
        score = np.concatenate([self.score[self.long[piece]], np.where(one >= 0, self.score[one], self.unknown)])
        owner = np.searchsorted(first, start, "right") - 1
        order = np.lexsort((start, end, end - first[owner]))  # all edges that end so many characters into their segments, then by end and start
        start, end, ids, score, depth = start[order], end[order], ids[order], score[order], (end - first[owner])[order]
        total, back = np.zeros(len(text) + 1, np.float32), np.full(len(text) + 1, -1, np.int64)
        cuts = np.flatnonzero(np.r_[True, np.diff(depth) != 0, True]) if len(depth) else np.zeros(1, np.int64)
        for a, z in zip(cuts, cuts[1:]):
            cand, to = total[start[a:z]] + score[a:z], end[a:z]
            group = np.flatnonzero(np.r_[True, np.diff(to) != 0])
            top = np.maximum.reduceat(cand, group)
            hit = np.flatnonzero(cand == np.repeat(top, np.diff(np.r_[group, z - a])))
            hit = hit[np.r_[True, np.diff(to[hit]) != 0]]  # the first of equals starts first
            total[to[hit]], back[to[hit]] = top, a + hit
        used, at = [], (first + size)[size > 0]
        while len(at):  # one step back in every segment
            e = back[at]
            used.append(e)
            at = start[e]
            at = at[~np.isin(at, first)]
        e = np.concatenate([np.zeros(0, np.int64), *used])
        e = e[np.argsort(start[e], kind="stable")]
        return self._spelt(ids[e], chars[start[e]], start[e], first, len(size))

    def _spelt(self, ids: np.ndarray, chars: np.ndarray, at: np.ndarray, first: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids with characters that have no piece (-1) as their bytes, or as the unknown piece, once for several in a row."""
        count = np.ones(len(at), np.int64)
        lost = np.flatnonzero(ids < 0)
        if len(lost):  # characters without a piece: their bytes, or the unknown piece
            own = np.searchsorted(first, at[lost], "right")
            goes_on = np.r_[False, (np.diff(lost) == 1) & (np.diff(own) == 0)]
            fall = [[self.byte[b] for b in chr(c).encode("utf-8", "surrogatepass")] if self.byte else [self.unk] * (not more) for c, more in zip(chars[lost].tolist(), goes_on.tolist(), strict=True)]
            count[lost] = [len(f) for f in fall]
            whole = np.repeat(ids, count)
            whole[np.repeat(np.isin(np.arange(len(at)), lost), count)] = [x for f in fall for x in f]
            ids = whole
        sizes = np.bincount(np.searchsorted(first, at, "right") - 1, count, minlength=segments).astype(np.int64)
        return sizes, ids.astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _settle(border: np.ndarray, symbol: np.ndarray, start: np.ndarray, end: np.ndarray, rank: np.ndarray, piece: np.ndarray) -> None:
    """The rest of long segments: the same merges from a heap. An edge is looked at again when a border inside it goes."""
    by_place: dict[int, list[int]] = {}
    for e, (s, t) in enumerate(zip(start.tolist(), end.tolist(), strict=True)):
        for p in range(s + 1, t):
            by_place.setdefault(p, []).append(e)
    heap = [(r, s, e) for r, s, e in zip(rank.tolist(), start.tolist(), range(len(start)), strict=True)]
    heapq.heapify(heap)

    def inside(e: int) -> np.ndarray:
        return np.flatnonzero(border[start[e] + 1 : end[e]]) + start[e] + 1

    while heap:
        _, s, e = heapq.heappop(heap)
        if not (border[s] and border[end[e]]) or len(at := inside(e)) != 1:
            continue
        border[at[0]] = 0
        symbol[s] = piece[e]
        for f in by_place[int(at[0])]:
            if border[start[f]] and border[end[f]] and len(inside(f)) == 1:
                heapq.heappush(heap, (int(rank[f]), int(start[f]), f))


@cache
def model(path: str) -> Model:
    return Model(local_path(path))


class Encoder:
    """Texts to ids, with the ids of up to ROOM segments remembered. Segments of one call are indexed together."""

    def __init__(self, path: str):
        self.model = model(path)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, segments: list[str]) -> None:
        part, chars = [], 0
        for i, s in enumerate(segments):
            part.append(s)
            chars += len(s) + 1
            if chars >= CHARS or i == len(segments) - 1:
                sizes, ids = self.model.segment(part)
                self.at.update(zip(part, range(len(self.at), len(self.at) + len(part)), strict=True))
                self.size = np.concatenate([self.size, sizes])
                self.flat = np.concatenate([self.flat, ids])
                part, chars = [], 0

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = []
        for t in texts:
            if not t:
                split.append([])
            elif BLANK in t or "  " in t or t[0] == " " or t[-1] == " ":
                split.append(SEGMENT.findall(BLANK + t.replace(" ", BLANK)))
            else:
                split.append((BLANK + t.replace(" ", " " + BLANK)).split(" "))
        if len(self.at) > ROOM:
            self.clear()
        new = [s for s in set().union(*split) if s not in self.at]
        if new:
            self.learn(new)
        first = np.cumsum(self.size) - self.size
        out = []
        for x in split:
            k = np.fromiter(map(self.at.__getitem__, x), np.int64, len(x))
            n = self.size[k]
            ends = np.cumsum(n)
            out.append(self.flat[np.arange(n.sum()) + np.repeat(first[k] - ends + n, n)])
        return out


def _slices(texts: pa.Array, chars: int = 4_000_000) -> Iterator[list[str | None]]:
    """A batch's texts, some at a time: as many as have about `chars` bytes together."""
    part, n = [], 0
    for t in texts:
        part.append(t.as_py())
        n += len(part[-1] or "")
        if n >= chars:
            yield part
            part, n = [], 0
    if part:
        yield part


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """documents -> (doc_id, ids array<int>). Null text: null; empty text: no ids. A row per row; other columns are ignored."""
    path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in batches:
            at = 0
            for part in _slices(b.column(1)):
                ids = [None if t is None else i for t, i in zip(part, enc.encode(part), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
                at += len(part)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text). Null ids: null; bytes that are no UTF-8 become U+FFFD, an id out of range is an error."""
    path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.decode(i.values.to_pylist()) if i.is_valid else None for i in b.column(1)], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """documents -> (doc_id, n_chars, n_tokens, ids_sha256, decoded_sha256, same[, ids]); encoded and decoded in one pass.

    ids_sha256: of the ids as 32-bit little-endian integers; decoded_sha256: of the decoded text in UTF-8; same: it equals the text (false
    for a text that itself holds U+2581, which stands for a blank). Null text: no tokens, an empty decoded text and same null. A row per
    row; an empty table gives an empty result; other columns are ignored.
    """
    path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in batches:
            at = 0
            for part in _slices(b.column(1)):
                rows = []
                for t, ids in zip(part, enc.encode(part), strict=True):
                    back = enc.model.decode(ids.tolist())
                    rows.append((len(t or ""), len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), None if t is None else back == t, ids if with_ids else None))
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32())), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), *cols], ["doc_id", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256", "same", "ids"])
                at += len(part)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_chars long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean, ids array<int>")
    return out if with_ids else out.drop("ids")
