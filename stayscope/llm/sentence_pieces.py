"""SentencePiece encoding and decoding for merge-type vocabularies, checked against the library.

Encoding keeps an agenda of adjacent symbol pairs ordered by score, best first and leftmost
among equals: the best pair that still stands is merged, and the pairs that the merge created
join the agenda. Characters outside the vocabulary become byte pieces.

No piece of such a vocabulary usually has a space symbol after another character; then no merge
crosses into the next run of spaces and a text falls apart into segments, a run of space symbols
and what follows it, that are encoded once per worker process and remembered. (If a vocabulary has such a
piece, the whole text is one segment.) The new short segments of a batch are merged side by side: each has
a row of its pairs' ranks as its agenda, and every round merges the best pair of every row. Every new segment of an Arrow batch is also encoded and
decoded by the sentencepiece library, a hundred in a text and all texts in one call, before the
batch is passed on; a difference stops the job. ``check="texts"`` compares all whole texts instead.

The model's file is read on the driver and sent to the tasks (its size is bounded: one
vocabulary), so workers need no file. A worker's memory is bounded by the batch and
``MEMORY_SEGMENTS`` remembered segments (about 200 bytes each); it is emptied when full.

Edge cases: null and empty texts have no pieces but the end id; whitespace is kept as it is; very
long words cost n log n; rows are independent, so ties and repeated rows need no rule; an empty
table gives none. Other columns pass through; clashing names are replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import sys
import types
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import map_text, ship

SPACE = "▁"
MEMORY_SEGMENTS = 300_000
#: Where a worker process keeps its segments between tasks.
MEMORY_NAME = "_segments_of_this_worker"
CHECKED_TOGETHER = 100
PLACE_BITS = 40
PLACE = (1 << PLACE_BITS) - 1
RANK = ~PLACE
#: Characters, with the space symbol, up to which segments are merged side by side, by width of the rows.
WIDTHS = (3, 5, 7, 9, 11, 13, 16, 20, 26, 34)
ROWS_TOGETHER = 1 << 15
NO_RANK = np.iinfo(np.int32).max
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")


def each_byte(error):
    """Every undecodable byte on its own becomes the replacement character."""
    return "�" * (error.end - error.start), error.end


class PairTable:
    """Rank and number of the merger of two symbols, looked up for many pairs at once."""

    def __init__(self, pairs: dict[int, int]):
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        packed = np.fromiter(pairs.values(), np.int64, len(pairs))
        self.bits = max(4, int(len(pairs) * 6).bit_length())
        # One slot more than there are, so that a pair's slot and the next ones need no wrapping.
        size = (1 << self.bits) + len(pairs) + 1
        self.keys = np.full(size, -1, dtype=np.int64)
        self.rank = np.full(size, NO_RANK, dtype=np.int32)
        self.own = np.zeros(size, dtype=np.int32)
        slots, left = self.slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] < 0]
            taken, first = np.unique(slots[free], return_index=True)
            self.keys[taken] = keys[free[first]]
            left = left[self.keys[slots[left]] != keys[left]]
            slots[left] += 1
        self.rank[slots], self.own[slots] = packed >> PLACE_BITS, packed & PLACE

    def slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (``NO_RANK``: such symbols do not merge) and numbers."""
        slots = self.slots(keys)
        held = self.keys[slots]
        on = np.flatnonzero((held != keys) & (held >= 0))
        while len(on):
            slots[on] += 1
            held = self.keys[slots[on]]
            on = on[(held != keys[on]) & (held >= 0)]
        found = self.keys[slots] == keys
        return np.where(found, self.rank[slots], NO_RANK), self.own[slots]


class Vocabulary:
    """Pieces, merge ranks and byte pieces of a model."""

    def __init__(self, model: bytes):
        self.model = model
        codecs.register_error("each_byte", each_byte)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp, scores = self.library, {}
        self.ids: dict[str, int] = {}
        self.byte_ids: list[int] = [sp.unk_id()] * 256
        self.raw: list[bytes] = []
        self.controls: set[int] = set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_control(i):
                self.controls.add(i)
                self.raw.append(b"")
            elif sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                scores[piece] = sp.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.splits = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        # Symbols are numbers: 0 for characters that no piece has, then characters, then longer pieces.
        symbols = dict.fromkeys(sorted({c for p in self.ids for c in p}))
        symbols |= dict.fromkeys(self.ids)
        self.number = {s: k for k, s in enumerate(symbols, 1)}
        self.id_of = [-1, *(self.ids.get(s, -1) for s in symbols)]
        self.base = len(self.id_of)
        # Equal scores share a rank, so that the leftmost pair goes first among them.
        levels = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Two symbols' numbers to the rank of their merger, in the high bits, and its number.
        self.pairs: dict[int, int] = {}
        for piece, score in scores.items():
            packed = levels[score] << PLACE_BITS | self.number[piece]
            for cut in range(1, len(piece)):
                left, right = self.number.get(piece[:cut]), self.number.get(piece[cut:])
                if left and right:
                    self.pairs[left * self.base + right] = packed
        self.table = PairTable(self.pairs)
        self.number_of_code = np.zeros(sys.maxunicode + 1, dtype=np.int32)
        for symbol, k in self.number.items():
            if len(symbol) == 1:
                self.number_of_code[ord(symbol)] = k
        self.ids_of = np.array(self.id_of, dtype=np.int32)
        self.id_of_ascii = np.array([*self.byte_ids[:128], -1], dtype=np.int32)
        self.prefixed = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self.last_control = max(self.controls, default=-1)
        self.end_id = sp.eos_id()

    def segments(self, text: str) -> list[str]:
        """The text's segments, each without its first space symbol (every segment has one)."""
        if not text:
            return []
        if self.splits and SPACE not in text and "  " not in text and text[0] != " " != text[-1]:
            return text.split(" ")
        shown = SPACE + text.replace(" ", SPACE)
        return [x[1:] for x in (SEGMENT.findall(shown) if self.splits else [shown])]

    def merged(self, characters: str) -> list[int]:
        """Per character its piece's number, or -1 if an earlier character's piece holds it."""
        number, base, found = self.number.get, self.base, self.pairs.get
        symbols = [number(c, 0) for c in characters]
        n = len(symbols)
        # The agenda's entries: rank in the high bits, place of the left symbol in the low ones.
        agenda = []
        for i in range(n - 1):
            pair = found(symbols[i] * base + symbols[i + 1])
            if pair is not None:
                agenda.append(pair & RANK | i)
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & PLACE
            right = after[left]
            if symbols[left] < 0 or right == n:
                continue
            pair = found(symbols[left] * base + symbols[right])
            if pair is None or pair & RANK != entry & RANK:
                continue
            symbols[left] = own = pair & PLACE
            symbols[right] = -1
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                pair = found(own * base + symbols[following])
                if pair is not None:
                    heapq.heappush(agenda, pair & RANK | left)
            preceding = before[left]
            if preceding >= 0:
                pair = found(symbols[preceding] * base + own)
                if pair is not None:
                    heapq.heappush(agenda, pair & RANK | preceding)
        return symbols

    def merged_rows(self, symbols: np.ndarray) -> np.ndarray:
        """:meth:`merged` for rows of symbols that end in at least one 0, all rows side by side."""
        n, width = symbols.shape
        done = np.empty_like(symbols)
        owner, base = np.arange(n), self.base
        # The first column is an empty symbol, like the ones at the end: neither merges.
        symbols = np.pad(symbols, ((0, 0), (1, 0))).astype(np.int64)
        rank = np.full(symbols.shape, NO_RANK, dtype=np.int32)
        own = np.zeros(symbols.shape, dtype=np.int32)
        ranks, owns = self.table.find((symbols[:, 1:-1] * base + symbols[:, 2:]).ravel())
        rank[:, 1:-1], own[:, 1:-1] = ranks.reshape(n, -1), owns.reshape(n, -1)
        before = np.tile(np.arange(-1, width, dtype=np.int16), (n, 1))
        after = np.tile(np.arange(1, width + 2, dtype=np.int16), (n, 1))
        while True:
            left = rank.argmin(axis=1)  # the leftmost of the best
            row = np.flatnonzero(rank[np.arange(len(rank)), left] != NO_RANK)
            if 4 * len(row) < 3 * len(rank):
                ended = np.ones(len(rank), dtype=bool)
                ended[row] = False
                done[owner[ended]] = symbols[ended, 1:]
                if not len(row):
                    return done
                owner, symbols, rank, own, before, after = (x[row] for x in (owner, symbols, rank, own, before, after))
                left, row = left[row], np.arange(len(row))
            else:
                left = left[row]
            right = after[row, left]
            following, preceding = after[row, right], before[row, left]
            merger = own[row, left].astype(np.int64)
            symbols[row, left] = merger
            symbols[row, right] = -1
            rank[row, right] = NO_RANK
            after[row, left] = following
            before[row, following] = left
            pairs = [merger * base + symbols[row, following], symbols[row, preceding] * base + merger]
            ranks, owns = self.table.find(np.concatenate(pairs))
            k = len(row)
            rank[row, left], own[row, left] = ranks[:k], owns[:k]
            rank[row, preceding], own[row, preceding] = ranks[k:], owns[k:]

    def encoded_many(self, segments: list[str]) -> Iterator[tuple[str, bytes]]:
        """Segments, as :meth:`encoded` takes them, each with its ids as packed 32-bit integers."""
        sizes = np.fromiter(map(len, segments), np.int64, len(segments)) + 1
        bins = np.searchsorted(WIDTHS, sizes)
        for bin_, width in enumerate(WIDTHS):
            members = np.flatnonzero(bins == bin_)
            for at in range(0, len(members), ROWS_TOGETHER):
                part = members[at : at + ROWS_TOGETHER]
                texts = [segments[i] for i in part.tolist()]
                shown = (SPACE + SPACE.join(texts)).encode("utf-32-le", "surrogatepass")
                inside = np.arange(width + 1) < sizes[part, None]
                codes = np.frombuffer(shown, dtype="<u4")
                symbols = np.zeros(inside.shape, dtype=np.int32)
                symbols[inside] = self.number_of_code[codes]
                symbols = self.merged_rows(symbols)
                stands = inside & (symbols >= 0)
                ids = self.ids_of[symbols]
                # A symbol without an id is a character; one of several bytes takes more places.
                single = np.full(inside.shape, -1, dtype=np.int32)
                single[inside] = self.id_of_ascii[np.minimum(codes, 128)]
                ids = np.where(ids < 0, single, ids)
                whole = ~(stands & (ids < 0)).any(axis=1)
                ends = (4 * np.cumsum(stands.sum(axis=1))).tolist()
                packed = ids[stands].astype("<i4").tobytes()
                for text, ours, first, last in zip(texts, whole.tolist(), [0, *ends], ends, strict=False):
                    yield text, packed[first:last] if ours else self.packed(text)
        for i in np.flatnonzero(bins == len(WIDTHS)).tolist():
            yield segments[i], self.packed(segments[i])

    def packed(self, segment: str) -> bytes:
        return np.array(self.encoded(segment), dtype="<i4").tobytes()

    def encoded(self, segment: str) -> list[int]:
        """Ids of a segment that is given without its first space symbol."""
        out: list[int] = []
        characters, id_of = SPACE + segment, self.id_of
        for i, symbol in enumerate(self.merged(characters)):
            if symbol < 0:
                continue
            if (piece := id_of[symbol]) >= 0:
                out.append(piece)
            else:
                out += [self.byte_ids[b] for b in characters[i].encode("utf-8", "surrogatepass")]
        return out

    def decoded(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, bytes read as UTF-8, the one prefixed space taken off."""
        runs: list[list[int]] = [[]]
        if len(ids) < 2 or min(ids[:-1]) > self.last_control:
            runs = [ids]
        else:  # bytes do not combine across a control piece
            for i in ids:
                runs.append([]) if i in self.controls else runs[-1].append(i)
        text = "".join(b"".join(map(self.raw.__getitem__, r)).decode("utf-8", "each_byte") for r in runs)
        first = next((i for i in ids if i not in self.controls), None)
        return text[1:] if first in self.prefixed else text


class Segments(dict):
    """Segment to its ids as packed 32-bit integers; segments met first are kept for the check."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.fresh: list[str] = []

    def __missing__(self, segment: str) -> bytes:
        self.fresh.append(segment)
        packed = self[segment] = self.vocabulary.packed(segment)
        return packed

    def learn(self, segments: Iterable[str]) -> None:
        """Encode those met first, side by side."""
        new = list(dict.fromkeys(filterfalse(self.__contains__, segments)))
        self.fresh += new
        self.update(self.vocabulary.encoded_many(new))

    def check(self) -> None:
        """Compare the fresh segments with the library, and make room."""
        # Segments in a row are a text, whose pieces are theirs; one of spaces alone would run into
        # the next, so it ends its text.
        texts, ours, part = [], [], []
        for k, segment in enumerate(self.fresh):
            part.append(segment)
            if len(part) >= CHECKED_TOGETHER or k + 1 == len(self.fresh) or not segment.strip(SPACE):
                # The library prefixes the first segment's space symbol by itself.
                texts.append(" ".join(part).replace(SPACE, " "))
                ours.append(np.frombuffer(b"".join(map(self.__getitem__, part)), dtype="<i4").tolist())
                part = []
        if texts:
            compare(self.vocabulary, texts, ours, whole=False)
        self.fresh = []
        if len(self) > MEMORY_SEGMENTS:
            self.clear()


def remembered(model: bytes) -> Segments:
    """The vocabulary and the segments this worker process has met, in this task or an earlier one."""
    held = sys.modules.setdefault(MEMORY_NAME, types.ModuleType(MEMORY_NAME)).__dict__
    key = hashlib.sha256(model).hexdigest()
    if key not in held:
        held[key] = Segments(Vocabulary(model))
    return held[key]


def compare(vocabulary: Vocabulary, texts: list[str], ours: list[list[int]], whole: bool) -> None:
    theirs = vocabulary.library.encode(texts, add_bos=False, add_eos=whole, num_threads=1)
    read = vocabulary.library.decode(ours, num_threads=1)
    for text, own, reference, back in zip(texts, ours, theirs, read, strict=True):
        # A lone prefix symbol has no text of its own; the library gives empty text no ids.
        if own != reference and (text or whole):
            raise ValueError(f"encoding differs from the library's: {text[:80]!r}")
        if vocabulary.decoded(own) != back:
            raise ValueError(f"decoding differs from the library's: {text[:80]!r}")


def read_vocabulary(model_path: str) -> Vocabulary:
    return Vocabulary(_read(model_path))


def _read(model_path: str) -> bytes:
    with open(model_path, "rb") as f:
        return f.read()


def _encoder(known: Segments, check: str):
    """The kernel of :func:`encode`: texts to ids, checked before they are given out."""
    vocabulary = known.vocabulary
    end = np.array([vocabulary.end_id], dtype="<i4").tobytes()

    def kernel(texts: list[str]) -> list[bytes]:
        parts = [vocabulary.segments(text) for text in texts]
        known.learn(chain.from_iterable(parts))
        packed = [b"".join(map(known.__getitem__, part)) + end for part in parts]
        known.check()
        if check == "texts":
            compare(vocabulary, texts, [np.frombuffer(p, dtype="<i4").tolist() for p in packed], whole=True)
        return packed

    return kernel


def _lists(packed: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))


def _checked(check: str) -> str:
    if check not in ("segments", "texts"):
        raise ValueError(f"unknown check: {check}")
    return check


def encode(
    docs: DataFrame, model_path: str, text_col: str = "text", check: str = "segments", keep_text: bool = True
) -> DataFrame:
    """``docs`` plus ``ids``, the pieces of each whole text and the end id."""
    model, check = _read(model_path), _checked(check)

    def start():
        kernel = _encoder(remembered(model), check)
        return lambda texts: [_lists(kernel(texts))]

    return map_text(docs, text_col, [("ids", "array<int>")], start, keep_text)


def round_trip(
    docs: DataFrame, model_path: str, text_col: str = "text", check: str = "segments", keep_text: bool = True
) -> DataFrame:
    """``docs`` plus ``ids`` and ``decoded``, the text that they decode to, in one pass."""
    model, check = _read(model_path), _checked(check)

    def start():
        known = remembered(model)
        kernel, decoded = _encoder(known, check), known.vocabulary.decoded

        def both(texts):
            packed = kernel(texts)
            return [_lists(packed), [decoded(np.frombuffer(p, dtype="<i4").tolist()) for p in packed]]

        return both

    return map_text(docs, text_col, [("ids", "array<int>"), ("decoded", "string")], start, keep_text)


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` plus the text of ``ids_col``; null ids give an empty text."""
    model = _read(model_path)

    def decoded(batches):
        vocabulary = remembered(model).vocabulary
        for ids in batches:
            yield pd.Series([vocabulary.decoded(x.tolist()) if x is not None else "" for x in ids], dtype=object)

    decoded.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(out_col, F.pandas_udf(decoded, "string")(F.col(f"`{ids_col}`")))


ship(__name__)
