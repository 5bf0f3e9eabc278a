"""SentencePiece BPE with source spans: encoding projects every piece to the bytes it
came from, decoding gives the text back."""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ship

SPACE = "▁"  # fixed: how the models write a space
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed: types of pieces
BPE = 2  # fixed: the model type
KNOWN = 200_000  # segments that a Python worker remembers before it forgets them all
LONG = 200  # symbols from which a segment is merged alone, by a heap, and not remembered
CHARACTERS = 1 << 20  # of texts that are encoded together and make an Arrow batch
ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>"
NEVER = np.iinfo(np.int32).max


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, message[at : at + size]
            at += size


class CharMap:
    """A model's compiled character map: keys in a double array, each with its replacement.

    Of the keys that are a prefix of the rest of a text the longest is replaced."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self._units = np.frombuffer(blob, "<u4", size // 4, 4) if blob else np.zeros(0, "<u4")
        self._values = blob[4 + size :]
        self.keys = {k.decode(): self._value(v) for k, v in self._entries()}
        single = {k for k in self.keys if len(k) == 1}
        several = [k for k in self.keys if len(k) > 1]
        self._longest = max(map(len, self.keys), default=0)
        of = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]"
        starts = [of(single)] if single else []
        starts += [of({k[0] for k in several}) + f"(?={of({k[1] for k in several})})"] if several else []
        # where a key may begin: elsewhere each character stands for itself
        self._starts = re.compile("|".join(starts)) if starts else None

    def _value(self, at: int) -> str:
        return self._values[at : self._values.index(b"\0", at)].decode()

    def _entries(self) -> Iterator[tuple[bytes, int]]:
        """All keys, by walking the array one level at a time."""
        if not len(self._units):
            return
        offset = lambda u: (u >> 10) << ((u & 512) >> 6)
        at, prefixes = offset(self._units[:1].astype(np.int64)), [b""]
        letters = np.arange(1, 256)
        while len(at):
            place = at[:, None] ^ letters
            inside = place < len(self._units)
            unit = self._units[np.where(inside, place, 0)].astype(np.int64)
            node, letter = np.nonzero(inside & (unit & 0x800000FF == letters))
            unit, place = unit[node, letter], place[node, letter]
            prefixes = [prefixes[n] + bytes([c]) for n, c in zip(node.tolist(), letters[letter].tolist(), strict=True)]
            at = place ^ offset(unit)
            for n in np.flatnonzero(unit >> 8 & 1).tolist():
                yield prefixes[n], int(self._units[at[n]]) & 0x7FFFFFFF

    def replaced(self, text: str) -> Iterator[tuple[int, int, str | None]]:
        """(start, end, replacement) of the parts of ``text``, None for one in which each
        character stands for itself."""
        at = done = 0
        while self._starts and (found := self._starts.search(text, at)):
            start = found.start()
            for end in range(min(len(text), start + self._longest), start, -1):
                value = self.keys.get(text[start:end])
                if value is not None:
                    if done < start:
                        yield done, start, None
                    yield start, end, value
                    at = done = end
                    break
            else:
                at = start + 1
        if done < len(text):
            yield done, len(text), None


class Normaliser:
    """What a model does to a text before it is cut into pieces, with the byte of the text
    that each character of the result comes from."""

    def __init__(self, charmap: bytes = b"", dummy_prefix: bool = True, collapse: bool = True, escape: bool = True):
        self._map = CharMap(charmap)
        self._prefix, self._collapse = dummy_prefix, collapse
        self._space = SPACE if escape else " "

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normal form and, per character and for its end, a byte position in ``text``."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))
        at = np.concatenate([[0], ends])
        if self._map.keys:
            codes, chunk, chars, leading = self._mapped(text, codes)
            source = at[chars]
        else:
            chunk, source, leading = np.arange(len(codes)), at[:-1], _leading(codes)
        first, last = 0, int(at[-1])
        if self._collapse and len(codes):
            kept = ~self._extra(codes, chunk)
            codes, source, first = codes[kept], source[kept], int(at[leading])
            # at the end a space mark of the text's own goes as well
            size = len(codes) - _leading(np.where(codes == ord(self._space), 32, codes)[::-1])
            if size < len(codes):
                last, codes, source = int(source[size]), codes[:size], source[:size]
        if not len(codes):
            return "", np.zeros(1, np.int64)
        out = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").replace(" ", self._space)
        if self._prefix:
            return self._space + out, np.concatenate([[first], source, [last]])
        return out, np.concatenate([source, [last]])

    def _mapped(self, text: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Code points; the number of the part that each belongs to; the character of
        ``text`` at which that part begins; how many of these are spaces at its start."""
        out, chunk, chars = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        n = leading = 0
        for start, end, value in self._map.replaced(text):
            if value is None:
                if leading == start:
                    leading += _leading(codes[start:end])
                out.append(codes[start:end])
                chunk.append(np.arange(n, n + end - start))
                chars.append(np.arange(start, end))
                n += end - start
            else:
                if leading == start and value == " ":
                    leading = end
                new = np.frombuffer(value.encode("utf-32-le"), "<u4")
                out.append(new)
                chunk.append(np.full(len(new), n))
                chars.append(np.full(len(new), start))
                n += 1
        return np.concatenate(out), np.concatenate(chunk), np.concatenate(chars), leading

    @staticmethod
    def _extra(codes: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """Spaces at the head of a part after a part that ends in one, or at the start."""
        space = codes == 32
        begins = np.r_[True, chunk[1:] != chunk[:-1]]
        part = np.cumsum(begins) - 1
        before = np.cumsum(~space) - ~space
        heading = space & (before == before[begins][part])
        after = np.r_[True, space[:-1]][begins]
        return heading & after[part]


def _leading(codes: np.ndarray) -> int:
    """How many spaces come first."""
    other = np.flatnonzero(codes != 32)
    return int(other[0]) if len(other) else len(codes)


class PieceModel:
    """A BPE model of the sentencepiece library: its pieces as numbers of symbols."""

    def __init__(self, raw: bytes):
        self.texts, scores, types, settings = [], [], [], {}
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                types.append(piece.get(3, NORMAL))
            elif number in (2, 3):
                settings[number] = dict(_fields(value))
        trainer, norm = settings.get(2, {}), settings.get(3, {})
        if trainer.get(3) != BPE or {USER_DEFINED, UNUSED} & set(types) or trainer.get(24):
            raise ValueError("only BPE models without user defined or unused pieces and with leading space marks are read")
        # fixed: fields of the normaliser's settings
        self.normalise = Normaliser(norm.get(2, b""), norm.get(3, 1), norm.get(4, 1), norm.get(5, 1))
        kinds, self._n = np.array(types), len(types)
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        named = {t: n for n, t in enumerate(self.texts)}
        self._bytes = [named[f"<0x{b:02X}>"] for b in range(256)] if trainer.get(35) else None
        self._ids = {t: n for t, n in named.items() if types[n] == NORMAL}
        self._width = np.array([len(t) for t in self.texts])
        # equal scores are one rank: the first place then decides
        _, rank = np.unique(-np.array(scores, np.float64), return_inverse=True)
        pairs = {}
        for text, n in self._ids.items():
            for cut in range(1, len(text)):
                left, right = self._symbol(text[:cut]), self._symbol(text[cut:])
                if left is not None and right is not None:
                    pairs[left * self._base + right] = n
        self._keys = np.array(sorted(pairs), np.int64)
        self._merged = np.array([pairs[k] for k in self._keys.tolist()], np.int64)
        self._rank = rank[self._merged].astype(np.int64)
        self._pairs = dict(zip(self._keys.tolist(), zip(self._rank.tolist(), self._merged.tolist(), strict=True), strict=True))
        # no piece goes on with a space after another character, so texts can be cut there
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self._ids)
        self._cut = re.compile("(?s).+" if crossing else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        # a character that is a piece by itself is its piece's symbol
        self._chars = {ord(t): n for t, n in self._ids.items() if len(t) == 1}
        self._known: dict[str, bytes] = {}  # ids and widths in turn
        self._long: list[str] = []

    @property
    def _base(self) -> int:
        return self._n + 0x110000

    def _symbol(self, text: str) -> int | None:
        """Pieces are symbols, and so is any single character."""
        n = self._ids.get(text)
        return self._n + ord(text) if n is None and len(text) == 1 else n

    def segments(self, norm: str) -> list[str]:
        return self._cut.findall(norm)

    def learn(self, segments: set[str]) -> None:
        """Cuts the segments that are not yet known into pieces, all at once."""
        if len(self._known) > KNOWN:
            self._known.clear()
        new = [s for s in segments if s not in self._known]
        short = [s for s in new if len(s) <= LONG]
        self._known.update(zip(short, self._cut_many(short), strict=True))
        for s in new:
            if len(s) > LONG:
                self._known[s] = self._expanded(self._cut_long(s))
                self._long.append(s)

    def forget_long(self) -> None:
        for s in self._long:
            del self._known[s]
        self._long = []

    def pieces(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their widths in characters. The bytes of a character that is no piece
        are as many ids; the last of them has its width."""
        both = np.frombuffer(b"".join(map(self._known.__getitem__, segments)), "<i4").reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def _codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        distinct, place = np.unique(codes, return_inverse=True)
        return np.array([self._chars.get(c, self._n + c) for c in distinct.tolist()], np.int64)[place]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * self._base + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        hit = self._keys[at] == keys
        return np.where(hit, self._rank[at], NEVER), self._merged[at]

    def _cut_many(self, segments: list[str]) -> list[bytes]:
        """Byte pair merges of many segments side by side: in each round every segment
        merges its best pair, the first of equals."""
        if not segments or not len(self._keys):
            return [self._expanded(self._codes(s)) for s in segments]
        symbols = self._codes("".join(segments))
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        joint = owner[1:] == owner[:-1]
        rank, merged = self._look_up(symbols[:-1], symbols[1:])
        rank, merged = np.r_[np.where(joint, rank, NEVER), NEVER], np.r_[merged, 0]
        while len(symbols):
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.r_[begins, len(owner)])
            ready = np.repeat(best == NEVER, sizes)
            if ready.any():
                done.append((owner[ready], symbols[ready]))
                going = ~ready
                symbols, owner, rank, merged = symbols[going], owner[going], rank[going], merged[going]
                keep = best != NEVER
                best, sizes = best[keep], sizes[keep]
                if not len(symbols):
                    break
                begins = np.r_[0, np.cumsum(sizes)[:-1]]
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            first = hits[np.r_[True, owner[hits][1:] != owner[hits][:-1]]]
            symbols[first] = merged[first]
            stays = np.ones(len(symbols), bool)
            stays[first + 1] = False
            place = np.cumsum(stays) - 1
            symbols, owner, rank, merged = symbols[stays], owner[stays], rank[stays], merged[stays]
            first = place[first]
            # the pairs on both sides of what was merged are new
            touched = np.concatenate([first, first[first > 0] - 1])
            touched = touched[touched + 1 < len(symbols)]
            new, into = self._look_up(symbols[touched], symbols[touched + 1])
            rank[touched] = np.where(owner[touched] == owner[touched + 1], new, NEVER)
            merged[touched] = into
            rank[-1] = NEVER
        owner, symbols = (np.concatenate([d[n] for d in done]) for n in (0, 1))
        order = np.argsort(owner, kind="stable")
        owner, symbols = owner[order], symbols[order]
        ids, widths, own = self._to_ids(symbols, owner)
        bounds = (8 * np.searchsorted(own, np.arange(len(segments) + 1))).tolist()
        both = np.stack([ids, widths], 1).tobytes()
        return [both[a:b] for a, b in zip(bounds, bounds[1:])]

    def _cut_long(self, segment: str) -> np.ndarray:
        """The same merges of one long segment, by a heap of pairs."""
        symbols = self._codes(segment).tolist()
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                found = self._pairs.get(symbols[left] * self._base + symbols[right])
                if found:
                    heapq.heappush(heap, (found[0], left, symbols[left], symbols[right], found[1]))

        for n in range(len(symbols) - 1):
            offer(n, n + 1)
        while heap:
            _, left, was, other, into = heapq.heappop(heap)
            right = after[left]
            if symbols[left] != was or right < 0 or symbols[right] != other:
                continue
            symbols[left], symbols[right] = into, -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return np.array([s for s in symbols if s >= 0], np.int64)

    def _expanded(self, symbols: np.ndarray) -> bytes:
        ids, widths, _ = self._to_ids(symbols, np.zeros(len(symbols), np.int64))
        return np.stack([ids, widths], 1).tobytes()

    def _to_ids(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        strange = symbols >= self._n
        ids, widths = np.where(strange, self.unknown, symbols), np.ones(len(symbols), np.int64)
        widths[~strange] = self._width[symbols[~strange]]
        if self._bytes and strange.any():
            place = np.flatnonzero(strange)
            spelt = [chr(c).encode("utf-8", "surrogatepass") for c in (symbols[place] - self._n).tolist()]
            times = np.ones(len(symbols), np.int64)
            times[place] = [len(b) for b in spelt]
            last = np.repeat(np.cumsum(times), times) - 1
            ids, owner, widths, strange = (np.repeat(x, times) for x in (ids, owner, widths, strange))
            widths[strange & (np.arange(len(ids)) != last)] = 0
            ids[strange] = [self._bytes[b] for s in spelt for b in s]
        return ids.astype("<i4"), widths.astype("<i4"), owner

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of each text, and the bytes [start, end) of it that each id stands for."""
        normal = [self.normalise(t) for t in texts]
        cut = [self.segments(norm) for norm, _ in normal]
        self.learn(set().union(*cut))
        out = []
        for segments, (_, source) in zip(cut, normal, strict=True):
            ids, widths = self.pieces(segments)
            ends = np.cumsum(widths)
            starts, ends = source[ends - widths], source[ends]
            if not self._bytes and len(ids):  # unknown characters in a row are one piece
                again = np.r_[False, (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)]
                ids, starts, ends = ids[~again], starts[~again], ends[~np.r_[again[1:], False]]
            out.append((ids, starts, ends))
        self.forget_long()
        return out


@lru_cache(maxsize=1)
def model_of(raw: bytes) -> PieceModel:
    """One for all tasks that a Python worker runs."""
    return PieceModel(raw)


@lru_cache(maxsize=1)
def decoder_of(raw: bytes):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=raw)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode_pieces(docs: DataFrame, model_file: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids, starts, ends): the pieces of whole ``docs`` texts under the model of
    ``model_file``, and per piece the bytes [start, end) of the text's UTF-8. With
    ``decoded`` also the text that the library makes of the ids.

    A text is normalised by the model's own rules; the longest prefix that its compiled
    character map holds is replaced, and each character of the result remembers the byte
    it came from. Pieces are merged in a worker for each distinct segment between spaces,
    many at once, and placed in the text by their widths. The ids are those of the
    sentencepiece library. Of a character that is spelt in bytes, the last id has its span
    and those before are empty, as there. NULL and empty texts have no pieces; NULL and
    repeated doc_ids pass through, each row being a document; other columns are not
    read; an empty table gives an empty one. There is no shuffle.
    """
    spark = docs.sparkSession
    ship(spark)
    raw = spark.sparkContext.broadcast(Path(model_file).read_bytes())

    schema = ENCODED + (", decoded string" if decoded else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(raw.value)
        for batch in batches:
            low = 0
            while low < len(batch):
                # as many texts as make a batch, one at least
                high, size = low, 0
                while high < len(batch) and high - low < 1024 and (high == low or size < CHARACTERS):
                    size += len(batch["text"][high].as_py() or "")
                    high += 1
                part = batch.slice(low, high - low)
                done = model.encode([t or "" for t in part["text"].to_pylist()])
                columns = [_lists([d[n] for d in done]) for n in range(3)]
                if decoded:
                    decode = decoder_of(raw.value).decode
                    columns.append(pa.array([decode(d[0].tolist()) if len(d[0]) else "" for d in done], pa.string()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names)
                low = high

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(encode, schema)


def decode_pieces(ids: Column, model_file: str, spark) -> Column:
    """The text of a column of ids, as the sentencepiece library decodes them. NULL is
    NULL; no ids are the empty text."""
    ship(spark)
    raw = spark.sparkContext.broadcast(Path(model_file).read_bytes())

    @F.pandas_udf("string")
    def of(column: pd.Series) -> pd.Series:
        decode = decoder_of(raw.value).decode
        return pd.Series([None if i is None else decode(i.tolist()) if len(i) else "" for i in column], dtype=object)

    return of(ids)
