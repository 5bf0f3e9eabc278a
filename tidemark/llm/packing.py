"""Sequence packing by power-of-two decomposition: no sequence crosses documents."""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ship

PIECES = 4096  # pieces per Arrow batch that a task hands on
KNOWN_WORDS = 1_000_000  # words a Python worker remembers before it forgets them all
LATIN = "\u024f"  # up to here, what is a letter is settled
PUNCTUATION = string.punctuation
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int"
)


class WordIds(dict):
    """Token ids of a word, found when it is first asked for and then remembered: the
    tokenizer drops white space and never joins what it parts, so a text's ids are those
    of its words.

    Nor does it join a letter and the punctuation after it, and it reads all cases as
    one; so a word's ids are those of its lower-case stem and of its last punctuation.
    A stem of Latin letters alone is a single piece to it and goes to its model at once.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._model = self._tokenizer.model
        self._code = [i.to_bytes(4, "little") for i in range(max(self._tokenizer.get_vocab().values()) + 1)]
        letters = letters_of(self._tokenizer)
        self._letters, self._given = frozenset(letters), str.maketrans(letters)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = self._find(word)
        return found

    def _find(self, word: str) -> bytes:
        stem = word
        if not self._letters.issuperset(word):
            stem = word.rstrip(PUNCTUATION)
            if not stem or "<|" in word or stem[-1] not in self._letters:
                return self._encode(word)
            if not self._letters.issuperset(stem):
                return self[stem] + self[word[len(stem) :]] if stem != word else self._encode(word)
        lower = stem.lower()
        if lower != word:
            return self[lower] + self[word[len(stem) :]]
        code = self._code
        return b"".join([code[t.id] for t in self._model.tokenize(word.translate(self._given))])

    def _encode(self, word: str) -> bytes:
        code = self._code
        return b"".join([code[i] for i in self._tokenizer.encode(word, add_special_tokens=False).ids])

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))


def letters_of(tokenizer) -> dict[str, str]:
    """Latin letters, and what the tokenizer hands to its model for each; none if it
    parts a run of them, or has special tokens that do not start with <|."""

    def pieces(text: str) -> list[str]:
        return [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))]

    specials = tokenizer.get_added_tokens_decoder().values()
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None or not all(t.content.startswith("<|") for t in specials):
        return {}
    own = {c: pieces(c) for c in map(chr, range(ord(LATIN) + 1)) if c.isalpha()}
    letters = {c: p[0] for c, p in own.items() if len(p) == 1 and p == pieces(c.lower())}
    return letters if pieces("".join(letters)) == ["".join(letters.values())] else {}


@lru_cache(maxsize=1)
def encoder_of(tokenizer_file: str) -> WordIds:
    """One for all tasks that a Python worker runs."""
    return WordIds(tokenizer_file)


def words_of(text: str | None) -> list[str]:
    """Parts between white space, of the kinds that are surely such for the tokenizer."""
    return (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def lengths_of(tokens: int, longest: int) -> list[int]:
    """Sequences of the longest length, then the binary digits of the rest."""
    rest = tokens % longest
    digits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [longest] * (tokens // longest) + digits


def pack_pow2(docs: DataFrame, tokenizer_file: str, end_id: int = 2, longest: int = 4096) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): each is a sequence of its own whose length is
    a power of two up to ``longest``, so there is no padding and no sequence holds two
    documents.

    A document's ids are its text's and ``end_id``; NULL text is empty. Per piece:
    ``start`` (ids before it), ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset`` (0) and ``bucket`` (the exponent).
    Sequence ids are ordered by bucket, so equal lengths lie together; below the
    bucket they are made of the task and the sequence's number in it, and a task that
    is run again gives the same ones. There is no shuffle. NULL and repeated doc_ids
    pass through, each row being a document; other columns are not read; an empty
    table has no pieces.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task = encoder_of(tokenizer_file), TaskContext.get().partitionId()
        counters = [0] * longest.bit_length()
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc_id = None if doc_id is None else int(doc_id)
                ids = encoder.ids(words_of(text)) + end_id.to_bytes(4, "little")
                tokens, start = len(ids) // 4, 0
                for length in lengths_of(tokens, longest):
                    bucket = length.bit_length() - 1
                    piece = ids[4 * start : 4 * (start + length)]
                    sequence = bucket << 58 | task << 34 | counters[bucket]
                    out.append((doc_id, start, length, piece, tokens, sequence, 0, bucket))
                    counters[bucket] += 1
                    start += length
                    size += length
                if len(out) >= PIECES or size >= PIECES * 1024:
                    yield _frame(out)
                    out, size = [], 0
        if out:
            yield _frame(out)

    ship(docs.sparkSession)
    # ids as text, since pandas would make floats of those with NULLs among them
    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return rows.mapInPandas(pack, SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"doc_id": "Int64"})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length: a training batch of a folder
    needs no mask and no padding."""
    pieces.write.partitionBy("length").parquet(path)
