"""Byte-level BPE, encoded in batched numpy merge rounds and decoded back.

The words of many texts are laid out as one flat array of symbols. In each round the pair keys of
all neighbours are looked up by binary search in the sorted keys of the merge table, every word's
lowest rank is found, and all its pairs of that rank are merged, left to right. Words without a
known pair leave the array. Each distinct word is encoded once per worker and remembered in a
table of bounded size, so a round's array holds new words only.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how byte-level vocabularies of this family split text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Texts that are tokenized together, and distinct pieces a worker remembers.
TEXTS = 128
REMEMBERED = 250_000
NONE = np.iinfo(np.int64).max


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the
    others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


_SPLIT = regex.compile(SPLIT)


def split(text: str) -> list[str]:
    """The words of a text without special tokens.

    Whether a code point that Unicode got lately is a letter depends on a library's tables. Texts
    with code points unknown to Python are therefore cut by the tokenizer library's own rule.
    """
    if text.isprintable() or not any(category(c) == "Cn" for c in text):
        return _SPLIT.findall(text)
    from tokenizers.pre_tokenizers import ByteLevel

    return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]


class Merges:
    """The merge table of a byte-level BPE file, and the words encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, kinds = spec["model"], spec["pre_tokenizer"]
        odd = [model["type"] != "BPE", bool(model.get("ignore_merges")), bool(model.get("byte_fallback")),
               bool(model.get("dropout")), spec["normalizer"] is not None, kinds["type"] != "ByteLevel",
               bool(kinds.get("add_prefix_space")), not kinds.get("use_regex", True)]
        added = spec["added_tokens"]
        if any(odd) or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab = model["vocab"]
        letters = _byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.first = np.array([vocab[letter] for letter in letters], dtype=np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)[order]
        self.special = {a["content"]: a["id"] for a in added}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = defaultdict(count().__next__)
        self.ids = np.empty(0, dtype=np.int32)
        self.start = np.zeros(1, dtype=np.int64)
        self.gap = np.zeros(0, dtype=bool)

    def _words(self, text: str) -> list[str]:
        """The strings that merges stay within."""
        if self.cut is None or self.cut.search(text) is None:
            return split(text)
        words, at = [], 0
        for mark in self.cut.finditer(text):
            words += split(text[at : mark.start()])
            words.append(mark.group())
            at = mark.end()
        return words + split(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of each text in it.

        A space before a character that is no white space always starts a new word, so texts are
        cut there first, and such pieces are what is remembered. A text with a space before white
        space, or with a special token in it, is cut into words at once.
        """
        if len(self.place) > REMEMBERED:
            self._forget()
        known, codes = len(self.place), []
        for text in texts:
            if self.cut is not None and self.cut.search(text) is not None:
                pieces = [" " + word for word in self._words(text)]
            else:
                pieces = text.split(" ")
                pieces[0] = " " + pieces[0]
            codes.append(self._codes(pieces))
        self._learn(known)
        known = len(self.place)
        for n, own in enumerate(codes):
            if self.gap[own].any():
                codes[n] = self._codes([" " + word for word in self._words(texts[n])])
        self._learn(known)
        code = np.concatenate([np.empty(0, dtype=np.int64), *codes])
        ends = np.cumsum([0, *map(len, codes)])
        size = self.start[code + 1] - self.start[code]
        until = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(until[-1]) + np.repeat(self.start[code] - until[:-1], size)
        return self.ids[at], until[ends]

    def _codes(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces. A piece is noted without the space it starts with, or with one more
        if it starts with none or was cut by the full rule."""
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def _learn(self, known: int) -> None:
        """Encode the pieces noted since there were ``known``, each distinct word of them once."""
        new = list(islice(reversed(self.place), len(self.place) - known))[::-1]
        if not new:
            return
        words: dict[str, int] = defaultdict(count().__next__)
        raw = [piece[1:] if piece[:1] == " " else " " + piece for piece in new]
        parts = [[r] if r in self.special or r[1:].isalpha() and (r[0] == " " or r[0].isalpha()) else split(r) for r in raw]
        code = np.array([words[w] for part in parts for w in part], dtype=np.int64)
        ids, sizes = self.merge(list(words))
        start = np.concatenate([[0], np.cumsum(sizes)])
        size = sizes[code]
        until = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(until[-1]) + np.repeat(start[code] - until[:-1], size)
        piece_ends = until[np.cumsum([len(part) for part in parts])]
        self.ids = np.concatenate([self.ids, ids[at].astype(np.int32)])
        self.start = np.concatenate([self.start, self.start[-1] + piece_ends])
        self.gap = np.concatenate([self.gap, [not piece or piece[0].isspace() and piece[0] != " " for piece in new]])

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in one array, and how many each has, by merge rounds."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        symbol = self.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        for n, w in enumerate(words):
            if w in self.special:
                keep = word != n
                at = int(np.searchsorted(word, n))
                symbol = np.insert(symbol[keep], at, self.special[w])
                word = np.insert(word[keep], at, n)
        done_symbol, done_word = [], []
        while len(symbol):
            key = np.append(symbol[:-1] << 32 | symbol[1:], -1)
            found = np.searchsorted(self.keys, key)
            found[found == len(self.keys)] = 0
            rank = np.where(self.keys[found] == key, self.rank[found], NONE)
            rank[np.append(word[1:] != word[:-1], True)] = NONE
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, begins)
            count = np.diff(np.append(begins, len(word)))
            lowest = np.repeat(lowest, count)
            over = lowest == NONE
            done_symbol.append(symbol[over])
            done_word.append(word[over])
            hit = (rank == lowest) & ~over
            # in a run of overlapping pairs every second one is merged, from the left
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit, -1, place))
            hit &= (place - run) % 2 == 1
            symbol = np.where(hit, self.made[found], symbol)
            keep = ~over & ~np.append(False, hit[:-1])
            symbol, word = symbol[keep], word[keep]
        symbols = np.concatenate([np.empty(0, dtype=np.int64), *done_symbol])
        of = np.concatenate([np.empty(0, dtype=np.int64), *done_word])
        order = np.argsort(of, kind="stable")
        return symbols[order], np.bincount(of, minlength=len(words))

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; unknown ids stand for nothing, broken UTF-8 for U+FFFD."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def _mapped(df: DataFrame, column: str, out: str, kind: T.DataType, keep: list[str] | None, work) -> DataFrame:
    kept = [c for c in (df.columns if keep is None else keep) if c != out]
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(out, kind)])
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias("__given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                made = work(part.column(len(kept)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], made], names=[*kept, out])

    return source.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, out: str = "token_ids", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) and the token ids of each whole text; null counts as empty.

    ``path`` names the tokenizer file on every machine. Special tokens spelt out in a text become
    their ids; none is added.
    """

    def work(texts: pa.Array) -> pa.Array:
        ids, ends = merges(path).encode([t or "" for t in texts.to_pylist()])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    return _mapped(docs, text, out, T.ArrayType(T.IntegerType()), keep, work)


def decoded(rows: DataFrame, path: str, out: str = "decoded", ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) and the text of each row's ids; null ids give empty text."""

    def work(lists: pa.Array) -> pa.Array:
        table = merges(path)
        return pa.array([table.decode(x or []) for x in lists.to_pylist()], pa.string())

    return _mapped(rows, ids, out, T.StringType(), keep, work)


def round_trip(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``encoded`` and ``decoded`` in one pass: one Python worker per task in place of two, and ids
    that are decoded need not come back from Spark first."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (ids, out)]
    schema = T.StructType(
        [*[docs.schema[c] for c in kept], T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.StringType())]
    )
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                flat, ends = table.encode([t or "" for t in part.column(len(kept)).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                back = [table.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], lists, pa.array(back, pa.string())], names=[*kept, ids, out]
                )

    return source.mapInArrow(run, schema)
