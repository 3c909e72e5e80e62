"""Token counts at every prefix of a text, by prefix dynamic programming over a piece vocabulary.

The tokens of a prefix end in exactly one piece. Of the pieces that end at a place it is the one that
the merges leave standing beside the last token of the prefix before it, and two tokens stand beside
each other in a text just if merging their two strings alone gives these two back. So the last token
and the count of every prefix follow from those of shorter prefixes, and one pass over a text counts
all its prefixes, where encoding each would be one pass per prefix. The counts are kept as
differences, a signed byte per code point; questions about truncation and budgets are sums over them
(``tokens_at``, ``longest_within``, ``truncated``) and need no tokenizer.

No piece holds a space after another character, so a text is a row of words whose counts add up, and
each distinct word is worked out once per worker, in a table of bounded size. Long words are worked
out each time. Where a vocabulary has such pieces, a whole text is one word.

Null and empty texts have no tokens and no counts. Strings of special tokens are ordinary text, as
they are for the library; code points outside the vocabulary count one token per UTF-8 byte.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what stands for a space in a piece.
SPACE = "▁"
# Texts worked on together; words of up to so many code points are remembered, up to twice so many of
# them, those met last; so many pairs of pieces are.
TEXTS = 256
SHORT = 64
REMEMBERED = 500_000
PAIRS = 500_000
ONE = (1,)
BYTE = 255
NEVER = -math.inf


class Pieces(dict):
    """A BPE piece model with byte fallback, and the steps of the words met so far, by word."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        probe = "a  ①ﬁ　b \n<s>\xa0 "
        if (
            any(model.is_unused(i) for i in plain)
            or sum(map(model.is_byte, ids)) != 256
            or model.normalize(probe) != (SPACE + probe).replace(" ", SPACE)
            or model.encode("") != []
        ):
            raise ValueError(f"{path} is not a plain piece model with byte fallback")
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        # pieces by number; 0 is what they never merge with: the beginning, and unknown code points
        self.names = ["", *self.score]
        self.number = {piece: n for n, piece in enumerate(self.names)}
        # the lengths of pieces, longest first, by the last three characters of what they may end
        ends: dict[str, set[int]] = {}
        for piece in self.score:
            ends.setdefault(piece[-3:], set()).add(len(piece))
        self.sizes = {}
        for end in ends:
            own = ends[end] | ends.get(end[-2:], set()) | {1} if len(end) > 1 else {1}
            self.sizes[end] = sorted(own, reverse=True)
        self.joined = {piece[i : i + 2] for piece in self.score for i in range(len(piece) - 1)}
        inner = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.score)
        breaks = any("\n" in piece for piece in self.score if len(piece) > 1)
        # words: spaces and what follows them; a line break is a word of its own if no piece has one
        stop = SPACE + ("" if breaks else "\n")
        self.words = re.compile("(?s).+" if inner else f"{SPACE}*[^{stop}]+|{SPACE}+|\n")
        self.beside: dict[int, bool] = {}
        self.before: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short string: the best known neighbours are merged, the leftmost of equals,
        until none are known."""
        parts, known = list(text), self.score.get
        scores = [known(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = known(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = known(parts[at] + parts[at + 1], NEVER)
        return parts

    def _side_by_side(self, left: int, right: int) -> bool:
        """Whether two pieces stand beside each other; nothing on the left is the beginning."""
        a, b = self.names[left], self.names[right]
        if a and a[-1] + b[0] in self.joined:
            return a + b not in self.score and self.merged(a + b) == [a, b]
        return self.merged(b) == [b]

    def learn(self, words: list[str]) -> None:
        """Work out the steps of words, each from where it parts from the one before it in the alphabet."""
        known, sizes, beside = self.number.get, self.sizes.get, self.beside
        last, count, before = [0], [0], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                ending = word[end - 3 : end] if end > 2 else word[:end]
                for size in sizes(ending) or sizes(ending[-2:]) or ONE:
                    begin = end - size
                    if begin < 0:
                        continue
                    piece = known(word[begin:end])
                    if piece is not None:
                        pair = last[begin] << 32 | piece
                        fits = beside.get(pair)
                        if fits is None:
                            fits = beside[pair] = self._side_by_side(last[begin], piece)
                        if fits:
                            last.append(piece)
                            count.append(count[begin] + 1)
                            break
                else:  # a code point outside the vocabulary merges with nothing, before or after it
                    last.append(0)
                    count.append(count[end - 1] + len(word[end - 1].encode()))
            self[word] = bytes(map(BYTE.__and__, map(sub, count[1:], count)))
            before = word
        if len(beside) > PAIRS:
            beside.clear()

    def steps(self, texts: list[str]) -> list[bytes]:
        """Per text, by how many tokens each code point changes the count of the prefix up to it."""
        cut = [self.words.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        new = set().union(*cut).difference(self)
        if len(self) + len(new) > REMEMBERED:
            self.before = dict(self)
            self.clear()
            new = set().union(*cut)
        for word in new & self.before.keys():
            self[word] = self.before[word]
        self.learn([word for word in new if word not in self.before])
        out = []
        for words in cut:
            steps = b"".join(map(self.__getitem__, words))
            # a text begins with a space of the model's own, which counts only with what follows it
            out.append(bytes([steps[0] + steps[1] & BYTE]) + steps[2:] if words else b"")
        for word in [word for word in new if len(word) > SHORT]:
            del self[word]
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def with_counts(
    docs: DataFrame, path: str, steps: str = "token_steps", total: str = "n_tokens", text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (all by default) with the ``steps`` of each whole text, an array of a signed
    byte per code point, and the ``total``, the count at its last prefix.

    ``path`` names the model file on every machine. A column of one of the new names is replaced.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (steps, total)]
    schema = T.StructType(
        [*[docs.schema[c] for c in kept], T.StructField(steps, T.ArrayType(T.ByteType())), T.StructField(total, T.LongType())]
    )
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                own = model.steps([t or "" for t in part.column(len(kept)).to_pylist()])
                ends = np.cumsum([0, *map(len, own)])
                flat = np.frombuffer(b"".join(own), dtype=np.int8)
                until = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int8()))
                counts = pa.array(until[ends[1:]] - until[ends[:-1]], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], lists, counts], names=[*kept, steps, total])

    return source.mapInArrow(run, schema)


def tokens_at(steps: Column, prefix: Column | int) -> Column:
    """The number of tokens of the first ``prefix`` code points (of all, if there are fewer)."""
    return F.aggregate(F.slice(steps, 1, prefix), F.lit(0).cast("long"), lambda n, step: n + step)


def longest_within(steps: Column, budget: Column | int) -> Column:
    """The greatest number of code points that make up at most ``budget`` tokens by themselves.

    A longer prefix can have fewer tokens than a shorter one, so the last such prefix counts.
    """
    limit = budget if isinstance(budget, Column) else F.lit(budget)
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("best"))

    def step(state: Column, change: Column) -> Column:
        at, n = state["at"] + 1, state["n"] + change
        return F.struct(at.alias("at"), n.alias("n"), F.when(n <= limit, at).otherwise(state["best"]).alias("best"))

    return F.aggregate(steps, start, step, lambda state: state["best"])


def truncated(text: Column, steps: Column, budget: Column | int) -> Column:
    """The longest beginning of a text that has at most ``budget`` tokens by itself."""
    return F.substring(text, F.lit(1), longest_within(steps, budget))
