"""SentencePiece encoding and decoding with shared-prefix forward passes.

A text is normalised as the model says (white space becomes the mark U+2581) and cut into marked words, which no
piece crosses. The distinct marked words of a batch are sorted, which is the depth-first order of their trie: each
word keeps the forward states of the prefix it shares with the word before and goes on from there. Every distinct
prefix of a batch is thus worked out once; words seen in earlier batches are looked up, without the signs at their end.

The forward state after a prefix depends on the kind of model:

* unigram: the best sum of piece scores, and the piece that ends there (Viterbi);
* byte-pair (BPE): the last piece of the prefix's own encoding. A row of pieces is what merging by score yields exactly if
  each two neighbours are, so of the pieces that end here just one may follow the state where it begins. (The maximum of
  the sum of scores would not be what a BPE model encodes.)

Characters that no piece has become bytes, if the model has byte pieces, or the unknown id. NULL texts are empty, and
empty texts have no ids. Nothing is shuffled; a task holds a batch of texts and a bounded table of known words.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import string
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import base

MARK = "▁"
_CACHED = 200_000
_CACHED_PAIRS = 500_000
#: Signs that often end a word: a word is looked up, and worked out, without them.
_SIGNS = string.punctuation
# Fixed values of the model format: kinds of pieces and of models.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces of a model, and the encoding of marked words."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = _UNIGRAM):
        self.pieces, self.kind = pieces, kind
        usable = [(i, p, s) for i, (p, s, t) in enumerate(pieces) if t in (_NORMAL, _USER)]
        self.ids = {p: i for i, p, _ in usable}
        self.score = {p: s for _, p, s in usable}
        self.longest = max(map(len, self.ids), default=1)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == _BYTE}
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == _UNKNOWN), 0)
        self.unknown_score = min(self.score.values(), default=0.0) - 10
        self.letters = {c for p in self.ids for c in p}
        self.known = base.Known(_CACHED)
        self._follows: dict[int, bool] = {}
        self._spines: dict[str, tuple[list, list]] = {}
        self._formed: dict[int, bool] = {}
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.endings: dict[str, tuple[int, ...]] = {}
        for p in self.ids:
            if len(p) >= 3:
                self.endings[p[-3:]] = tuple(sorted({1, 2, len(p), *self.endings.get(p[-3:], ())}, reverse=True))
        # Characters outside all pieces stand by themselves, so texts may be cut at line breaks too.
        cuts = "" if "\n" in self.letters else "\n"
        self._split = re.compile(f"{MARK}*[^{MARK}{cuts}]+|{MARK}+" + ("|\n" if cuts else "")).findall

    @staticmethod
    def load(path: str) -> "Model":
        pieces, kind = [], _UNIGRAM
        with open(path, "rb") as file:
            for number, value in _fields(file.read()):
                if number == 1:
                    piece = {1: b"", 2: struct.pack("<f", 0), 3: _NORMAL} | dict(_fields(value))
                    pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
                elif number == 2:
                    kind = dict(_fields(value)).get(3, _UNIGRAM)
        return Model(pieces, kind)

    # Byte-pair models

    def merge(self, word: str) -> list[tuple[str, tuple | None]]:
        """The pieces of a word by merging neighbours, best score first and leftmost among equals, each with its two parts."""
        parts: list = [(c, None) for c in word]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(word):
                both = parts[left][0] + parts[after[left]][0]
                if both in self.score:
                    heapq.heappush(heap, (-self.score[both], left, both))

        for k in range(len(parts)):
            offer(k)
        while heap:
            _, left, both = heapq.heappop(heap)
            right = after[left] if parts[left] else len(word)
            if not parts[left] or right >= len(word) or parts[left][0] + parts[right][0] != both:
                continue
            parts[left], parts[right] = (both, (parts[left], parts[right])), None
            after[left] = after[right]
            if after[left] < len(word):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [p for p in parts if p]

    def _spine(self, piece: str) -> tuple[list, list]:
        """The symbols at the left and at the right border of a piece while it is merged, each with its score; empty if it never comes about."""
        found = self._spines.get(piece)
        if found is None:
            whole = self.merge(piece)
            sides: tuple[list, list] = ([], [])
            if len(whole) == 1:
                for side, spine in enumerate(sides):
                    node = whole[0]
                    while node:
                        spine.append((node[0], -self.score.get(node[0], 0.0)))
                        node = node[1] and node[1][-side]
                    spine.reverse()
            found = self._spines[piece] = sides
        return found

    def follows(self, first: str, second: str) -> bool:
        """True if merging ``first + second`` yields just these two pieces: no merge across the border ever comes first."""
        left, right = self._spine(first)[1], self._spine(second)[0]
        i = j = 0
        while left and right:
            next_left = left[i + 1][1] if i + 1 < len(left) else float("inf")
            next_right = right[j + 1][1] if j + 1 < len(right) else float("inf")
            across = self.score.get(left[i][0] + right[j][0])
            if across is not None and -across < next_left and -across <= next_right:
                return False
            if next_left == next_right == float("inf"):
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        return False

    def _may_follow(self, first: int, number: int) -> bool:
        """``follows`` for ids, remembered. After the start of a word, or a character without a piece (-1), any piece goes that comes about at all."""
        known = self._formed if first < 0 else self._follows
        if len(known) >= _CACHED_PAIRS:
            known.clear()
        if first < 0:
            known[number] = bool(self._spine(self.pieces[number][0])[0])
            return known[number]
        pair = first << 32 | number
        known[pair] = self.follows(self.pieces[first][0], self.pieces[number][0])
        return known[pair]

    # Forward passes over the trie

    def _step(self, word: str, end: int, states: list) -> tuple[float, int, int]:
        """The state after ``word[:end]`` of a unigram model: a score, the piece that ends there (-1: a character without one), and its length."""
        best = (states[end - 1][0] + self.unknown_score, -1, 1)
        for size in range(1, min(self.longest, end) + 1):
            piece = word[end - size : end]
            score = self.score.get(piece)
            if score is not None and states[end - size][0] + score > best[0]:
                best = (states[end - size][0] + score, self.ids[piece], size)
        return best

    def _extend(self, word: str, shared: int, last: list[int], sizes: list[int]) -> None:
        """Continue the states of a byte-pair model, the last piece (-1: a character without one) and its length, behind ``word[:shared]``."""
        ids, endings, follows, formed = self.ids, self.endings, self._follows, self._formed
        for end in range(shared + 1, len(word) + 1):
            # Only the lengths that pieces with this ending have.
            for size in endings.get(word[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                begin = end - size
                if begin < 0:
                    continue
                number = ids.get(word[begin:end])
                if number is None:
                    continue
                first = last[begin]
                fits = formed.get(number) if first < 0 else follows.get(first << 32 | number)
                if fits is None:
                    fits = self._may_follow(first, number)
                if fits:
                    last.append(number)
                    sizes.append(size)
                    break
            else:
                last.append(-1)
                sizes.append(1)

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each distinct word with its pieces, in sorted order."""
        for word, _, lengths in self._paths(words):
            ends = list(itertools.accumulate(lengths))
            yield word, [word[a:b] for a, b in zip([0, *ends], ends)]

    def _paths(self, words: Iterable[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        """Each distinct word, in sorted order, with the ids (-1: a character without a piece) and lengths of its pieces."""
        scores: list[tuple[float, int, int]] = [(0.0, -1, 0)]
        last, sizes, previous = [-1], [0], ""
        for word in sorted(set(words)):
            if self.kind == _BPE and MARK * 2 in word:  # runs of marks have pieces of equal score, where the order of merges counts
                merged = [p for p, _ in self.merge(word)]
                yield word, [self.ids.get(p, -1) for p in merged], list(map(len, merged))
                continue
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            previous = word
            if self.kind == _BPE:
                del last[shared + 1 :], sizes[shared + 1 :]
                self._extend(word, shared, last, sizes)
            else:
                del scores[shared + 1 :]
                for end in range(shared + 1, len(word) + 1):
                    scores.append(self._step(word, end, scores))
                last, sizes = [x[1] for x in scores], [x[2] for x in scores]
            numbers, lengths, at = [], [], len(word)
            while at:
                numbers.append(last[at])
                lengths.append(sizes[at])
                at -= sizes[at]
            numbers.reverse()
            lengths.reverse()
            yield word, numbers, lengths

    def _spelled_ids(self, word: str, numbers: list[int], lengths: list[int]) -> list[int]:
        if -1 not in numbers:
            return numbers
        ends = itertools.accumulate(lengths)
        return [i for n, end in zip(numbers, ends) for i in ([n] if n >= 0 else self._ids_of(word[end - 1]))]

    def _ids_of(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def _cut(self, word: str) -> tuple[str, ...]:
        """A word without the signs at its end, and these: nothing is ever merged across characters that stand side by side in no piece."""
        end = len(word.rstrip(_SIGNS))
        return (word[:end], word[end:]) if 0 < end < len(word) and word[end - 1 : end + 1] not in self.joined else (word,)

    def encode(self, normal: list[str]) -> list[bytes]:
        """Ids of normalised texts, packed as 4-byte numbers."""
        words = [self._split(text) for text in normal]
        parts = {w: self._cut(w) for w in set(itertools.chain.from_iterable(words))}
        self.known.learn(set(itertools.chain.from_iterable(parts.values())), self._spell_all)
        known = self.known.recent
        spelled = {w: known[ps[0]] if len(ps) == 1 else known[ps[0]] + known[ps[1]] for w, ps in parts.items()}
        packed = [b"".join(map(spelled.__getitem__, ws)) for ws in words]
        self.known.age()
        return packed if self.bytes else list(map(self._merge_unknown, packed))

    def _spell_all(self, words: set[str]) -> Iterator[tuple[str, bytes]]:
        for word, numbers, lengths in self._paths(words):
            ids = self._spelled_ids(word, numbers, lengths)
            yield word, _packed(len(ids))(*ids)

    def _merge_unknown(self, packed: bytes) -> bytes:
        """Neighbouring unknown characters are one unknown."""
        ids = np.frombuffer(packed, dtype="<i4")
        same = np.concatenate(([False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)))[: len(ids)]
        return ids[~same].tobytes()

    @functools.cached_property
    def _spelled(self) -> list[bytes]:
        kinds = {_BYTE: lambda p: bytes([int(p[3:5], 16)]), _CONTROL: lambda p: b"", _UNKNOWN: lambda p: " ⁇ ".encode()}
        return [kinds.get(t, lambda p: p.replace(MARK, " ").encode())(p) for p, _, t in self.pieces]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self._spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@functools.cache
def _packed(count: int):
    return struct.Struct(f"<{count}i").pack


_NO_IDS = pa.array([], pa.int32())


def _loaded(path: str):
    """The model with what it has learnt, and the normaliser. A worker keeps those of the last path until ``base.forget``."""

    def load():
        import sentencepiece

        return Model.load(path), sentencepiece.SentencePieceProcessor(model_file=path).normalize

    return base.kept(f"pieces {path}", load)


def _encoded(path: str, texts: list[str | None]) -> Iterator[list[bytes]]:
    model, normalise = _loaded(path)
    for chunk in base.chunks(texts):
        yield model.encode([normalise(text) if text else "" for text in chunk])


def encode(docs: DataFrame, model: str, column: str = "ids", decoded: bool = False) -> DataFrame:
    """``docs`` with the ids of ``text``; ``model`` is the path of the model file. A column of that name is replaced.

    With ``decoded``, ``text`` is spelled from the ids in the same pass, which spares a second set of Python workers.
    """
    kept = docs.drop(column)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType(), False))])
    at = kept.columns.index("text")

    def run(batches):
        for batch in batches:
            start = 0
            for packed in _encoded(model, batch.column(at).to_pylist()):
                ids = pa.array([np.frombuffer(p, dtype="<i4") for p in packed], pa.list_(pa.int32()))
                part = batch.slice(start, len(packed))
                columns = part.columns
                if decoded:
                    spell = _loaded(model)[0].decode
                    columns[at] = pa.array([spell(np.frombuffer(p, dtype="<i4").tolist()) for p in packed], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, ids], names=[*part.schema.names, column])
                start += len(packed)

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, column: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with ``text`` spelled from the ids; NULL ids give an empty text. A column of that name is replaced in its place."""
    names = encoded.columns if text in encoded.columns else [*encoded.columns, text]
    fields = {f.name: f for f in encoded.schema.fields} | {text: T.StructField(text, T.StringType())}
    at = encoded.columns.index(column)

    def run(batches):
        spell = _loaded(model)[0].decode
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            lists = batch.column(at)
            # Row by row: as Python numbers, the ids of a whole batch would be many times its size.
            columns[text] = pa.array((spell((lists[k].values or _NO_IDS).to_pylist()) for k in range(len(lists))), pa.string())
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return encoded.mapInArrow(run, T.StructType([fields[n] for n in names]))


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, decoded_crc32, same)`` of every row: length and CRC-32 of the ids (4-byte numbers), CRC-32 of
    the decoded text in UTF-8, and whether it is the text itself (NULL as empty)."""

    def run(batches):
        for batch in batches:
            texts, rows = batch.column(1).to_pylist(), []
            for packed in _encoded(model, texts):
                for p in packed:
                    back, text = _loaded(model)[0].decode(np.frombuffer(p, dtype="<i4").tolist()), texts[len(rows)] or ""
                    rows.append((len(p) // 4, zlib.crc32(p), zlib.crc32(back.encode()), back == text))
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "same"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, same boolean")
