"""Token ids in length-delimited binary records, with an offset index beside them.

A record is: length of the payload (8 bytes), masked CRC-32C of these 8 bytes (4), payload, masked CRC-32C of
the payload (4), all little-endian; this is the framing of TFRecord files. A payload is the doc_id (8 bytes; the
least 64-bit number stands for NULL) and the ids of one document, 2 bytes each for vocabularies of up to
65,536 ids and 4 bytes otherwise.

Documents are range-partitioned by doc_id and sorted, so that the files in the order of their part numbers, read one
after the other, hold them in ascending order (NULL first, rows with one doc_id by text). The index is a table with a
row per record: ``part``, ``record``, ``file``, ``offset``, ``length``, ``doc_id``, ``n_tokens``. It may be shuffled,
sampled or split in any way before the records are read. Reading checks lengths and checksums and fails on damage.

NULL texts are empty; an empty text is the end id alone. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from . import base, files

# Fixed values of the framing: the reflected polynomial of CRC-32C and the constant of the mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

INDEX = "part int, record long, file string, offset long, length long, doc_id long, n_tokens long"
_NULL_ID = -(1 << 63)
_CACHED = 1_400_000


# Checksums: CRCs are linear, so those of many records are folded together pairwise, level by level.


def _spread(images: list[int]) -> np.ndarray:
    """Table of a linear map from the images of its bits."""
    table = np.zeros(1, dtype=np.uint32)
    for image in images:
        table = np.concatenate((table, table ^ np.uint32(image)))
    return table


@functools.cache
def _two_bytes() -> np.ndarray:
    def step(register: int, bits: int) -> int:
        for _ in range(bits):
            register = register >> 1 ^ (POLYNOMIAL if register & 1 else 0)
        return register

    return _spread([step(1 << k, 16) for k in range(16)])


@functools.cache
def _append_zeros(level: int) -> tuple[np.ndarray, np.ndarray]:
    """What appending ``2 ** (level + 1)`` zero bytes does to the lower and the upper half of a checksum."""
    if level == 0:
        low = _two_bytes()
        return low, _spread([1 << k for k in range(16)])  # the upper half moves down unchanged
    low, high = _append_zeros(level - 1)
    images = [int(low[b & 0xFFFF] ^ high[b >> 16]) for b in ((int(low[1 << k]) if k < 16 else int(high[1 << k - 16])) for k in range(32))]
    return _spread(images[:16]), _spread(images[16:])


def masked_crcs(payloads: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each payload of at least 4 bytes."""
    out = np.zeros(len(payloads), dtype=np.uint32)
    lengths = np.array([len(p) for p in payloads])
    levels = np.ceil(np.log2(np.maximum(lengths, 4))).astype(int) - 1
    for level in np.unique(levels):
        rows = np.flatnonzero(levels == level)
        width = 2 << level
        grid = np.zeros((len(rows), width), dtype=np.uint8)
        for at, row in zip(grid, rows):  # zeros in front change nothing when the start value is in the data
            at[width - lengths[row] :] = np.frombuffer(payloads[row], dtype=np.uint8)
            at[width - lengths[row] : width - lengths[row] + 4] ^= 0xFF
        sums = _two_bytes()[grid.view("<u2")]
        for k in range(level):
            low, high = _append_zeros(k)
            left = sums[:, 0::2]
            sums = low[left & 0xFFFF] ^ high[left >> 16] ^ sums[:, 1::2]
        out[rows] = ~sums[:, 0]
    return (out >> np.uint32(15) | out << np.uint32(17)) + np.uint32(MASK_DELTA)


# Encoding


class Encoder:
    """Ids of texts from a tokenizer file; words seen before are looked up.

    Byte-level tokenizers split a text before a space or line break between two characters that aren't white space,
    whatever stands around it, so the ids of a text are those of its words in a row.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = line_break[0] if len(line_break) == 1 else None
        self.known: dict[str, bytes] = {}

    _SPLIT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
    _DOUBLE = re.compile(r"\s\s")

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _encode_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of words. Those of letters and digits are encoded as lines of one text, where a line break is always an id of its own."""
        lines, others = [], []
        for word in words:
            as_line = self.line_break is not None and (word[1:] if word[:1] == "\0" else word).isalnum()
            (lines if as_line else others).append(word)
        for at in range(0, len(lines), 4096):
            part = lines[at : at + 4096]
            text = "\n".join([w[1:] if w[0] == "\0" else " " + w for w in part])
            (encoded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype=f"<u{self.width}")
            ends = np.flatnonzero(ids == self.line_break)
            packed, ends = ids.tobytes(), [*(ends * self.width).tolist(), len(ids) * self.width]
            if len(ends) != len(part):
                raise ValueError("the tokenizer joins line breaks with what stands around them")
            begins = [0, *(end + self.width for end in ends[:-1])]
            yield from zip(part, [packed[begin:end] for begin, end in zip(begins, ends)])
        for at in range(0, len(others), 1024):
            part = others[at : at + 1024]
            encoded = self.tokenizer.encode_batch_fast([w[1:] if w.startswith("\0") else " " + w for w in part], add_special_tokens=False)
            yield from ((w, self._pack(e.ids)) for w, e in zip(part, encoded))

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [self._words(text) for text in texts]
        found = [list(map(self.known.get, w)) for w in words]
        gaps = [(ws, fs, [k for k, f in enumerate(fs) if f is None]) for ws, fs in zip(words, found) if None in fs]
        missing = {ws[k] for ws, _, places in gaps for k in places}
        if missing:
            if len(self.known) + len(missing) > _CACHED:  # what this batch needs stays: the frequent words are among it
                self.known = {w: f for ws, fs in zip(words, found) for w, f in zip(ws, fs) if f is not None}
            # Punctuation after a letter or digit is split off by the tokenizer too, so a word is encoded once with any ending.
            parts = {w: (w[: len(core)], "\0" + w[len(core) :]) for w in missing if (core := w.rstrip(string.punctuation)) != w and core[-1:].isalnum()}
            cores = {p for pair in parts.values() for p in pair if p not in self.known}
            cores.update(w for w in missing if w not in parts)
            self.known.update(self._encode_words(list(cores)))
            self.known.update((w, self.known[a] + self.known[b]) for w, (a, b) in parts.items())
            for ws, fs, places in gaps:
                for k in places:
                    fs[k] = self.known[ws[k]]
        end = self._pack([0])
        return [b"".join(f) + end for f in found]

    def _words(self, text: str) -> list[str]:
        """Words in a row, each with the space before it left out, or with a zero in front if there is none."""
        if "\0" in text or self._DOUBLE.search(text):
            return ["\0" + part for part in self._SPLIT.split(text)]
        return ("\0" + text.replace("\n", " \0\n \0")).split(" ")


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# Files


def write(docs: DataFrame, tokenizer: str, partitions: int | None = None) -> DataFrame:
    """Write the ids of all documents; returns the index, stored as a table. ``tokenizer`` is the path of its file."""
    folder = files.new_folder(docs.sparkSession, "token-records")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = rows.repartitionByRange(*([partitions] if partitions else []), "doc_id").sortWithinPartitions("doc_id", "text")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, uri, offset, record = _encoder(tokenizer), None, None, 0, 0
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if out is None and doc_ids:
                uri, out = files.create(folder, ".rec")
            at, sizes = 0, []
            for chunk in base.chunks(texts):
                encoded = encoder.encode(chunk)
                payloads = [np.int64(_NULL_ID if d is None else d).tobytes() + e for d, e in zip(doc_ids[at:], encoded)]
                lengths = [np.uint64(len(p)).tobytes() for p in payloads]
                heads, tails = masked_crcs(lengths), masked_crcs(payloads)
                out.write(b"".join(x for n, h, p, t in zip(lengths, heads, payloads, tails) for x in (n, h.tobytes(), p, t.tobytes())))
                sizes += [len(p) for p in payloads]
                at += len(chunk)
            sizes = np.array(sizes, dtype=np.int64)
            ends = offset + np.cumsum(sizes + 16)
            count = len(doc_ids)
            columns = [
                pa.array(np.full(count, files.partition()), pa.int32()), pa.array(np.arange(record, record + count)), pa.array([uri] * count, pa.string()),
                pa.array(ends - sizes - 16), pa.array(sizes + 16), pa.array(doc_ids, pa.int64()), pa.array((sizes - 8) // encoder.width),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "record", "file", "offset", "length", "doc_id", "n_tokens"])
            record += count
            offset = int(ends[-1]) if count else offset
        if out:
            out.close()

    return materialize(placed.mapInArrow(save, INDEX), "token-index")


def _checked(frames: list[bytes]) -> list[bytes]:
    """Payloads of the records, or an error."""
    heads, payloads = [f[:8] for f in frames], [f[12:-4] for f in frames]
    stored = np.array([[int.from_bytes(f[8:12], "little"), int.from_bytes(f[-4:], "little")] for f in frames], dtype=np.uint32)
    sizes = np.array([int.from_bytes(h, "little") for h in heads])
    good = (sizes == [len(p) for p in payloads]) & (masked_crcs(heads) == stored[:, 0]) & (masked_crcs(payloads) == stored[:, 1])
    if not good.all():
        raise ValueError(f"{(~good).sum()} damaged records")
    return payloads


def _payloads(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
    spans = zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist())
    frames, size = [], 0
    for frame in files.read_spans(spans):
        if frames and size + len(frame) > base.CHUNK_BYTES:
            yield _checked(frames)
            frames, size = [], 0
        frames.append(frame)
        size += len(frame)
    if frames:
        yield _checked(frames)


def _ids(payload: bytes, n_tokens: int) -> tuple[int | None, np.ndarray]:
    doc_id = int.from_bytes(payload[:8], "little", signed=True)
    ids = np.frombuffer(payload, dtype=f"<u{(len(payload) - 8) // n_tokens}", offset=8)
    return None if doc_id == _NULL_ID else doc_id, ids


def read(index: DataFrame) -> DataFrame:
    """``(part, record, doc_id, ids)`` of the records that the rows of an index name."""

    def load(batches):
        for batch in batches:
            at = 0
            for payloads in _payloads(batch):
                rows = [_ids(p, n) for p, n in zip(payloads, batch.column("n_tokens").to_pylist()[at:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part")[at : at + len(rows)], batch.column("record")[at : at + len(rows)], pa.array([d for d, _ in rows], pa.int64()), pa.array([i.astype(np.int32) for _, i in rows], pa.list_(pa.int32()))],
                    names=["part", "record", "doc_id", "ids"],
                )
                at += len(rows)

    return index.mapInArrow(load, "part int, record long, doc_id long, ids array<int>")


def digests(index: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the records: position in the whole run of ids, length and CRC-32 of the ids as 4-byte numbers."""

    def load(batches):
        for batch in batches:
            counts = batch.column("n_tokens").to_pylist()
            rows = []
            for payloads in _payloads(batch):
                for payload in payloads:
                    doc_id, ids = _ids(payload, counts[len(rows)])
                    rows.append((doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            doc_ids, lengths, crcs = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("record"), pa.array(doc_ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                names=["part", "record", "doc_id", "n_tokens", "ids_crc32"],
            )

    rows = index.mapInArrow(load, "part int, record long, doc_id long, n_tokens long, ids_crc32 long")
    # One row per file: small, so one task may order them.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    bases = parts.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    before = Window.partitionBy("part").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return rows.withColumn("within", within).join(bases, "part").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
