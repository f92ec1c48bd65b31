import struct
import zlib

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from linkhoard.llm import files, records
from linkhoard.llm.base import tokenizer_file

from .conftest import documents, prose

TOKENIZER = "byte_bpe_50k.json"
TEXTS = {
    5: "Hello world's   twelve 123 ...", 3: "", 9: None, 1: " lead and trail ", 7: "a\nb\n\nc \n d\t\te  f", 2: "naïve 日本語 🙂 a",
    8: "<|endoftext|> x", 4: "zero\0in it", 6: "\n\nx\n", 11: "word " * 40_000,
}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file(TOKENIZER))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_checksums_of_known_strings():
    def unmask(x):
        x = (int(x) - records.MASK_DELTA) % (1 << 32)
        return (x << 15 | x >> 17) % (1 << 32)

    def plain(data):
        register = 0xFFFFFFFF
        for byte in data:
            register ^= byte
            for _ in range(8):
                register = register >> 1 ^ (records.POLYNOMIAL if register & 1 else 0)
        return register ^ 0xFFFFFFFF

    given = [b"123456789", b"abcd", bytes(8), bytes(range(256)) * 3, b"\xff" * 37, b"x" * 5]
    assert [unmask(x) for x in records.masked_crcs(given)] == [plain(g) for g in given]
    assert unmask(records.masked_crcs([b"123456789"])[0]) == 0xE3069283


def test_digests_match_brute_force(spark, rng, tokenizer):
    texts = TEXTS | {100 + i: prose(rng, 50) + "\n" + prose(rng, 5) for i in range(40)}
    want, start = set(), 0
    for i in sorted(texts):
        ids = tokenizer(texts[i])
        want.add((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    index = records.write(documents(spark, texts, extra=True), tokenizer_file(TOKENIZER), partitions=4)
    assert {tuple(r) for r in records.digests(index).collect()} == want
    shuffled = records.read(index.orderBy(F.rand(3)))  # any order of the index
    assert {r["doc_id"]: r["ids"] for r in shuffled.collect()} == {i: tokenizer(t) for i, t in texts.items()}


def test_files_have_the_stated_frames(spark, tokenizer):
    index = records.write(documents(spark, {1: "one two", 2: "three"}), tokenizer_file(TOKENIZER), partitions=1).orderBy("record").collect()
    system, path = fs.FileSystem.from_uri(index[0]["file"])
    data = system.open_input_file(path).read()
    assert [r["offset"] for r in index] == [0, index[0]["length"]] and len(data) == sum(r["length"] for r in index)
    (length,) = struct.unpack("<Q", data[:8])
    assert length + 16 == index[0]["length"]
    assert struct.unpack("<q", data[12:20]) == (1,)
    assert np.frombuffer(data[20 : 12 + length], "<u2").tolist() == tokenizer("one two")
    assert struct.unpack("<I", data[8:12])[0] == records.masked_crcs([data[:8]])[0]


def test_damage_is_found(spark):
    index = records.write(documents(spark, {1: "one two"}), tokenizer_file(TOKENIZER), partitions=1)
    row = index.first()
    system, path = fs.FileSystem.from_uri(row["file"])
    data = bytearray(system.open_input_file(path).read())
    data[21] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        records._checked([bytes(data)])
    with pytest.raises(ValueError, match="ends before"):
        list(files.read_spans([(row["file"], 0, row["length"] + 1)]))


def test_repeated_rows_null_ids_and_empty_tables(spark, tokenizer):
    rows = [(2, "b"), (2, "b"), (None, "n"), (1, None)]
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"]) for r in records.digests(records.write(documents(spark, rows), tokenizer_file(TOKENIZER))).collect()), key=lambda x: x[1])
    assert got == [(None, 0, 2), (1, 2, 1), (2, 3, 2), (2, 5, 2)]
    assert records.digests(records.write(documents(spark, {}), tokenizer_file(TOKENIZER))).count() == 0
