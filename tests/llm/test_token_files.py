from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from names import CLASHING
from tokenizers import Tokenizer

from mixlens.llm import token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 10_001])
def test_planes_round_trip(unit, n):
    rng = np.random.default_rng(n)
    for high in (2, 50_000, 2**32):
        ids = rng.integers(0, high, n).astype("<u4")
        planes = token_files.pack(ids, 512, unit)
        assert len(planes) == (32 if unit == "bit" else 4)
        assert np.array_equal(token_files.unpack(planes, n, 512, unit), ids)


def result(docs, path, tokenizer, **kwargs):
    token_files.write_tokens(docs, path, tokenizer, 2, **kwargs)
    return token_files.read_tokens(docs.sparkSession, path).collect()


TEXTS = [
    "Plain words, and a few more.", None, "", " \n\t ", "it's <|endoftext|>x <|start oftext|>", "é é ΑΣ ß\x1cz\x85q w v", "0123 4.5",
    "a" * 5000, "word " * 30_000, "😀 混合\r\ntext\x0b\x0c",
]


@pytest.mark.parametrize(
    ("tokenizer", "options"),
    [(WORDS, {"by_word": True}), (WORDS, {"by_word": True, "chunk_ids": 50, "block": 16, "unit": "bit"}), (BYTES, {"chunk_ids": 1000})],
)
def test_ids_against_the_tokenizer(documents, tmp_path, tokenizer, options):
    data = [(i * 7 - 20, t) for i, t in enumerate(TEXTS * 3)] + [(None, "null id")]
    got = result(documents(data[::-1], CLASHING), str(tmp_path / "t"), tokenizer, **options)
    model, at, want = Tokenizer.from_file(tokenizer), 0, []
    for i, text in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_repeated_ids_and_empty_table(documents, tmp_path):
    data = [(4, "b"), (4, "a"), (4, "a"), (3, "x y"), (None, "q"), (None, None)]
    got = sorted(result(documents(data), str(tmp_path / "t"), WORDS, by_word=True), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 3, 4, 4, 4]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert result(documents([]), str(tmp_path / "e"), WORDS, by_word=True) == []


def test_marks_that_only_join_small_letters(documents, tmp_path):
    """The tokenizer joins marks before it sets case aside: a capital and its mark stay two."""
    texts = ["T\u0308", "H\u0331a", "J\u030c.", "W\u030a", "Y\u030a", "Plain T\u05b0\u0308 Words", "E\u0301 t\u0308"]
    got = result(documents(list(enumerate(texts))), str(tmp_path / "t"), WORDS, by_word=True)
    model = Tokenizer.from_file(WORDS)
    ids = [np.array([*model.encode(t, add_special_tokens=False).ids, 2], "<u4") for t in texts]
    assert {r.doc_id: r.ids_crc32 for r in got} == {i: zlib.crc32(x.tobytes()) for i, x in enumerate(ids)}
