"""Token ids as bit- or byte-planes: an id file format on Spark, written and read back.

A token folder is a Parquet table with a row per chunk of consecutive documents:
the planes of its ids, and as the chunk's index its documents and their numbers
of ids, which are read without the planes. Chunks are numbered by (part, chunk)
in the order of the ids; a chunk ends with a document.

Within a chunk ids are cut into blocks of a fixed number of ids, the last one
filled up with zeros. Each block is transposed into planes: plane p has bit or
byte p of every id. The same plane of all blocks is one run of bytes, compressed
by zstandard; high planes of small ids are all zero and nearly vanish.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlens.llm.common import text_of

CHUNKS = (
    "part int, chunk int, n_ids long, n_docs int, block int, unit string, planes array<binary>, "
    "lengths array<long>, doc_ids array<long>"
)


def pack(ids, block: int, unit: str, level: int = 3) -> list[bytes]:
    """The planes of an array of unsigned 32-bit ids, compressed; 4 byte planes or 32 bit planes, least first."""
    import numpy as np
    import zstandard

    padded = np.zeros(-(-len(ids) // block) * block, "<u4")
    padded[: len(ids)] = ids
    blocks = padded.view(np.uint8).reshape(-1, block, 4).transpose(2, 0, 1)
    if unit == "bit":
        bits = np.unpackbits(blocks[..., None], axis=-1, bitorder="little")
        blocks = np.packbits(bits.transpose(0, 3, 1, 2).reshape(32, -1, block), axis=-1, bitorder="little")
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(np.ascontiguousarray(p).tobytes()) for p in blocks]


def unpack(planes: list[bytes], n: int, block: int, unit: str):
    """The first n ids of planes made by ``pack``."""
    import numpy as np
    import zstandard

    if not n:
        return np.zeros(0, "<u4")
    press = zstandard.ZstdDecompressor()
    raw = np.stack([np.frombuffer(press.decompress(bytes(p)), np.uint8) for p in planes])
    if unit == "bit":
        bits = np.unpackbits(raw, axis=-1, bitorder="little").reshape(4, 8, -1)
        raw = np.packbits(bits.transpose(0, 2, 1), axis=-1, bitorder="little").reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()[:n]


def encoding(tokenizer: str, by_word: bool, end_id: int, chunk_ids: int, block: int, unit: str) -> Callable:
    """The function that turns sorted batches of doc_id and text into chunk rows.

    ``tokenizer`` is the content of a tokenizer's file. With ``by_word`` texts
    are encoded word by word, which is right for tokenizers that set case aside,
    drop white space, and join neither what it parts nor letters and marks. A
    worker keeps the ids of one and a half million words and then begins anew.
    """

    def run(batches: Iterator) -> Iterator:
        import hashlib
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa
        import tokenizers
        from pyspark import TaskContext

        # Worker processes outlive tasks; the library's module holds what the next task can use.
        kept = tokenizers.__dict__.setdefault("_kept_words", {})
        name = hashlib.md5(tokenizer.encode()).digest()
        if name not in kept:
            kept[name] = (tokenizers.Tokenizer.from_str(tokenizer), {})
        model, store = kept[name]
        most = 3 << 19

        def raw(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in model.encode_batch_fast(texts, add_special_tokens=False)]

        def learn(new: set[bytes]) -> None:
            """Ids of new words; a word of letters and closing marks is put together from both."""
            if len(store) + len(new) > most:
                store.clear()
            parts = {}
            for w in new:
                core = w.rstrip(b".,;:!?")
                parts[w] = (core, w[len(core) :]) if core != w and core[-1:].isalpha() and core.isascii() else (w, b"")
            missing = list({p for both in parts.values() for p in both if p not in store})
            for at in range(0, len(missing), 10_000):
                some = missing[at : at + 10_000]
                store.update(zip(some, raw([p.decode() for p in some])))
            store.update({w: store[core] + store[tail] for w, (core, tail) in parts.items() if tail})

        def encode(texts: list[str]) -> list[bytes]:
            if not by_word:
                return raw(texts)
            split, found, new = [], [], set()
            for text in texts:
                data = text.encode()
                # Special tokens are the only strings whose case matters, and they begin so. A letter joins marks
                # from U+0300 to U+036F before case is set aside, and some only join small letters.
                if b"<|" in data:
                    words = data.split()
                elif b"\xcc" in data or b"\xcd" in data:
                    words = [w.lower() if w.isascii() else w for w in data.split()]
                else:
                    words = data.lower().split()
                ids_of = list(map(store.get, words))
                if None in ids_of:
                    new.update([w for w, x in zip(words, ids_of) if x is None])
                split.append(words)
                found.append(ids_of)
            if new:
                learn(new)
                for words, ids_of in zip(split, found):
                    for k, x in enumerate(ids_of):
                        if x is None:
                            ids_of[k] = store[words[k]]
            return [b"".join(ids_of) for ids_of in found]

        part, chunk = TaskContext.get().partitionId(), 0
        ids, lengths, doc_ids = [], [], []
        end = np.array([end_id], "<u4").tobytes()

        def row() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u4")
            values = [part, chunk, len(flat), len(lengths), block, unit, pack(flat, block, unit), lengths, doc_ids]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        names = ["part", "chunk", "n_ids", "n_docs", "block", "unit", "planes", "lengths", "doc_ids"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.binary())]
        kinds += [pa.list_(pa.int64()), pa.list_(pa.int64())]
        size = 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(keys), 256):
                for key, got in zip(keys[at : at + 256], encode(texts[at : at + 256])):
                    ids += [got, end]
                    lengths.append(len(got) // 4 + 1)
                    doc_ids.append(key)
                    size += lengths[-1]
                    if size >= chunk_ids:
                        yield row()
                        ids, lengths, doc_ids, size, chunk = [], [], [], 0, chunk + 1
        if lengths:
            yield row()

    return run


def decoding() -> Callable:
    """The function that turns chunk rows into a row per document: its ids' place in the chunk, number and crc32."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["planes"], r["n_ids"], r["block"], r["unit"])
                ends = np.cumsum(np.array(r["lengths"], np.int64))
                starts = ends - np.array(r["lengths"], np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                n = len(crc)
                columns = [
                    pa.array([r["part"]] * n, pa.int32()), pa.array([r["chunk"]] * n, pa.int32()),
                    pa.array(r["doc_ids"], pa.int64()), pa.array(starts), pa.array(r["lengths"], pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "doc_id", "at", "n_tokens", "ids_crc32"])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    by_word: bool = False,
    chunk_ids: int = 1 << 18,
    block: int = 4096,
    unit: str = "byte",
) -> None:
    """Encodes all texts and writes their ids to a new folder in ascending doc_id order.

    Null texts are empty, so they have the end id alone; null ids come first;
    rows with equal ids follow each other by a hash of their texts. doc_id must
    be an integer. Other columns play no part. An empty table gives no chunk.
    Rows are dealt by ranges of id, text hash and place of reading, so that many
    rows with one id still spread over tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("key"), F.col("place")]
    keyed = rows.withColumns({"key": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    chunks = ranges.mapInArrow(encoding(tokenizer, by_word, end_id, chunk_ids, block, unit), CHUNKS)
    chunks.write.parquet(path)


def starts(chunks: DataFrame) -> DataFrame:
    """part, chunk and the number of ids before it. The window without a key sees one row per part."""
    sums = chunks.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    before = F.sum("of_part").over(W.orderBy("part")) - F.col("of_part")
    parts = sums.select("part", before.alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("chunk")) - F.col("n_ids")
    return chunks.select("part", "chunk", "n_ids", inside.alias("inside")).join(parts, "part").select(
        "part", "chunk", (F.col("before") + F.col("inside")).alias("chunk_start")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """A row per document of a token folder: doc_id, start, n_tokens, ids_crc32, read from the planes."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    docs = chunks.mapInArrow(
        decoding(), "part int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    placed = docs.join(starts(chunks.select("part", "chunk", "n_ids")), ["part", "chunk"])
    return placed.select("doc_id", (F.col("chunk_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
