"""Token-id output in bit-packed blocks (operator 3).

Documents are dealt into shards by ranges of their id, encoded, and written
as blocks through Spark's Parquet writer (so a lost executor's output is
never half visible). A block holds whole documents, about ``block_tokens``
ids, each id in the fewest bits that hold the vocabulary, least significant
bit first:

    shard int, block int     place of the block in the file order
    start long               ids of the shard before the block
    n_tokens long            ids in the block
    bits int                 width of an id
    doc_ids array<long>      documents of the block, ascending
    doc_ends array<long>     where each one ends, in ids from the block start
    payload binary           the packed ids

Any id is found from (start, bits) alone: bit ``(i - start) * bits`` of the
payload; numpy unpacks a block, or a range of it, at once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.arrow import arrow_map, column, out
from tideline.llm.memo import MEMO_SIZE, Memo, batches_of

BLOCK_TOKENS = 1 << 16

BLOCK = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("bits", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("doc_ends", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])


def bits_for(vocab_size: int) -> int:
    """Fewest bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):  # whole bytes: the same layout as the general case
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from the ``start``-th on, reading only the bytes they lie in."""
    if n <= 0:
        return np.empty(0, np.uint32)
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count=n, offset=start * bits // 8).astype(np.uint32)
    first, last = start * bits // 8, -(-(start + n) * bits // 8)
    raw = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first), bitorder="little")
    each = raw[start * bits - 8 * first:][:n * bits].reshape(n, bits).astype(np.uint32)
    return each @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


_encoders: dict[tuple, Memo] = {}


def library_memo(path: str, size: int) -> Memo:
    """The tokenizers library, with the ids of repeated words remembered.

    Words are only cut where the tokenizer is plain byte-level BPE without
    prefix space or normaliser; texts that hold an added token's string go
    to the library whole, as does everything for other tokenizers.
    """
    key = (path, size)
    if key not in _encoders:
        import json

        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf.get("pre_tokenizer") or {}
        cuts = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                and pre.get("use_regex", True) and not conf.get("normalizer") and not conf.get("truncation"))
        added = [a["content"] for a in conf.get("added_tokens", [])]

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]

        _encoders[key] = Memo(encode, size, lambda x: not cuts or any(a in x for a in added))
    return _encoders[key]


def vocab_size(path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None,
                 shards: int | None = None, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id",
                 text_col: str = "text", memo_size: int = MEMO_SIZE) -> None:
    """Encode every text and write the blocks under ``path`` (replaced).

    Ids follow one another in ascending ``id_col`` (null ids first, rows of
    one id by their text); ``end_id`` is appended to every document. A null
    or empty text has no ids of its own. An empty table writes no block.
    Columns other than the two are ignored.
    """
    bits = bits_for(max(vocab_size(tokenizer), (end_id or 0) + 1))
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(id_col).cast("long").alias("_id"),
                           F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
               .repartitionByRange(n, F.col("_id").asc_nulls_first())
               .sortWithinPartitions(F.col("_id").asc_nulls_first(), "_text"))
    tail = [] if end_id is None else [np.array([end_id], "<u4").tobytes()]

    def run(it):
        from pyspark import TaskContext
        memo, shard = library_memo(tokenizer, memo_size), TaskContext.get().partitionId()
        doc_ids, ends, parts, block, start, held = [], [], [], 0, 0, 0

        def close():
            ids = np.frombuffer(b"".join(parts), "<u4")
            return out(BLOCK.names, pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                       pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
                       pa.array([bits], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
                       pa.array([ends], pa.list_(pa.int64())), pa.array([pack(ids, bits)], pa.binary()))

        for b in it:
            doc = iter(column(b, "_id").to_pylist())
            for some in batches_of(column(b, "_text").to_pylist()):
                for ids in memo.encode_texts(some):
                    parts += [ids, *tail]
                    held += len(ids) // 4 + len(tail)
                    doc_ids.append(next(doc))
                    ends.append(held)
                    if held >= block_tokens:
                        yield close()
                        block, start = block + 1, start + held
                        doc_ids, ends, parts, held = [], [], [], 0
        if doc_ids:
            yield close()

    ordered.transform(arrow_map, run, BLOCK).write.mode("overwrite").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with ``start`` counted from the first id of all shards.

    Only the shard totals (a row per shard) meet in one task, for their
    running sum.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", before.alias("_before"))
    return (blocks.join(F.broadcast(offsets), "shard")  # a row per shard: as many as write tasks
            .withColumn("start", F.col("start") + F.col("_before")).drop("_before"))


def read_docs(blocks: DataFrame, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of the blocks.

    ids_crc32 is the unsigned CRC-32 of the ids as little-endian uint32;
    ids is that binary.
    """
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] * keep_ids

    def run(it):
        for b in it:
            for r in b.to_pylist():
                ids = unpack(r["payload"], r["bits"], 0, r["n_tokens"]).astype("<u4")
                ends = np.array(r["doc_ends"], np.int64)
                begins = np.append(0, ends[:-1])
                raw = [ids[s:e].tobytes() for s, e in zip(begins, ends)]
                cols = [pa.array(r["doc_ids"], pa.int64()), begins + r["start"], ends - begins,
                        pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                yield out([f.name for f in fields], *cols, *[pa.array(raw, pa.binary())] * keep_ids)

    return blocks.select("start", "n_tokens", "bits", "doc_ids", "doc_ends", "payload").transform(arrow_map,
        run, T.StructType(fields))


def read_range(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of the whole output: only the blocks they lie in are unpacked."""
    hit = read_blocks(spark, path).where((F.col("start") < start + n) & (F.col("start") + F.col("n_tokens") > start))
    parts = []
    for r in hit.orderBy("start").select("start", "n_tokens", "bits", "payload").toLocalIterator():
        a = max(start, r["start"]) - r["start"]
        parts.append(unpack(r["payload"], r["bits"], a, min(start + n, r["start"] + r["n_tokens"]) - r["start"] - a))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)
