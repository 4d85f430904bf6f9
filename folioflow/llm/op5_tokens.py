"""Token-ID output in a canonical, length-limited Huffman format.

Code lengths come from the id counts of the whole corpus (package-merge, at most
MAX_BITS bits); codes are canonical, so the lengths are the code book.  Files
hold independent blocks of whole documents: bit stream, documents, and the bit
offset of every CHECKPOINT-th id.  A decoder starts at all checkpoints of a
block at once and looks up MAX_BITS bits per id in one table.

Files are Parquet containers of blocks, written by Spark: any store, Spark's
commit protocol, and lost executors are no matter.  Blocks follow doc_id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, documents, partitions, scratch, stored
from .kernels import U64, chunks, released, texts_of

MAX_BITS = 16
CHECKPOINT = 256
#: Ids in a block, about; a longer document is a block of its own.
BLOCK_IDS = 1 << 19
#: Ids fit this range; a bound on everything that is kept per id.
MOST_IDS = 1 << 16
END_ID = 2
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- the code -------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `most` bits for the ids that occur (package-merge); 0 for the others."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(ids) <= 1:
        out[ids] = 1
        return out
    if len(ids) > 1 << most:
        raise ValueError(f"{len(ids)} ids do not fit codes of {most} bits")
    order = ids[np.argsort(counts[ids], kind="stable")]
    weight = counts[order].astype(np.int64)
    level, is_leaf = weight, [np.ones(len(weight), bool)]
    for _ in range(most - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        leaf = np.concatenate([np.ones(len(weight), bool), np.zeros(len(pairs), bool)])
        sort = np.argsort(both, kind="stable")
        level = both[sort]
        is_leaf.append(leaf[sort])
    take, depth = 2 * (len(weight) - 1), np.zeros(len(weight), np.uint8)
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = depth
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes of the lengths: by length, then id."""
    codes, code, before = np.zeros(len(lengths), np.uint32), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0].tolist():
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream, and the bit offset of every CHECKPOINT-th id."""
    size = lengths[ids].astype(np.int64)
    if len(ids) and not size.all():
        raise ValueError("an id without a code")
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ids) else 0
    at = ends - size
    value = codes[ids].astype(U64) << (64 - size - (at & 31)).astype(U64)
    words = np.zeros((total >> 5) + 2, np.uint32)
    if len(ids):
        word = at >> 5
        group = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[group]] |= np.bitwise_or.reduceat((value >> U64(32)).astype(np.uint32), group)
        words[word[group] + 1] |= np.bitwise_or.reduceat((value & U64(0xFFFFFFFF)).astype(np.uint32), group)
    return words.astype(">u4").tobytes()[: (total + 7) >> 3], at[::CHECKPOINT].astype(np.uint32)


class Decoder:
    def __init__(self, lengths: np.ndarray):
        codes = canonical(lengths)
        self.symbol, self.bits = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)
        for i in np.flatnonzero(lengths).tolist():
            free = MAX_BITS - int(lengths[i])
            first = int(codes[i]) << free
            self.symbol[first : first + (1 << free)] = i
            self.bits[first : first + (1 << free)] = lengths[i]

    def decode(self, payload: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        """All n ids of a block, from all checkpoints in step."""
        if not n:
            return np.empty(0, np.uint32)
        raw = np.frombuffer(payload + bytes(CHECKPOINT * MAX_BITS // 8 + 8), np.uint8).astype(np.uint32)
        four = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = marks.astype(np.int64)
        out = np.empty((len(marks), CHECKPOINT), np.uint32)
        limit = len(four) - 1
        for j in range(min(CHECKPOINT, n)):
            look = (four[np.minimum(at >> 3, limit)] >> (16 - (at & 7)).astype(np.uint32)) & 0xFFFF
            out[:, j] = self.symbol[look]
            at += self.bits[look]
        return out.reshape(-1)[:n] if len(marks) * CHECKPOINT >= n else out.reshape(-1)


# ---- tokens ---------------------------------------------------------------


def _tokenize(path: str, end: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        from .word_bpe import encoder

        enc = encoder(path)
        for batch in batches:
            _, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets, 1 << 20):
                texts = [t or "" for t in batch.column(1).slice(first, last - first).to_pylist()]
                count, ids = enc.encode(texts)
                if len(ids) and ids.max() >= MOST_IDS:
                    raise ValueError(f"ids must be below {MOST_IDS}")
                # The end id after each document.
                ids = np.insert(ids, np.cumsum(count), end).astype("<u2")
                cut = np.concatenate([[0], np.cumsum(count + 1)]) * 2
                column = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first).cast(pa.int64()), pa.array(count + 1), column], schema=schema)

    return run


def tokenized(docs: DataFrame, path: str | None = None, end: int = END_ID) -> DataFrame:
    """(doc_id, n, ids): a document's ids with the end id, as little-endian 16-bit integers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(_tokenize(path or tokenizer_path(), end)), "doc_id long, n long, ids binary")


def _count(batches):
    total = np.zeros(MOST_IDS, np.int64)
    for batch in batches:
        data, _ = _bytes_of(batch.column(0))
        total += np.bincount(data.view("<u2"), minlength=MOST_IDS)
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


# ---- files ----------------------------------------------------------------

_BLOCK = "part int, block int, first long, n long, doc_ids binary, no_id binary, sizes binary, marks binary, payload binary"
_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int64())] + [(x, pa.binary()) for x in ("doc_ids", "no_id", "sizes", "marks", "payload")])


def _write(side):
    def run(batches):
        lengths = side.value
        codes = canonical(lengths)
        part, block, first = 0, 0, 0
        held: list = []
        size = 0

        def flush():
            ids = np.concatenate([x[2] for x in held])
            payload, marks = encode_bits(ids, codes, lengths)
            rows = [np.concatenate([x[k] for x in held]) for k in (0, 1, 3)]
            values = [part, block, first, len(ids), rows[0].astype("<i8").tobytes(), np.packbits(rows[1]).tobytes(), rows[2].astype("<i8").tobytes(), marks.astype("<u4").tobytes(), payload]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, _BLOCK_ARROW, strict=True)], schema=_BLOCK_ARROW), len(ids)

        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            data, offsets = _bytes_of(batch.column(1))
            no_id = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            doc_ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets, 2 * BLOCK_IDS // 4):
                held.append((doc_ids[a:b], no_id[a:b], data[offsets[a] : offsets[b]].view("<u2").astype(np.int64), np.diff(offsets[a : b + 1]) // 2))
                size += len(held[-1][2])
                if size >= BLOCK_IDS:
                    out, n = flush()
                    yield out
                    block, first, held, size = block + 1, first + n, [], 0
        if held:
            yield flush()[0]

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END_ID) -> str:
    """Writes docs' ids in ascending doc_id order under path: blocks/, codebook/ and parts/ (first id of each part).

    Null texts are empty texts; a null doc_id comes first; rows of equal doc_id
    are ordered by a checksum of their ids, then their ids, so reruns agree and
    repeated rows follow each other.  Long texts are encoded whole.  An empty
    table writes no block.  Other columns are not read.
    """
    spark = docs.sparkSession
    ids = stored(tokenized(docs, tokenizer, end), "ids")
    counts = ids.select("ids").mapInArrow(released(_count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most MOST_IDS rows
    total = np.zeros(MOST_IDS, np.int64)
    for r in counts:
        total[r.id] = r.n
    lengths = code_lengths(total)
    have = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in have], "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    side = spark.sparkContext.broadcast(lengths)
    # A checksum spreads rows of one doc_id and keeps their order.
    line = ids.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first(), F.crc32("ids"))
    line = line.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.crc32("ids"), "ids")
    line.select("doc_id", "ids", F.spark_partition_id().alias("part")).mapInArrow(released(_write(side)), _BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    discard(ids)
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.select("part", F.coalesce(before, F.lit(0)).alias("start")).write.parquet(f"{path}/parts")
    return path


def _read(side):
    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        decoder = Decoder(side.value)
        for batch in batches:
            for r in batch.to_pylist():
                ids = decoder.decode(r["payload"], np.frombuffer(r["marks"], "<u4"), r["n"])
                sizes = np.frombuffer(r["sizes"], "<i8")
                docs = np.frombuffer(r["doc_ids"], "<i8")
                none = np.unpackbits(np.frombuffer(r["no_id"], np.uint8))[: len(docs)].astype(bool)
                ends = np.cumsum(sizes)
                offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), r["part"], np.int32)), pa.array(r["first"] + ends - sizes), pa.array(docs, mask=none), pa.array(sizes), raw], schema=schema)

    return run


def _digest(read):
    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in read(batches):
            data, off = _bytes_of(b.column(4))
            view = memoryview(data)
            crc = [zlib.crc32(view[x:y]) for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(crc, pa.int64())], schema=schema)

    return run


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files, ids as little-endian 32-bit integers; or ids_crc32 in their place."""
    lengths = np.zeros(MOST_IDS, np.uint8)
    for r in spark.read.parquet(f"{path}/codebook").collect():  # at most MOST_IDS rows
        lengths[r.id] = r.length
    read = _read(spark.sparkContext.broadcast(lengths))
    last = "ids_crc32 long" if digest else "ids binary"
    rows = spark.read.schema(_BLOCK).parquet(f"{path}/blocks").mapInArrow(released(_digest(read) if digest else read), f"part int, first long, doc_id long, n_tokens long, {last}")
    return rows.join(spark.read.parquet(f"{path}/parts"), "part").select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", last.split()[0])


def token_digests(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, scratch(spark, "tokens")), digest=True)


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir))
