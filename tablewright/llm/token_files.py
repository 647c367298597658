"""Token ids in binary files, coded by a static range asymmetric numeral system (rANS).

Format. A folder of Parquet files whose rows are segments: ``part`` and ``start`` (ids before the segment
inside its part) place it, ``n_docs`` and ``n_tokens`` size it, ``payload`` is the binary segment below.
Spark's writer commits the files, so a lost executor repeats its own task and leaves nothing half written.

    header     magic, then 32-bit little-endian: docs, ids, blocks, lanes, steps, symbols, bits of the scale
    documents  keys (64 bits) and id counts (32 bits), zlib
    table      symbols and frequencies (32 bits each), zlib: shared by all blocks of the segment
    blocks     for each: first word, number of words, CRC-32 of its ids: the checkpoints
    states     the decoder's 64-bit state of each lane of each block
    words      32-bit words of all blocks

A block is a run of ids dealt in turn to independent lanes. Every block has its own states, word range and
checksum, so blocks decode in parallel and alone; ``decode`` takes all blocks of a segment as one array.

Documents are in ascending key order over parts, segments and places. Null keys come first; equal keys
stand together, in no set order between themselves. A null or empty text holds the end id alone. An empty
table gives no segments. A document is never cut, so one segment holds at least one whole document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.bpe import encoder, vocabulary
from tablewright.llm.common import pieces, ship

MAGIC = b"RANS1\x00\x00\x00"
HEADER = struct.Struct("<8s7I")
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LANES = 64
BLOCK = 1 << 16
SEGMENT = 1 << 21
SCALE = 20
NULL_KEY = -(2**63)


def _frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Counts scaled to a sum of 2 ** bits with no zero among them."""
    total = 1 << bits
    out = (counts * (total - len(counts)) // counts.sum()).astype(np.int64) + 1
    out[np.argmax(out)] += total - out.sum()
    return out


def encode_segment(keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment; ``keys`` int64 and ``counts`` of each document, ``ids`` of all of them in order."""
    n = len(ids)
    if ids.max() < 1 << 22:
        counted = np.bincount(ids)
        symbols = np.flatnonzero(counted)
        seen = counted[symbols]
        places = np.zeros(len(counted), np.int32)
        places[symbols] = np.arange(len(symbols))
        coded = places[ids]
    else:
        symbols, coded, seen = np.unique(ids, return_inverse=True, return_counts=True)
    bits = min(SCALE, max(8, int(len(symbols)).bit_length() + 4))
    if len(symbols) >= 1 << (SCALE - 1):
        raise ValueError("too many distinct ids for the scale of the format")
    freq = _frequencies(seen, bits)
    first = np.concatenate([[0], np.cumsum(freq)[:-1]])
    blocks = max(1, -(-n // BLOCK))
    steps = -(-n // (blocks * LANES))
    padded = np.full(blocks * steps * LANES, int(seen.argmax()), np.int32)
    padded[:n] = coded
    # (step, block, lane): all blocks and lanes advance together.
    grid = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).transpose(1, 0, 2))
    freq64, first64 = freq.astype(np.uint64), first.astype(np.uint64)
    limit = freq64 << np.uint64(63 - bits)
    shift = np.uint64(bits)
    state = np.full((blocks, LANES), LOW, np.uint64)
    words = np.empty(grid.shape, np.uint32)
    full = np.empty(grid.shape, bool)
    for t in range(steps - 1, -1, -1):
        s = grid[t]
        f = freq64[s]
        over = state >= limit[s]
        full[t] = over
        words[t] = state  # the low half
        state = np.where(over, state >> WORD, state)
        q = state // f
        state = (q << shift) + (state - q * f) + first64[s]
    streams = [words[:, b][full[:, b]] for b in range(blocks)]
    sizes = np.array([len(x) for x in streams], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    raw = np.ascontiguousarray(ids, "<u4")
    per = steps * LANES
    sums = [zlib.crc32(raw[b * per : (b + 1) * per].tobytes()) for b in range(blocks)]
    docs = zlib.compress(np.asarray(keys, "<i8").tobytes() + np.asarray(counts, "<u4").tobytes(), 1)
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    return b"".join(
        [
            HEADER.pack(MAGIC, len(keys), n, blocks, LANES, steps, len(symbols), bits),
            struct.pack("<II", len(docs), len(table)),
            docs,
            table,
            np.stack([starts, sizes, np.array(sums, np.int64)], 1).astype("<u4").tobytes(),
            state.astype("<u8").tobytes(),
            *(x.astype("<u4").tobytes() for x in streams),
        ]
    )


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, counts, ids) of a segment; raises if a checksum or the end of a lane does not hold."""
    magic, n_docs, n, blocks, lanes, steps, n_symbols, bits = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    at = HEADER.size
    docs_size, table_size = struct.unpack_from("<II", data, at)
    at += 8
    docs, at = zlib.decompress(data[at : at + docs_size]), at + docs_size
    table, at = zlib.decompress(data[at : at + table_size]), at + table_size
    keys, counts = np.frombuffer(docs, "<i8", n_docs), np.frombuffer(docs, "<u4", n_docs, 8 * n_docs)
    symbols = np.cumsum(np.frombuffer(table, "<u4", n_symbols).astype(np.int64))
    freq = np.frombuffer(table, "<u4", n_symbols, 4 * n_symbols).astype(np.int64)
    marks, at = np.frombuffer(data, "<u4", 3 * blocks, at).reshape(blocks, 3).astype(np.int64), at + 12 * blocks
    state, at = np.frombuffer(data, "<u8", blocks * lanes, at).reshape(blocks, lanes), at + 8 * blocks * lanes
    words = np.concatenate([np.frombuffer(data, "<u4", -1, at), np.zeros(1, np.uint32)]).astype(np.uint64)
    slots = np.repeat(np.arange(n_symbols, dtype=np.int32), freq)
    first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    freq64, mask, shift = freq.astype(np.uint64), np.uint64((1 << bits) - 1), np.uint64(bits)
    out = np.empty((steps, blocks, lanes), np.int32)
    place = marks[:, :1].copy()
    for t in range(steps):
        slot = state & mask
        s = slots[slot.astype(np.int64)]
        out[t] = s
        state = freq64[s] * (state >> shift) + slot - first[s]
        low = state < LOW
        taken = np.cumsum(low, axis=1)
        following = words[np.minimum(place + taken - 1, len(words) - 1)]
        state = np.where(low, (state << WORD) | following, state)
        place += taken[:, -1:]
    if (state != LOW).any():  # every lane ends where the encoder began
        raise ValueError("a lane of the segment does not end in its first state")
    ids = symbols[out.transpose(1, 0, 2).reshape(-1)[:n]].astype("<u4")
    per = steps * lanes
    for b in range(blocks):
        if zlib.crc32(ids[b * per : (b + 1) * per].tobytes()) != marks[b, 2]:
            raise ValueError(f"checksum of block {b} does not hold")
    return keys, counts, ids


# ---------------------------------------------------------------------- Spark


def tokenized(df: DataFrame, path: str, key: str, text: str, end_id: int, bounds: list[int]) -> DataFrame:
    """(part, key, n_tokens, ids): encoded documents with the range part that their key falls into.

    A key that is a bound several times over is spread over all the parts that it spans.
    """
    sent = vocabulary(df, path)
    ship(df.sparkSession)
    cuts = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            flat, offsets = encoder(sent.value).encode(piece.column(piece.schema.get_field_index(text)))
            # Ids for the shuffle: 16 bits each where all of the piece fit, which the first byte tells.
            width = 2 if end_id < 1 << 16 and (not len(flat) or flat.max() < 1 << 16) else 4
            raw, at = flat.astype(f"<u{width}").tobytes(), (offsets * width).tolist()
            mark, end = bytes([width]), end_id.to_bytes(width, "little")
            ids = [mark + raw[a:b] + end for a, b in zip(at, at[1:], strict=False)]
            keys = piece.column(piece.schema.get_field_index(key)).cast(pa.int64())
            values = keys.fill_null(NULL_KEY).to_numpy(zero_copy_only=False)
            part, right = np.searchsorted(cuts, values, "left"), np.searchsorted(cuts, values, "right")
            for i in np.flatnonzero(right > part).tolist():
                part[i] += zlib.crc32(ids[i]) % (right[i] - part[i] + 1)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), keys, pa.array(ids, pa.binary())], ["part", "key", "ids"])

    return df.select(key, text).mapInArrow(run, "part int, key long, ids binary")


def _wide(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if ids[0] == 2 else "<u4", -1, 1).astype(np.uint32)


def write_files(
    df: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, parts: int | None = None
) -> None:
    """Encode every text under the vocabulary at ``path``, append ``end_id``, and write the files."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / parts for i in range(1, parts)]
    found = df.select(F.percentile_approx(F.col(key).cast("bigint"), probs, 10 * parts + 10_000)).first()[0] if probs else []
    bounds = [int(b) for b in found or []]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, keys, ids, held = 0, 0, [], [], 0

        def segment() -> pa.RecordBatch:
            counts = [len(i) for i in ids]
            payload = encode_segment(np.array(keys, np.int64), np.array(counts), np.concatenate(ids))
            row = {"part": part, "start": start, "n_docs": len(keys), "n_tokens": held, "payload": payload}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema(
            [("part", pa.int32()), ("start", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            for p, k, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and (held >= SEGMENT or p != part):
                    yield segment()
                    start, keys, ids, held = (start + held if p == part else 0), [], [], 0
                part = p
                keys.append(NULL_KEY if k is None else k)
                ids.append(_wide(raw))
                held += len(ids[-1])
        if held:
            yield segment()

    coded = tokenized(df, path, key, text, end_id, bounds)
    placed = coded.repartitionById(parts, "part").sortWithinPartitions("part", F.col("key").asc_nulls_first())
    placed.mapInArrow(pack, "part int, start long, n_docs long, n_tokens long, payload binary").write.option(
        "compression", "none"
    ).parquet(folder)


def read_digests(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Read the files back: per document its key, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids_crc32``, the CRC-32 of its ids as little-endian 32-bit numbers."""
    ship(spark)
    files = spark.read.parquet(folder)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, data in zip(*(batch.column(c).to_pylist() for c in ("part", "start", "payload")), strict=True):
                keys, counts, ids = decode_segment(data)
                ends = np.cumsum(counts.astype(np.int64))
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), part, np.int32)),
                        pa.array(keys, mask=keys == NULL_KEY),
                        pa.array(start + ends - counts),
                        pa.array(counts.astype(np.int64)),
                        pa.array(np.array(sums, np.int64)),
                    ],
                    ["part", "key", "place", "n_tokens", "ids_crc32"],
                )

    docs = files.select("part", "start", "payload").mapInArrow(
        unpack, "part int, key long, place long, n_tokens long, ids_crc32 long"
    )
    # One row for each part, that is for each output task.
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return docs.join(bases, "part").select(
        F.col("key").alias(key), (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Read the files back as (key, ids array<bigint>)."""
    ship(spark)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                keys, counts, ids = decode_segment(data)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(keys, mask=keys == NULL_KEY), lists], [key, "ids"])

    return spark.read.parquet(folder).select("payload").mapInArrow(unpack, f"`{key}` long, ids array<bigint>")
