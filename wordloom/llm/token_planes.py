"""Token ids in binary blocks: bit or byte planes, each compressed, with a chunk index.

Documents are put in ascending id order by a range shuffle; partition p of it is shard p. A shard
is one stream of ids, every document closed by an end id, cut into blocks of equal length. A
block's ids are transposed into planes (all lowest bytes or bits, then the next ones), so that the
nearly empty high planes cost next to nothing, and every plane is compressed by zstandard.

Blocks are rows of a table: Spark's writer commits them, so a lost executor's shard is written
again and nothing is left half done, and any store that Spark writes to will do. The chunk index
is a second, small table that tells where each block lies in the whole stream.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm import encoding
from wordloom.llm.shipping import ship
from wordloom.workspace import shared_folder

BLOCK_IDS = 1 << 16
# Bytes of text encoded at once, and the one text that passes them; each takes many times its size meanwhile.
SLICE_BYTES = 1 << 20

_BLOCKS = (
    "shard int, block bigint, first bigint, n_ids bigint, unit string, planes array<binary>, "
    "first_doc bigint, doc_ids array<bigint>, doc_ends array<bigint>"
)
_SEGMENTS = (
    "shard int, doc_no bigint, block bigint, doc_id bigint, closed boolean, "
    "at bigint, n_ids bigint, crc bigint"
)


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of one block, lowest first; planes above the largest id are left out."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    top = int(ids.max()) if len(ids) else 0
    cells = ids.view(np.uint8).reshape(len(ids), 4)
    press = zstandard.ZstdCompressor(level=1).compress
    if unit == "byte":
        return [press(cells[:, k].tobytes()) for k in range(max(1, (top.bit_length() + 7) // 8))]
    bits = np.unpackbits(cells, axis=1, bitorder="little")
    count = max(1, top.bit_length())
    return [press(np.packbits(bits[:, k], bitorder="little").tobytes()) for k in range(count)]


def from_planes(planes: list[bytes], n_ids: int, unit: str) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    size = n_ids if unit == "byte" else (n_ids + 7) // 8
    raw = [np.frombuffer(expand(p, max_output_size=max(size, 1)), dtype=np.uint8) for p in planes]
    cells = np.zeros((n_ids, 4), dtype=np.uint8)
    if unit == "byte":
        for k, plane in enumerate(raw):
            cells[:, k] = plane
    else:
        bits = np.zeros((n_ids, 32), dtype=np.uint8)
        for k, plane in enumerate(raw):
            bits[:, k] = np.unpackbits(plane, count=n_ids, bitorder="little")
        cells = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(cells).view("<u4").reshape(n_ids)


class _Shard:
    """Collects ids of one shard and hands out full blocks."""

    def __init__(self, number: int, unit: str):
        self.number, self.unit = number, unit
        self.block = self.first = self.docs = self.held = 0
        self.parts: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.doc_ends: list[int] = []

    def add(self, ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> Iterator[dict]:
        """``ends``: where each of the documents ends in ``ids``, its end id included."""
        self.doc_ids += doc_ids
        self.doc_ends += (ends + self.held).tolist()
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            whole = np.concatenate(self.parts)
            full = len(whole) // BLOCK_IDS * BLOCK_IDS
            for low in range(0, full, BLOCK_IDS):
                yield self._made(whole[low : low + BLOCK_IDS])
            self.parts, self.held = [whole[full:].copy()], len(whole) - full

    def rest(self) -> Iterator[dict]:
        if self.held:
            yield self._made(np.concatenate(self.parts))

    def _made(self, ids: np.ndarray) -> dict:
        inside = int(np.searchsorted(np.array(self.doc_ends), len(ids), side="right"))
        row = {
            "shard": self.number, "block": self.block, "first": self.first, "n_ids": len(ids),
            "unit": self.unit, "planes": to_planes(ids, self.unit), "first_doc": self.docs,
            "doc_ids": self.doc_ids[:inside], "doc_ends": self.doc_ends[:inside],
        }
        self.block, self.first, self.docs = self.block + 1, self.first + len(ids), self.docs + inside
        self.doc_ids = self.doc_ids[inside:]
        self.doc_ends = [end - len(ids) for end in self.doc_ends[inside:]]
        return row


_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("unit", pa.string()), ("planes", pa.list_(pa.binary())), ("first_doc", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())),
])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch of ids and texts in pieces of about SLICE_BYTES, in order."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for low, high in zip(starts, starts[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def _encode(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, unit: str
) -> Iterator[pa.RecordBatch]:
    shard = _Shard(TaskContext.get().partitionId(), unit)
    for whole in batches:
        for batch in _slices(whole):
            flat, counts = encoding.encoder(path).encode(batch.column(1))
            ends = np.cumsum(counts + 1)
            ids = np.full(int(ends[-1]), end_id, dtype=np.uint32)
            inner = np.ones(len(ids), dtype=bool)
            inner[ends - 1] = False
            ids[inner] = flat
            for row in shard.add(ids, batch.column(0).to_pylist(), ends):
                yield pa.RecordBatch.from_pylist([row], schema=_ARROW)
    for row in shard.rest():
        yield pa.RecordBatch.from_pylist([row], schema=_ARROW)


def write_blocks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    unit: str = "byte",
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Encode ``docs`` and write the block table and its chunk index; both are returned as read back.

    Rows are ordered by id, equal ids by text, null ids come first; a null text is empty and yields
    its end id only. ``unit`` is "byte" or "bit". An empty table gives two empty tables.
    The index has ``shard``, ``block``, ``n_ids``, ``start`` (ids of the whole stream before the
    block), ``plane_bytes`` and ``n_docs`` (documents that end in the block).
    """
    if unit not in ("byte", "bit"):
        raise ValueError("unit must be byte or bit")
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or encoding.default_path()
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    made = ordered.mapInArrow(lambda batches: _encode(batches, path, end_id, unit), _BLOCKS)
    target = f"{folder or shared_folder(spark)}/token-blocks-{uuid.uuid4().hex}"
    # The planes are compressed already.
    made.write.option("compression", "uncompressed").parquet(f"{target}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{target}/blocks")

    # One row per shard; there are as many as the shuffle has partitions, whatever the input.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    index = blocks.join(shards, "shard").select(
        "shard",
        "block",
        "n_ids",
        (F.col("offset") + F.col("first")).alias("start"),
        F.transform("planes", F.octet_length).alias("plane_bytes"),
        F.size("doc_ids").cast("bigint").alias("n_docs"),
    )
    index.write.parquet(f"{target}/index")
    return blocks, spark.read.schema(index.schema).parquet(f"{target}/index")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "doc_no", "block", "doc_id", "closed", "at", "n_ids", "crc"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for row in batch.to_pylist():
            ids = from_planes(row["planes"], row["n_ids"], row["unit"])
            low = 0
            ends = list(zip(row["doc_ends"], row["doc_ids"]))
            for k, (high, doc_id) in enumerate([*ends, (len(ids), None)]):
                closed = k < len(ends)
                if high > low or closed:
                    crc = zlib.crc32(ids[low:high].tobytes())
                    cells = (row["shard"], row["first_doc"] + k, row["block"], doc_id, closed,
                             row["first"] + low, high - low, crc)
                    for column, cell in zip(out, cells):
                        column.append(cell)
                low = high
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def _joined_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksum of a document from those of its parts, in the order of the blocks."""
    for batch in batches:
        crcs = []
        for parts in batch.column(4).to_pylist():
            crc = parts[0]["crc"]
            for part in parts[1:]:
                # A running checksum is linear: what went before only passes as many zero bytes.
                zeros = bytes(4 * part["n_ids"])
                crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ part["crc"]
            crcs.append(crc)
        columns = [batch.column(k) for k in range(4)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(crcs, pa.int64())], names=["shard", "doc_id", "at", "n_ids", "crc"]
        )


def read_digests(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """What the files hold of each document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Blocks are decoded where they are read. Only parts of documents that cross a border between
    blocks meet again, and what is shuffled is a few numbers per document.
    """
    parts = blocks.mapInArrow(_segments, _SEGMENTS)
    met = parts.groupBy("shard", "doc_no").agg(
        F.max("doc_id").alias("doc_id"),
        F.min("at").alias("at"),
        F.sum("n_ids").alias("n_ids"),
        F.sort_array(F.collect_list(F.struct("block", "n_ids", "crc"))).alias("parts"),
    )
    met = met.select("shard", "doc_id", "at", "n_ids", "parts").mapInArrow(
        _joined_crc, "shard int, doc_id bigint, at bigint, n_ids bigint, crc bigint"
    )
    offsets = index.where("block = 0").select("shard", "start")
    return met.join(offsets, "shard").select(
        "doc_id",
        (F.col("start") + F.col("at")).alias("start"),
        F.col("n_ids").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )


def read_range(blocks: DataFrame, index: DataFrame, start: int, count: int) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of the whole stream: the index tells the few blocks to read."""
    wanted = index.where((F.col("start") < start + count) & (F.col("start") + F.col("n_ids") > start))
    near = wanted.select("shard", "block", "start")
    rows = blocks.join(near, ["shard", "block"]).select("start", "n_ids", "unit", "planes")
    out = [np.zeros(0, dtype=np.uint32)]
    for row in rows.orderBy("start").collect():
        ids = from_planes(row["planes"], row["n_ids"], row["unit"])
        out.append(ids[max(0, start - row["start"]) : start + count - row["start"]])
    return np.concatenate(out)
