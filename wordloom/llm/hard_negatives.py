"""Hard negatives for each anchor and positive of a table of vectors.

The scores of an anchor's rows arrive in falling order: pairs are packed into keys of (anchor,
descending score, id), dealt out by anchor and sorted inside the partitions. An iterator runs down
each anchor's pairs once. A positive opens a window of scores below its own, and negatives fill the
windows that are open; it holds a few windows and no rows.

Pairs are made in blocks. Vectors lie in pieces of up to PIECE rows; each piece meets the anchors in
groups of up to GROUP, which stream past it. Not all pairs are shuffled: a piece first tells its best
rows under each anchor's label, which settles the positives and with them the windows. In a second
round it sends, for each window, as many of its best rows as the window can take.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.llm.shipping import ship
from wordloom.workspace import materialize

PIECE, GROUP = 4096, 256
# Cells of a piece; wide vectors make pieces of fewer rows.
PIECE_CELLS = 1 << 20
# Pieces of a lane, on the average: a task holds a lane's pieces while the anchors stream past.
LANE_PIECES = 2
# Components beyond this count as this, so that no inner product leaves 64 bits.
LIMIT = 1 << 24
# Scores are below this in size (LIMIT squared times 2**14 components).
TOP = 1 << 62

_PACKED = pa.schema([
    ("n", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("anchors", pa.binary()), ("unit", pa.string()), ("cells", pa.binary()),
])
_GROUPS = pa.schema([
    ("n", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("pieces", pa.binary()), ("places", pa.binary()), ("unit", pa.string()), ("cells", pa.binary()),
])
_BEST = pa.schema([("grp", pa.int64()), ("at", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
_KEYS = pa.schema([("key", pa.binary())])
# Anchor (its group, place and id), falling score, positives before negatives, id.
_KEY = np.dtype([("grp", ">u8"), ("at", ">u2"), ("anchor", ">u8"), ("low", ">u8"), ("kind", "u1"), ("id", ">u8")])
_UNPACK = struct.Struct(">QHQQBQ")
_ANCHOR_BYTES = 10
_SIGN = 1 << 63


def _bytes(cells: np.ndarray) -> tuple[str, bytes]:
    small = not cells.size or int(np.abs(cells).max()) < 1 << 15
    return ("<i2", cells.astype("<i2").tobytes()) if small else ("<i4", cells.astype("<i4").tobytes())


def _cells(row: dict) -> np.ndarray:
    return np.frombuffer(row["cells"], dtype=row["unit"]).reshape(row["n"], row["width"]).astype(np.float64)


def _cuts(lengths: np.ndarray, rows: int) -> list[int]:
    """Borders of pieces whose rows, padded to the widest one, stay within the limits."""
    borders, start, width = [0], 0, 1
    for i, length in enumerate(lengths.tolist()):
        width = max(width, length)
        if i > start and (i - start >= rows or (i - start + 1) * width > PIECE_CELLS):
            borders.append(i)
            start, width = i, max(length, 1)
    return [*borders, len(lengths)] if len(lengths) else borders


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows ``id, label, anchor, vector`` to pieces, ordered by id inside each; short vectors get zeros."""
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy() for i in (0, 1))
        anchors = batch.column(2).to_numpy(zero_copy_only=False)
        vectors = batch.column(3)
        offsets = vectors.offsets.to_numpy()
        values, lengths = vectors.values.to_numpy(), np.diff(offsets)
        borders = _cuts(lengths, rows)
        for low, high in zip(borders, borders[1:]):
            order = low + np.argsort(ids[low:high], kind="stable")
            width = int(lengths[low:high].max(initial=0))
            cells = np.zeros((high - low, width), dtype=np.int32)
            row, column = np.repeat(np.arange(high - low), lengths[order]), np.arange(lengths[order].sum())
            column -= np.repeat(np.cumsum(lengths[order]) - lengths[order], lengths[order])
            cells[row, column] = values[np.repeat(offsets[order], lengths[order]) + column]
            unit, data = _bytes(cells)
            made = {
                "n": high - low, "width": width, "ids": ids[order].astype("<i8").tobytes(),
                "labels": labels[order].astype("<i8").tobytes(), "anchors": anchors[order].tobytes(),
                "unit": unit, "cells": data,
            }
            yield pa.RecordBatch.from_pylist([made], schema=_PACKED)


def _pick(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """The anchors of pieces, in groups, with the piece and place each comes from."""
    held: list[tuple] = []

    def made(rows: list[tuple]) -> pa.RecordBatch:
        width = max(len(row[4]) for row in rows)
        cells = np.zeros((len(rows), width), dtype=np.int32)
        for i, row in enumerate(rows):
            cells[i, : len(row[4])] = row[4]
        unit, data = _bytes(cells)
        columns = [np.array(x, dtype="<i8").tobytes() for x in zip(*[row[:4] for row in rows])]
        named = dict(zip(("ids", "labels", "pieces", "places"), columns))
        return pa.RecordBatch.from_pylist([{"n": len(rows), "width": width, "unit": unit, "cells": data} | named], schema=_GROUPS)

    wide = 1
    for batch in batches:
        for row in batch.to_pylist():
            places = np.flatnonzero(np.frombuffer(row["anchors"], dtype=bool))
            if not len(places):
                continue
            ids, labels, cells = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), _cells(row)
            for at in places.tolist():
                wide = max(wide, row["width"])
                if held and (len(held) >= group or (len(held) + 1) * wide > PIECE_CELLS):
                    yield made(held)
                    held, wide = [], max(row["width"], 1)
                held.append((int(ids[at]), int(labels[at]), row["piece"], at, cells[at].astype(np.int32)))
    if held:
        yield made(held)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows; the shorter side counts as padded with zeros."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width
    if bound < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at`` (ascending) the k of the greatest scores, ties by place."""
    if len(at) <= k:
        return at
    found = scores[at]
    cut = np.partition(found, len(found) - k)[len(found) - k]
    above = at[found > cut]
    return np.concatenate([above, at[found == cut][: k - len(above)]])


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _meet(batches: Iterator[pa.RecordBatch], handle: Callable) -> Iterator[pa.RecordBatch]:
    """Hold the pieces of a lane and hand each group of anchors to ``handle`` with them."""
    lane, pieces = None, []
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if row["lane"] != lane:
                lane, pieces = row["lane"], []
            labels, ids = np.frombuffer(row["labels"], "<i8"), np.frombuffer(row["ids"], "<i8")
            if row["kind"] == 0:
                pieces.append((row["number"], ids, labels, _cells(row)))
            else:
                yield from handle(row, ids, labels, pieces)


def _near(k: int) -> Callable:
    """For each anchor the k best rows of its label in each piece, itself left out."""

    def handle(row, ids, labels, pieces):
        anchors = _cells(row)
        own, place = np.frombuffer(row["pieces"], "<i8"), np.frombuffer(row["places"], "<i8")
        for number, piece_ids, piece_labels, cells in pieces:
            scores = products(anchors, cells)
            out: list[list] = [[], [], []]
            for i in range(row["n"]):
                same = piece_labels == labels[i]
                if own[i] == number:
                    same[place[i]] = False
                at = best(scores[i], np.flatnonzero(same), k)
                out[0].append(np.full(len(at), i))
                out[1].append(scores[i][at])
                out[2].append(piece_ids[at])
            columns = [np.concatenate(x) for x in out]
            group = np.full(len(columns[0]), row["number"])
            arrays = [pa.array(x, type=t) for x, t in zip([group, *columns], _BEST.types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_BEST)

    return handle


def _windowed(k: int, low: int, high: int) -> Callable:
    """Keys of the positives (told by lane 0) and of all rows that can fill a window."""

    def keys(row, anchors, at, scores, kind, ids):
        out = np.empty(len(at), dtype=_KEY)
        out["grp"], out["at"], out["kind"] = row["number"], at, kind
        out["anchor"], out["id"] = (np.asarray(x, dtype=np.int64).view(np.uint64) ^ np.uint64(_SIGN) for x in (anchors, ids))
        out["low"] = (TOP - np.asarray(scores, dtype=np.int64)).astype(np.uint64)
        offsets = np.arange(len(at) + 1, dtype=np.int32) * _KEY.itemsize
        column = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())])
        return pa.RecordBatch.from_arrays([column], schema=_KEYS)

    def handle(row, ids, labels, pieces):
        positives = row["positives"] or []
        opened: dict[int, set] = {}
        for x in positives:
            opened.setdefault(x["at"], set()).add(bounds(x["score"], low, high))
        if row["lane"] == 0 and positives:
            at, scores, found = (np.array([x[name] for x in positives], dtype=np.int64) for name in ("at", "score", "id"))
            yield keys(row, ids[at], at, scores, 0, found)
        chosen = np.array(sorted(opened), dtype=np.int64)
        if not len(chosen):
            return
        anchors = _cells(row)[chosen]
        for _, piece_ids, piece_labels, cells in pieces:
            scores = products(anchors, cells)
            out: list[list] = [[], [], [], []]
            for i, at in enumerate(chosen.tolist()):
                least, most = min(x[0] for x in opened[at]), max(x[1] for x in opened[at])
                inside = (scores[i] >= least) & (scores[i] <= most) & (piece_labels != labels[at])
                places = np.flatnonzero(inside)
                if not len(places):
                    continue
                places = places[np.argsort(-scores[i][places], kind="stable")]
                falling = -scores[i][places]
                taken = np.zeros(len(places), dtype=bool)
                for least, most in opened[at]:
                    first = int(np.searchsorted(falling, -most, side="left"))
                    last = int(np.searchsorted(falling, -least, side="right"))
                    taken[first : min(last, first + k)] = True
                places = places[taken]
                for part, values in zip(out, (np.full(len(places), ids[at]), np.full(len(places), at), scores[i][places], piece_ids[places])):
                    part.append(values)
            if out[0]:
                anchor, at, score, found = (np.concatenate(x) for x in out)
                yield keys(row, anchor, at, score, 1, found)

    return handle


def anchor_partition(key: bytes) -> int:
    """All keys of an anchor go to one partition."""
    return zlib.crc32(key[:_ANCHOR_BYTES])


def fill_windows(keys: Iterator[tuple[bytes, None]], k: int, low: int, high: int) -> Iterator[tuple]:
    """Run down sorted keys; every window takes the first k negatives that fall into it."""
    anchor, opened = None, []
    for key, _ in keys:
        group, at, anchor_id, flipped, kind, item = _UNPACK.unpack(key)
        if (group, at) != anchor:
            anchor, opened = (group, at), []
        score, item = TOP - flipped, item - _SIGN
        if kind == 0:
            least, most = bounds(score, low, high)
            if least <= most:
                opened.append([least, most, item, score, 0])
            continue
        full = False
        for window in opened:
            if window[0] <= score <= window[1]:
                window[4] += 1
                full = full or window[4] == k
                yield anchor_id - _SIGN, window[2], window[4], item, window[3], score
        if full:
            opened = [window for window in opened if window[4] < k]


def _lanes(pieces: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Pieces, each in one lane, and groups in every lane, sorted so that a lane's pieces come first."""
    own = pieces.select(
        F.pmod(F.xxhash64("piece"), F.lit(n)).cast("int").alias("lane"), F.lit(0).alias("kind"), F.col("piece").alias("number"),
        "n", "width", "ids", "labels", "unit", "cells",
    )
    every = groups.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("kind", F.lit(1))
    both = own.unionByName(every.withColumnRenamed("grp", "number"), allowMissingColumns=True)
    return both.repartition(n, "lane").sortWithinPartitions("lane", "kind")


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | Column = "label",
    scale: float = 256.0,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` tells which rows are anchors. Each component x counts as floor(scale * x); the score
    of two rows is the inner product of these integers. Of each anchor the ``n_positives`` other rows
    of its label with the highest scores (ties by id) are positives, or all if there are fewer. Each
    positive gets the first ``n_negatives`` rows of other labels, or all if fewer, whose score s
    satisfies low * p <= 100 * s <= high * p for the positive's score p, in the same order.

    Ids and labels are whole numbers. Rows with a null id, label, vector or component, or a component
    that is not finite, take no part; a null answer of ``anchors`` means no. Vectors of different
    length count as padded with zeros, and empty ones score 0. Integers beyond LIMIT count as LIMIT.
    Repeated rows are rows of their own: each can be a positive or a negative, and as anchors each
    gets its negatives. A positive with a negative score has an empty window. Other columns are not
    looked at. An empty table, or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    ints = lambda x: F.greatest(F.least(F.floor(x * F.lit(float(scale))), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    wide = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    usable = wide.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    rows = usable.select("id", "label", "anchor", F.transform("vector", ints).alias("vector"))
    schema = "n int, width int, ids binary, labels binary, anchors binary, unit string, cells binary"
    piece, group = PIECE, GROUP
    pieces = rows.mapInArrow(lambda batches: _pack(batches, piece), schema).withColumn("piece", F.monotonically_increasing_id())
    pieces = materialize(pieces, "vector_pieces")
    schema = "n int, width int, ids binary, labels binary, pieces binary, places binary, unit string, cells binary"
    groups = pieces.mapInArrow(lambda batches: _pick(batches, group), schema).withColumn("grp", F.monotonically_increasing_id())
    groups = materialize(groups, "anchor_groups")
    lanes = -(-max(pieces.count(), 1) // LANE_PIECES)

    near, k = _near(n_positives), n_negatives
    found = _lanes(pieces, groups, lanes).mapInArrow(
        lambda batches: _meet(batches, near), "grp bigint, at int, score bigint, id bigint"
    )
    first = Window.partitionBy("grp", "at").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n_positives)
    positives = found.groupBy("grp").agg(F.collect_list(F.struct("at", "score", "id")).alias("positives"))
    opened = materialize(groups.join(positives, "grp"), "anchor_windows")

    windowed = _windowed(k, low, high)
    keys = _lanes(pieces, opened, lanes).mapInArrow(lambda batches: _meet(batches, windowed), "key binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = keys.rdd.map(lambda row: (bytes(row[0]), None))
    ordered = pairs.repartitionAndSortWithinPartitions(parts, anchor_partition)
    schema = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    return spark.createDataFrame(ordered.mapPartitions(lambda part: fill_windows(part, k, low, high)), schema)
