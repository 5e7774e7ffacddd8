"""Removal of byte strings of a given length that occur more than once, by suffix sorting.

A suffix array over a whole corpus would move every suffix. Here only places that can repeat are
sorted, which changes no result:

1. Every string of LENGTH bytes is filed under the smallest hash among its ANCHOR byte windows, a
   choice that depends on nothing but the string. Consecutive strings of a text with the same
   anchor form a stretch, which is told by the digest of its bytes. This needs one pass.
2. Stretches whose anchor occurs once go. A stretch that occurs as a whole elsewhere repeats in
   all its strings, and needs no sorting.
3. Anchors that different stretches share, or that occur several times in one stretch, are
   decided by suffix arrays over one copy of each of their stretches, many anchors to a block.
   Blocks are sorted in two stages: suffixes smaller than their successor directly, the rest
   induced by one scan over the buckets of first bytes; then adjacent common prefixes tell which
   strings repeat.
4. An anchor with more different stretches than a block holds (the edges of a passage that
   countless texts share) is split by content first, see ``split_hot``.

Spans are merged per document, and the rest of each text is put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wordloom.llm import hashing
from wordloom.llm.shipping import ship
from wordloom.workspace import materialize

ANCHOR = 128
# Bytes handed to one suffix sort, roughly; a single anchor may exceed it up to HOT stretches.
SORT_BYTES = 1 << 18
# Different stretches of one anchor that one sort takes.
HOT = 2000
# Strings that a piece of a hot anchor's stretch has in common with its neighbours.
STEP = 32
# Stands between texts in a sort; this byte occurs in no UTF-8 text.
SEPARATOR = 0xFF


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(data: np.ndarray, length: int) -> list[tuple[int, int, int, bool]]:
    """``(anchor, first, last, several)`` of a text: starts first..last share the anchor.

    A long text is taken in overlapping pieces; a stretch cut by that is two stretches.
    """
    out = []
    step = hashing.PIECE - length
    for low in range(0, max(1, len(data) - length + 1), step):
        piece = data[low : low + step + length - 1]
        if len(piece) < length:
            break
        windows = hashing.window_hashes(piece, ANCHOR)
        span = length - ANCHOR + 1
        least = _least_of(windows, span)
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate(([0], cuts))
        last = np.concatenate((cuts, [len(least)])) - 1
        anchors = least[first]
        # Windows that are the least of some string; one hash at two such places may stand twice
        # in one string, or in two equal strings of one stretch.
        covered = ~_least_of(np.pad(~least, span - 1, constant_values=hashing.ALL_ONES), span)
        chosen = np.sort(windows[windows == covered])
        twice = np.unique(chosen[1:][chosen[1:] == chosen[:-1]])
        several = np.isin(anchors, twice) if len(twice) else np.zeros(len(anchors), dtype=bool)
        out += zip(
            anchors.view(np.int64).tolist(), (first + low).tolist(), (last + low).tolist(), several.tolist()
        )
    return out


# A row is told by its id (0 for null) and a hash that covers its text and whether the id is null;
# equal rows have equal results, so that they need not be told apart.
KEY = ["doc", "h"]
_STRETCH = "doc bigint, h bigint, anchor bigint, digest binary, first int, last int, several boolean"
_PIECE = "group bigint, doc bigint, h bigint, first int, last int, bytes binary"
_FINE = "core bigint, digest binary, doc bigint, h bigint, first int, last int, bytes binary"
_SPAN = "doc bigint, h bigint, first int, last int"
_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(column, _KINDS[kind]) for column, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[column.to_pylist() for column in batch.columns])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given, text = F.col(id_col).cast("bigint"), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(given, F.lit(0)).cast("bigint").alias("doc"),
        F.xxhash64(given.isNull(), text).alias("h"),
        given.alias("doc_id"),
        text.alias("text"),
    )


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            data, offsets = hashing.text_buffers(batch.column(2))
            docs, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for doc, h, low, high in zip(docs, hashes, offsets[:-1].tolist(), offsets[1:].tolist()):
                if high - low < length:
                    continue
                raw = data[low:high].tobytes()
                for anchor, first, last, several in stretches(data[low:high], length):
                    digest = hashlib.blake2b(raw[first : last + length], digest_size=16).digest()
                    rows.append((doc, h, anchor, digest, first, last, several))
            yield _batch(rows, _STRETCH)


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes in the order of their first ``depth`` bytes at least.

    ``starts`` says which suffixes are wanted, as a mask; of the others only the few that follow
    wanted ones are sorted. Two stages:

    * suffixes smaller than their successor (type B) are sorted directly;
    * all others (type A) follow from the place of their successor: buckets of first bytes are
      scanned upwards, and every suffix found hands its predecessor to the front part of that
      one's bucket, which cannot have been passed yet. A bucket's type A comes before its type B.
    """
    raw = data.tobytes()
    n = len(data)
    following = np.append(data[1:], 0)
    # Of equal neighbours the type is that of the next suffix; the last suffix counts as B.
    differs = np.flatnonzero(data != following)
    here = np.searchsorted(differs, np.arange(n))
    nearest = np.append(differs, n - 1)[here]
    larger = data[nearest] > following[nearest]
    larger[-1] = False
    # A wanted type A whose successor is not wanted takes what follows with it, up to a type B.
    used = starts.copy()
    ends = np.flatnonzero(used & larger & ~np.append(used[1:], False))
    stops = np.flatnonzero(~larger)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, ends, 1)
    np.add.at(change, stops[np.searchsorted(stops, ends)] + 1, -1)
    used |= np.cumsum(change[:-1]) > 0
    induced = used & larger
    direct = np.flatnonzero(used & ~larger).tolist()
    direct.sort(key=lambda i: raw[i : i + depth])
    direct = np.array(direct, dtype=np.int64)

    tail = direct[np.argsort(data[direct], kind="stable")]
    tail_at = np.searchsorted(data[tail], np.arange(257))
    head: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    none = np.zeros(0, dtype=np.int64)
    for byte in range(256):
        front = head[byte]
        newest = np.concatenate(front) if front else none
        done = [newest]
        # Runs of the same byte: predecessors within this bucket, one step at a time.
        while len(newest):
            before = newest - 1
            before = before[before >= 0]
            newest = before[induced[before] & (data[before] == byte)]
            done.append(newest)
        back = tail[tail_at[byte] : tail_at[byte + 1]]
        whole = np.concatenate([*done, back])
        if not len(whole):
            continue
        out.append(whole)
        before = whole - 1
        before = before[before >= 0]
        before = before[induced[before] & (data[before] > byte)]
        if len(before):
            firsts = data[before]
            order = np.argsort(firsts, kind="stable")
            before, firsts = before[order], firsts[order]
            cuts = np.flatnonzero(firsts[1:] != firsts[:-1]) + 1
            for part in np.split(before, cuts):
                head[int(data[part[0]])].append(part)
    return np.concatenate(out) if out else none


def repeated_starts(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Mask of the wanted starts whose first ``depth`` bytes another wanted start has too."""
    order = suffix_order(data, starts, depth)
    order = order[starts[order]]
    mask = np.zeros(len(data), dtype=bool)
    raw = data.tobytes()
    places = order.tolist()
    for i, j in zip(places, places[1:]):
        # The common prefix of neighbours reaches the depth.
        if raw[i : i + depth] == raw[j : j + depth]:
            mask[i] = mask[j] = True
    return mask


def _sort_blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of the pieces of ``_PIECE``, which come sorted by group."""
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        parts, wanted, rows = [], [], []
        for _, _, _, first, last, raw in held:
            parts += [np.frombuffer(raw, dtype=np.uint8), np.array([SEPARATOR], dtype=np.uint8)]
            mask = np.zeros(len(raw) + 1, dtype=bool)
            mask[: last - first + 1] = True
            wanted.append(mask)
        mask = repeated_starts(np.concatenate(parts), np.concatenate(wanted), length)
        at = 0
        for _, doc, h, first, last, raw in held:
            mine = np.flatnonzero(mask[at : at + last - first + 1])
            at += len(raw) + 1
            if len(mine):
                cuts = np.flatnonzero(np.diff(mine) > 1)
                lows, highs = mine[np.append(0, cuts + 1)], mine[np.append(cuts, len(mine) - 1)]
                rows += [(doc, h, first + x, first + y) for x, y in zip(lows.tolist(), highs.tolist())]
        return _batch(rows, _SPAN)

    for batch in batches:
        for item in _rows(batch):
            if held and size > SORT_BYTES and item[0] != held[-1][0]:
                yield flush()
                held, size = [], 0
            held.append(item)
            size += len(item[5])
    if held:
        yield flush()


def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted stretches of each text."""
    for batch in batches:
        rows = []
        for doc, h, text, wanted in _rows(batch):
            raw = text.encode()
            for one in wanted:
                first, last = one["first"], one["last"]
                rows.append((one["anchor"], doc, h, first, last, raw[first : last + length]))
        yield _batch(rows, _PIECE)


def _fine(batches: Iterator[pa.RecordBatch], length: int, step: int) -> Iterator[pa.RecordBatch]:
    """Pieces of up to ``step`` strings, cut at places that hang on the anchor, with two digests."""
    for batch in batches:
        rows = []
        for group, doc, h, first, last, raw in _rows(batch):
            windows = hashing.window_hashes(np.frombuffer(raw, dtype=np.uint8), ANCHOR)
            places = np.flatnonzero(windows.view(np.int64) == group)
            # Distance of a start to its string's first anchor; equal strings have equal distances.
            starts = np.arange(last - first + 1)
            lead = places[np.searchsorted(places, starts)] - starts
            cuts = np.flatnonzero((lead[1:] // step != lead[:-1] // step) | (lead[1:] > lead[:-1])) + 1
            for low, high in zip(np.append(0, cuts).tolist(), np.append(cuts, len(starts)).tolist()):
                kind = int(lead[low]) // step
                # What every string of this class of distances covers.
                left = int(lead[low]) + low - kind * step
                core = b"%d %d " % (group, kind) + raw[left : left + length - step + 1]
                whole = raw[low : high - 1 + length]
                rows.append(
                    (
                        int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "little", signed=True),
                        hashlib.blake2b(whole, digest_size=16).digest(),
                        doc, h, first + low, first + high - 1, whole,
                    )
                )
        yield _batch(rows, _FINE)


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every string of the pieces by itself, told by its digest."""
    for batch in batches:
        rows = []
        for _, doc, h, first, last, raw in _rows(batch):
            for k in range(last - first + 1):
                digest = hashlib.blake2b(raw[k : k + length], digest_size=16).digest()
                rows.append((doc, h, digest, first + k))
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "h", "digest", "first"]
        )


def split_hot(pieces: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """``(spans, pieces)``: what is decided of hot anchors' stretches, and what is left to sort.

    Equal strings lie equally far before their first anchor. Strings are therefore dealt into
    classes of STEP distances; all strings of a class contain the same core of bytes around the
    anchor, so only pieces with equal cores can have a string in common. Pieces that occur twice as
    a whole are repeated, cores that occur once are not; of the others one copy of each piece goes
    on, filed under its core.
    """
    fine = pieces.mapInArrow(lambda batches: _fine(batches, length, STEP), _FINE)
    fine = materialize(fine, "pieces")
    kinds = fine.groupBy("core", "digest").agg(
        F.count("*").alias("times"), F.min(F.struct("doc", "h", "first")).alias("one")
    )
    kinds = materialize(kinds, "piece_kinds")
    again = kinds.where("times > 1").select("core", "digest")
    spans = fine.join(again, ["core", "digest"]).select("doc", "h", "first", "last")
    shared = kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core")
    ones = kinds.join(shared, "core").select("core", "digest", "one.doc", "one.h", "one.first")
    left = fine.join(ones, ["core", "digest", "doc", "h", "first"])
    return spans, left.select(F.col("core").alias("group"), "doc", "h", "first", "last", "bytes")


def single_strings(pieces: DataFrame, length: int) -> DataFrame:
    """Spans of strings that occur twice among pieces whose core still has too many of them."""
    strings = pieces.mapInArrow(
        lambda batches: _strings(batches, length), "doc bigint, h bigint, digest binary, first int"
    )
    strings = materialize(strings, "strings")
    again = strings.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1").select("digest")
    return strings.join(again, "digest").select("doc", "h", "first", F.col("first").alias("last"))


def repeated_spans(rows: DataFrame, length: int, hot: int = HOT) -> DataFrame:
    """``doc, h, first, last``: runs of starts of strings that occur again in ``keyed`` rows."""
    ship(rows.sparkSession)
    cut = rows.select("doc", "h", "text").mapInArrow(lambda batches: _cut(batches, length), _STRETCH)
    cut = materialize(cut, "stretches")
    kinds = cut.groupBy("anchor", "digest").agg(
        F.count("*").alias("times"),
        F.bool_or("several").alias("several"),
        F.min(F.struct("doc", "h", "first", "last")).alias("one"),
    )
    kinds = materialize(kinds, "stretch_kinds")
    anchors = kinds.groupBy("anchor").agg(
        F.sum("times").alias("seen"), F.count("*").alias("kinds"), F.bool_or("several").alias("twice")
    )
    anchors = anchors.where("seen > 1 or twice")
    kinds = materialize(kinds.join(anchors, "anchor"), "repeats")

    again = kinds.where("times > 1").select("anchor", "digest")
    spans = [cut.join(again, ["anchor", "digest"]).select("doc", "h", "first", "last")]

    # One copy of every stretch of an anchor that whole digests do not settle.
    unsettled = kinds.where("kinds > 1 or twice")
    stretch = F.struct("anchor", "one.first", "one.last").alias("stretch")
    wanted = unsettled.select("one.doc", "one.h", stretch)
    wanted = wanted.groupBy("doc", "h").agg(F.collect_list("stretch").alias("wanted"))
    texts = rows.join(wanted, KEY).select("doc", "h", "text", "wanted")
    pieces = materialize(texts.mapInArrow(lambda batches: _slices(batches, length), _PIECE), "slices")

    hot_ones = unsettled.where(F.col("kinds") > hot).select(F.col("anchor").alias("group")).distinct()
    hot_ones = materialize(hot_ones, "hot_anchors")
    left = pieces
    # Where no anchor is hot, there is nothing to split.
    if not hot_ones.isEmpty():
        left = pieces.join(hot_ones, "group", "left_anti")
        more, split = split_hot(pieces.join(hot_ones, "group"), length)
        split = materialize(split, "split")
        spans.append(more)
        still = split.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > hot)
        still = materialize(still.select("group"), "hot_cores")
        left = left.unionByName(split.join(still, "group", "left_anti"))
        if not still.isEmpty():
            spans.append(single_strings(split.join(still, "group"), length))
    grouped = left.repartition("group").sortWithinPartitions("group")
    spans.append(grouped.mapInArrow(lambda batches: _sort_blocks(batches, length), _SPAN))
    out = spans[0]
    for one in spans[1:]:
        out = out.unionByName(one)
    return out


def _finish(batches: Iterator[pa.RecordBatch], length: int, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in _rows(batch):
            raw = text.encode()
            merged: list[list[int]] = []
            for one in sorted((one["first"], one["last"] + length) for one in spans or ()):
                if merged and one[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], one[1])
                else:
                    merged.append(list(one))
            kept, at = [], 0
            for low, high in merged:
                kept.append(raw[at:low])
                at = high
            kept = b"".join([*kept, raw[at:]])
            numbers = (doc_id, len(raw), len(raw) - len(kept), len(merged))
            rows.append((*numbers, hashlib.sha256(kept).hexdigest()) if digest else (*numbers, merged, kept))
        columns = list(zip(*rows)) if rows else [()] * (5 if digest else 6)
        kinds = [pa.int64()] * 4
        kinds += [pa.string()] if digest else [pa.list_(pa.list_(pa.int64())), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans"]
        names += ["kept_sha256"] if digest else ["spans", "kept"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 400,
    digest: bool = False,
    hot: int = HOT,
) -> DataFrame:
    """Each text without the bytes that a repeated string of ``length`` bytes covers.

    A byte goes if it lies in a string of ``length`` UTF-8 bytes that also starts anywhere else: in
    another row or elsewhere in the same one, overlaps included. Strings never cross rows and are
    judged on the input. Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs), then ``spans`` (byte ranges, end exclusive) and ``kept`` (the other bytes, which
    may start or end inside a character), or with ``digest`` only ``kept_sha256``.

    Null texts are empty; texts shorter than ``length`` are left whole. Rows that repeat an id are
    separate texts, equal rows remove each other's bytes; null ids stay null. Other columns are not
    looked at. An empty table gives an empty one. ``length`` must be at least 2 * ANCHOR.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    rows = keyed(docs, id_col, text_col)
    spans = repeated_spans(rows, length, hot).groupBy(*KEY)
    spans = spans.agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = rows.join(spans, KEY, "left").select("doc_id", "text", "spans")
    more = "kept_sha256 string" if digest else "spans array<array<bigint>>, kept binary"
    schema = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {more}"
    return joined.mapInArrow(lambda batches: _finish(batches, length, digest), schema)
