"""Near-duplicate groups by b-bit MinHash: bands propose, packed bits estimate, full sets decide.

1. One pass over the texts makes, per document, the size and digest of its shingle set, the
   low bits of its minima packed into longs, and one key per band of minima.
2. Documents with equal sets form one class, so copies cost one row from here on.
3. In every band bucket each class is paired with one class of it only, its hub. Pairs whose
   packed bits make the wanted similarity implausible go; the others are decided on full sets.
4. Buckets that still hold several components have those compared inside tasks, again by packed
   bits, which finds links that the star of step 3 cannot show. A class with a plausible partner
   in another component visits that component: it is compared with the full sets of all members
   at once and yields one link at most, for the members are joined already. The first round visits
   the greatest component of each bucket only, which settles nearly all of them; the second visits
   every component.

Large buckets and components are dealt out in blocks. No pair of equal sets is ever made, the
pairs of a group are never all written out, and no group is collected whole unless it fits a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm import hashing
from wordloom.llm.components import connected_components, joined_components
from wordloom.llm.shipping import ship
from wordloom.workspace import materialize

# 32 bands of 4 minima: a pair at similarity 0.8 shares no band with a chance below 1e-7.
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
BITS = 4
LONGS = MINIMA * BITS // 64
# Bands are dealt into this many kinds; those of a kind choose their hubs in the same order, so that
# a class meets about this many hubs, and an odd one of them does not leave a group apart.
HUBS = 4
# An estimate over 128 minima strays by 0.037 at most (one standard deviation); five of them.
ESTIMATE_MARGIN = 0.185
# Classes of one bucket compared within one task; larger buckets are dealt out in block pairs.
BLOCK = 4096
# Shingles of a component, and of its visitors, held by one task at a time.
BLOCK_SHINGLES = 1 << 20

_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(
    0, 1 << 32, MINIMA, dtype=np.uint32
) | np.uint32(1)
_PLACES = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                                  0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(data, offsets, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty none."""
    words, where = hashing.word_hashes(data, offsets)
    count = len(words) - width + 1
    if count > 0:
        grams = np.zeros(count, dtype=np.uint64)
        for k in range(width):
            grams += hashing.mix(words[k : k + count] * _PLACES[k % 5] + np.uint64(k + 1))
        grams = hashing.mix(grams)
    out = []
    for low, high in zip(where[:-1].tolist(), where[1:].tolist()):
        if high - low >= width:
            out.append(np.unique(grams[low : high - width + 1]))
        elif high > low:
            digest = hashlib.blake2b(words[low:high].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(digest, dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """MINIMA x len(sets) minima of non-empty sets."""
    out = np.full((MINIMA, len(sets)), np.uint32(0xFFFFFFFF))
    first, run = 0, 0
    for i, one in enumerate(sets):
        run += len(one)
        if run >= 4096 or i + 1 == len(sets):
            group = sets[first : i + 1]
            borders = np.cumsum([0] + [len(x) for x in group[:-1]])
            values = (np.concatenate(group) >> np.uint64(32)).astype(np.uint32)
            # A long set is taken in parts, so that the product stays small.
            if len(group) == 1:
                for part in range(0, len(values), 8192):
                    low = (_FACTORS[:, None] * values[None, part : part + 8192]).min(axis=1)
                    np.minimum(out[:, i], low, out=out[:, i])
            else:
                product = _FACTORS[:, None] * values[None, :]
                out[:, first : i + 1] = np.minimum.reduceat(product, borders, axis=1)
            first, run = i + 1, 0
    return out


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            sets = shingle_sets(*hashing.text_buffers(batch.column(1)), width)
            full = [i for i, one in enumerate(sets) if len(one)]
            low = minima([sets[i] for i in full])
            mixed = hashing.mix(low.astype(np.uint64) + np.uint64(1))
            packed = np.zeros((len(full), LONGS), dtype=np.uint64)
            for k in range(MINIMA):
                bits = mixed[k] & np.uint64((1 << BITS) - 1)
                packed[:, k * BITS // 64] |= bits << np.uint64(k * BITS % 64)
            bands = np.zeros((len(full), BANDS), dtype=np.uint64)
            for band in range(BANDS):
                key = np.full(len(full), band + 1, dtype=np.uint64)
                for row in range(ROWS):
                    key = hashing.mix(key * _PLACES[row] + low[band * ROWS + row])
                bands[:, band] = key
            at = {i: k for k, i in enumerate(full)}

            def lists(rows: np.ndarray) -> pa.Array:
                signed = rows.view(np.int64)
                return pa.array(
                    [signed[at[i]] if i in at else None for i in range(len(sets))],
                    pa.list_(pa.int64()),
                )

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array([set_key(one) for one in sets], pa.binary()),
                    lists(packed),
                    lists(bands),
                ],
                names=["id", "n_shingles", "node", "bits", "bands"],
            )


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id``, ``n_shingles``, ``node`` (digest of the set), ``bits``, ``bands`` of each row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        lambda batches: _sketch(batches, width),
        "id bigint, n_shingles bigint, node binary, bits array<bigint>, bands array<bigint>",
    )


def estimate(left: str, right: str) -> Column:
    """Similarity by counting equal low-bit groups, less what equal bits by chance add."""
    ones = int("1" * 16, 16)
    total = F.lit(0)
    for k in range(LONGS):
        odd = F.get(left, F.lit(k)).bitwiseXOR(F.get(right, F.lit(k)))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 1))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 2)).bitwiseAND(F.lit(ones))
        total = total + F.bit_count(odd)
    chance = 1.0 / (1 << BITS)
    return (1.0 - total / F.lit(float(MINIMA)) - chance) / (1.0 - chance)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            sets = shingle_sets(*hashing.text_buffers(batch.column(1)), width)
            same = [i for i, want in enumerate(batch.column(0).to_pylist()) if set_key(sets[i]) == want]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(same, pa.int64())),
                    pa.array([sets[i].tobytes() for i in same], pa.binary()),
                ],
                names=["node", "members"],
            )


def _own_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Full sets of texts, with the digests that their sketches have."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            sets = shingle_sets(*hashing.text_buffers(whole.slice(start, 1024).column(0)), width)
            sets = [one for one in sets if len(one)]
            columns = [pa.array([make(one) for one in sets], pa.binary()) for make in (set_key, np.ndarray.tobytes)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "members"])


def _decide(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        left, right = batch.column(2), batch.column(3)
        for i in range(batch.num_rows):
            a = np.frombuffer(left[i].as_buffer(), dtype=np.uint64)
            b = np.frombuffer(right[i].as_buffer(), dtype=np.uint64)
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                continue
            common = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * common >= percent * (len(a) + len(b) - common):
                keep.append(i)
        taken = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken)], names=["a", "b"]
        )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(lambda batches: _decide(batches, percent), "a binary, b binary")


def _plausible(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the plausible pairs of two blocks of unpacked minima."""
    chance = 1.0 / (1 << BITS)
    most_odd = (1.0 - (least * (1.0 - chance) + chance)) * MINIMA
    rows, cols = [], []
    for i in range(len(a)):
        near = np.flatnonzero((b != a[i]).sum(axis=1, dtype=np.int32) <= most_odd)
        rows.append(np.full(len(near), i))
        cols.append(near)
    return np.concatenate(rows), np.concatenate(cols)


def _cross(batch: pa.Table, least: float, greatest_only: bool) -> pa.Table:
    """Visits between the components of one bucket, or of two of its blocks.

    A node of the component with fewer classes visits the other one if their packed bits allow a
    link to any of its nodes in the bucket; equal sizes are told apart by the root. With
    ``greatest_only`` only the greatest component at hand is visited. Else a pair of nodes counts in
    the bucket of the first band that they share, and not again in all others.
    """
    nodes, roots = batch.column("node").to_pylist(), batch.column("root").to_pylist()
    blocks = np.array(batch.column("block").to_pylist())
    longs = np.array(batch.column("bits").to_pylist(), dtype=np.int64).view(np.uint64)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    cells = ((longs[:, :, None] >> shifts) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    cells = cells.reshape(len(nodes), MINIMA)
    ranks = sorted(set(zip(batch.column("size").to_pylist(), roots)))
    number = {root: k for k, (_, root) in enumerate(ranks)}
    comp = np.array([number[root] for root in roots])
    if greatest_only:
        left, right = np.flatnonzero(comp != comp.max()), np.flatnonzero(comp == comp.max())
    elif len(set(blocks.tolist())) > 1:
        left, right = np.flatnonzero(blocks == blocks.min()), np.flatnonzero(blocks != blocks.min())
    else:
        # All against all, but rows of the greatest component need no partner inside it.
        left, right = np.flatnonzero(comp != comp.max()), np.arange(len(nodes))
    found = set()
    if len(left) and len(right):
        i, j = _plausible(cells[left], cells[right], least)
        i, j = left[i], right[j]
        if not greatest_only:
            bands = np.array(batch.column("bands").to_pylist(), dtype=np.int64)
            first = (bands[i] == bands[j]).argmax(axis=1)
            here = bands[i, first] == batch.column("key")[0].as_py()
            i, j = i[here], j[here]
        for x, y in ((i, j), (j, i)):
            up = comp[x] < (np.where(comp[y] == comp.max(), comp[y], -1) if greatest_only else comp[y])
            found.update(np.unique(x[up] * len(ranks) + comp[y[up]]).tolist())
    visits = [(nodes[x // len(ranks)], ranks[x % len(ranks)][1]) for x in found]
    node, root = zip(*visits) if visits else ((), ())
    return pa.table({"node": pa.array(node, pa.binary()), "root": pa.array(root, pa.binary())})


def visits(open_rows: DataFrame, least: float, greatest_only: bool) -> DataFrame:
    """Which node visits which component, from buckets ``key, n, node, root, size, bits, bands``.

    A bucket within BLOCK rows is one task's group. A larger one is dealt into b blocks, and every
    pair of blocks is a group of its own, so its work is spread over b * (b + 1) / 2 groups.
    """
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = open_rows.withColumn("blocks", blocks).withColumn("block", own)
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", partner)
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn(
        "high", F.greatest("block", "other")
    )
    return (
        dealt.select("key", "low", "high", "block", "node", "root", "size", "bits", "bands")
        .groupBy("key", "low", "high")
        .applyInArrow(lambda table: _cross(table, least, greatest_only), "node binary, root binary")
        .distinct()
    )


def _receive(batch: pa.Table, percent: int) -> pa.Table:
    """One link of each visitor to a member of the block that it is similar enough to, if any."""
    visiting = np.array(batch.column("visiting").to_pylist(), dtype=bool)
    nodes, sets = batch.column("node").to_pylist(), batch.column("members").to_pylist()
    sets = [np.frombuffer(one, dtype=np.uint64) for one in sets]
    home = np.flatnonzero(~visiting)
    found = []
    if len(home) and visiting.any():
        sizes = np.array([len(sets[i]) for i in home])
        shingles = np.concatenate([sets[i] for i in home])
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], np.repeat(np.arange(len(home)), sizes)[order]
        for x in np.flatnonzero(visiting).tolist():
            low = np.searchsorted(shingles, sets[x], side="left")
            hits = np.searchsorted(shingles, sets[x], side="right") - low
            ends = np.cumsum(hits)
            at = np.repeat(low - ends + hits, hits) + np.arange(int(ends[-1]))
            common = np.bincount(owner[at], minlength=len(home))
            near = np.flatnonzero(100 * common >= percent * (sizes + len(sets[x]) - common))
            if len(near):
                found.append((nodes[x], nodes[home[near[0]]]))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def visit_links(visited: DataFrame, rooted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that the visits ``node, root`` find among the members of the components.

    Members of a component are dealt into blocks and its visitors into slices by the number of
    their shingles; every slice meets every block.
    """
    sized = sets.withColumn("weight", F.octet_length("members") / 8)
    home = rooted.select("node", "root").join(visited.select("root").distinct(), "root")
    home, guests = home.join(sized, "node"), visited.join(sized, "node")

    def shares(rows: DataFrame, name: str) -> DataFrame:
        count = F.ceil(F.sum("weight") / F.lit(BLOCK_SHINGLES)).cast("int")
        return rows.groupBy("root").agg(count.alias(name))

    dealt = materialize(shares(home, "blocks").join(shares(guests, "slices"), "root"), "dealt")

    def spread(rows: DataFrame, own: str, other: str, visiting: bool) -> DataFrame:
        rows = rows.join(dealt, "root")
        number = {
            own: F.pmod(F.xxhash64("node"), F.col(own)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.col(other) - 1)),
        }
        return rows.select(
            "root",
            number["blocks"].alias("block"),
            number["slices"].alias("slice"),
            F.lit(visiting).alias("visiting"),
            "node",
            "members",
        )

    met = spread(home, "blocks", "slices", False).unionByName(spread(guests, "slices", "blocks", True))
    return met.groupBy("root", "block", "slice").applyInArrow(
        lambda table: _receive(table, percent), "a binary, b binary"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Near-duplicate component of every row.

    Two rows are linked if ``100 * intersection >= percent * union`` of their sets of distinct
    ``width``-word shingles; A-Z count as a-z, words are what the six ASCII white-space bytes
    separate. Returns one row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (the
    smallest id linked directly or through others) and ``kept`` (``doc_id = component_id``).

    Null and empty texts have an empty set, are linked with nothing and kept. A text with fewer
    words is one shingle. Rows that repeat an id are each judged by their own text; if it is the
    smallest of its component all of them are kept. A row with a null id never names a component;
    where no id is left the component is null, and such a row is kept only if its set is empty.
    Other columns are not looked at. An empty table gives an empty one.
    """
    made = materialize(sketches(docs, id_col, text_col, width), "sketches")
    nodes = made.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("id").alias("first_id"), F.first("bits").alias("bits"), F.first("bands").alias("bands")
    )
    nodes = materialize(nodes, "classes")

    # Buckets with several classes, each with one of them as the hub of a star.
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    place = F.struct(F.xxhash64("node", F.col("band") % HUBS), "node")
    buckets = banded.groupBy("key").agg(F.min(place)["node"].alias("hub"), F.count("*").alias("n"))
    banded = banded.drop("band")
    members = banded.join(buckets.where("n > 1"), "key")
    members = materialize(members, "buckets")

    least = percent / 100.0 - ESTIMATE_MARGIN
    bits = nodes.select("node", "bits")
    star = members.where(F.col("node") != F.col("hub")).select("node", "hub").distinct()
    star = star.join(bits, "node").join(
        bits.select(F.col("node").alias("hub"), F.col("bits").alias("hub_bits")), "hub"
    )
    star = star.where(estimate("bits", "hub_bits") >= F.lit(least))
    star = materialize(star.select(F.col("node").alias("a"), F.col("hub").alias("b")), "stars")

    # Full sets of the classes that a plausible pair can still name, made once from the texts.
    needed = members.select("node").distinct().join(nodes.select("node", "first_id"), "node")
    texts = docs.select(F.col(id_col).cast("bigint").alias("first_id"), F.col(text_col).alias("text"))
    sets = texts.join(needed, "first_id").select("node", "text")
    sets = sets.mapInArrow(lambda batches: _sets(batches, width), "node binary, members binary")
    # Classes without an id are found by their digest, among the texts without an id.
    unnamed = docs.where(F.col(id_col).cast("bigint").isNull()).select(F.col(text_col).alias("text"))
    unnamed = unnamed.mapInArrow(lambda batches: _own_sets(batches, width), "node binary, members binary")
    sets = sets.unionByName(unnamed.join(needed.where(F.col("first_id").isNull()).select("node"), "node", "left_semi"))
    sets = materialize(sets.dropDuplicates(["node"]), "sets")

    links = materialize(confirmed(star, sets, percent), "confirmed")
    roots = materialize(connected_components(links), "roots")

    # What the stars left apart within a bucket.
    for greatest_only in (True, False):
        apart = needed.select("node").join(roots, "node", "left")
        apart = apart.withColumn("root", F.coalesce("root", "node"))
        sizes = apart.groupBy("root").agg(F.count("*").alias("size"))
        apart = materialize(apart.join(sizes, "root").select("node", "root", "size"), "apart")
        rooted = members.join(apart, "node")
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        mixed = mixed.where("low <> high").select("key")
        open_rows = rooted.join(mixed, "key").join(nodes.select("node", "bits", "bands"), "node")
        visited = materialize(visits(open_rows, least, greatest_only), "visits")
        found = materialize(visit_links(visited, apart, sets, percent), "confirmed")
        if not found.isEmpty():
            roots = materialize(joined_components(roots, found), "roots")

    # A component's id is the smallest document id of its classes.
    labelled = nodes.select("node", "first_id").join(roots, "node", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "node"))
    names = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = labelled.join(names, "root").select("node", "component_id")
    named = made.select("id", "n_shingles", "node").join(labelled, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    named = named.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), "node")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("node").isNull())
    return named.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with one document left of each component.

    The smallest id stays. Rows that repeat a kept id stay once for each different text; rows with
    a null id cannot be told apart and stay, as do all rows without words. Other columns may have any
    names. An empty table gives an empty one.
    """
    judged = materialize(near_duplicates(docs, id_col, text_col, width, percent), "judged")
    known = judged.where("doc_id is not null")
    # An id goes if none of its rows is kept: a repeated id may stand for different texts.
    ids = known.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    gone = ids.where("not kept").select(F.col("doc_id").alias("__gone"))
    key = docs[id_col].cast("bigint")
    left = docs.join(gone, key == gone["__gone"], "left_anti")
    repeated = materialize(ids.where("kept and n > 1").select(F.col("doc_id").alias("__twice")), "repeated_ids")
    if repeated.isEmpty():
        return left
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = left[id_col].cast("bigint") == repeated["__twice"]
    own = next(name for name in ("__hash" + "_" * i for i in range(99)) if name not in docs.columns)
    once = left.join(repeated, same, "left_semi").withColumn(own, text_hash)
    once = once.dropDuplicates([id_col, own]).drop(own)
    return left.join(repeated, same, "left_anti").unionByName(once)
