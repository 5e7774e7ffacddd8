"""How the sources of each language differ in the words they use.

Terms are counted by an Arrow pipeline inside the tasks: lower case, a split at everything that is
no letter, dictionary codes, and two hash aggregations, by document and by source. What leaves a task
are partial counts, which merge by language, source and term. The merged counts are dealt to shards
of a language's terms. A shard is a dense column block (sources by terms); it adds up its part of the
divergence of every pair of sources and keeps its best terms of each source.

Sources of a language are taken in blocks of up to BLOCK, and a shard is made for each two blocks, so
that no shard grows with the number of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm.shipping import ship
from wordloom.workspace import materialize

# What separates terms: all of ASCII but letters, once A-Z are a-z.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
TERM_RANKS = 200
SCALE = 10**9
# Bytes of text split at once, rows of partial counts held by a task, terms of a shard, sources of a block.
PIECE_BYTES, HELD, SHARD_TERMS, BLOCK = 4 << 20, 500_000, 2048, 256

_COUNTS = pa.schema([("code", pa.int64()), ("term", pa.large_string()), ("n", pa.int64()), ("docs", pa.int64())])
_PARTS = pa.schema([
    ("lang", pa.string()), ("source", pa.int32()), ("other", pa.int32()), ("term", pa.string()),
    ("value", pa.int64()), ("seen", pa.int64()),
])


def batch_counts(codes: np.ndarray, texts: pa.Array) -> pa.Table:
    """Partial counts of a few texts: ``code, term, n, docs``; ``codes`` tell their sources."""
    # A slice is copied first: Arrow's string functions misread the buffers of some slices.
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    split = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    offsets = split.offsets.to_numpy()
    terms = split.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    names = terms.dictionary
    each = pa.table({"doc": doc, "term": terms.indices})
    empty = pc.index(names, pa.scalar("", pa.large_string())).as_py()
    if empty >= 0:
        each = each.filter(pc.not_equal(each["term"], empty))
    by_doc = each.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    by_doc = pa.table({"code": codes[by_doc["doc"].to_numpy()], "term": by_doc["term"], "n": by_doc["count_all"]})
    counted = by_doc.group_by(["code", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    found = names.take(pa.array(counted["term"].to_numpy()))
    return pa.table([counted["code"], found, counted["n_sum"], counted["n_count"]], schema=_COUNTS)


def merged(parts: list[pa.Table]) -> pa.Table:
    if len(parts) == 1:
        return parts[0]
    added = pa.concat_tables(parts).group_by(["code", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return added.select(["code", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTS.names).cast(_COUNTS)


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of up to ``most`` bytes of text, or of one text."""
    upto = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = int(upto[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _count(batches: Iterator[pa.RecordBatch], piece_bytes: int, most: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    size = 0
    for whole in batches:
        for batch in pieces(whole, piece_bytes):
            part = batch_counts(batch.column(0).to_numpy(), batch.column(1))
            held.append(part)
            size += part.num_rows
            if size > most:
                held = [merged(held)]
                size = held[0].num_rows
                # Mostly different terms: merging them here no longer pays.
                if size > most // 2:
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held, size = [], 0
    if held:
        yield from merged(held).to_batches(max_chunksize=50_000)


def source_codes(names: DataFrame) -> DataFrame:
    """``lang, name, code, source`` of every (lang, name): a 64-bit code for all, a number inside the language.

    Codes are hashes; should two names meet, others are taken.
    """
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("name")) - 1).alias("source")
    n = names.count()
    for seed in range(64):
        coded = names.select("lang", "name", F.xxhash64(F.lit(seed), "lang", "name").alias("code"), number, F.lit(seed).alias("seed"))
        if coded.select("code").distinct().count() == n:
            return materialize(coded, "source_codes")
    raise ValueError("no seed tells the sources apart")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """``lang, source, term, n, docs``: occurrences and documents of each term; and ``source_codes``."""
    ship(docs.sparkSession)
    lang, name, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col))
    names = materialize(docs.select(lang.alias("lang"), name.alias("name")).distinct(), "source_names")
    codes = source_codes(names)
    seed = codes.agg(F.coalesce(F.max("seed"), F.lit(0))).first()[0]
    rows = docs.select(F.xxhash64(F.lit(seed), lang, name).alias("code"), text.alias("text"))
    piece_bytes, most = PIECE_BYTES, HELD
    partial = rows.mapInArrow(lambda batches: _count(batches, piece_bytes, most), "code bigint, term string, n bigint, docs bigint")
    counts = partial.groupBy("code", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = counts.join(codes.select("code", "lang", "source"), "code").select("lang", "source", "term", "n", "docs")
    return materialize(counts, "term_counts"), codes


def scaled(counts: np.ndarray, size: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / size), exactly."""
    if int(counts.max(initial=0)) < (1 << 62) // SCALE:
        return 1 + (counts + 1) * SCALE // size
    return np.array([1 + SCALE * (c + 1) // size for c in counts.ravel().tolist()], dtype=np.int64).reshape(counts.shape)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / q); both are at most SCALE + 1, so the square fits 64 bits."""
    return (p - q) * (p - q) // q


def shard_parts(shard: pa.Table, best_ranks: int, block: int = BLOCK) -> pa.Table:
    """The divergences of one shard.

    Rows are ``lang, low, high, source, size, vocabulary, lang_size, term, total, n``: one without a
    term for each source of the two blocks, and one for each term of each source. Returns a row per
    pair of sources (``other`` set) with the sum over the shard's ``seen`` terms, and the
    ``best_ranks`` best terms of each source, which are all that can rank.
    """
    first = {name: shard[name][0].as_py() for name in ("lang", "low", "high", "vocabulary", "lang_size")}
    sources, size_at = np.unique(shard["source"].to_numpy(), return_index=True)
    sizes = shard["size"].to_numpy()[size_at].tolist()
    entries = shard.filter(pc.is_valid(shard["term"]))
    terms = entries["term"].combine_chunks().cast(pa.large_string()).dictionary_encode()
    if isinstance(terms, pa.ChunkedArray):
        terms = terms.combine_chunks()
    names, code = terms.dictionary, terms.indices.to_numpy()
    counts = np.zeros((len(sources), len(names)), dtype=np.int64)
    counts[np.searchsorted(sources, entries["source"].to_numpy()), code] = entries["n"].to_numpy()
    totals = np.zeros(len(names), dtype=np.int64)
    totals[code] = entries["total"].to_numpy()
    out: list[tuple] = []
    low = sources // block == first["low"]
    high = sources // block == first["high"]
    p = np.zeros_like(counts)
    for i, size in enumerate(sizes):
        if len(names):
            p[i] = scaled(counts[i], size + first["vocabulary"])
    for i, source in enumerate(sources.tolist()):
        partners = np.flatnonzero(high if low[i] else low) if first["low"] != first["high"] else np.arange(len(sources))
        values = divergence(p[i], p[partners]).sum(axis=1) if len(names) else np.zeros(len(partners), dtype=np.int64)
        for j, value in zip(partners.tolist(), values.tolist()):
            if j != i:
                out.append((first["lang"], source, int(sources[j]), None, value, len(names)))
    if first["low"] == first["high"] and len(names):
        q = scaled(totals, first["lang_size"] + first["vocabulary"])
        words = names.to_pylist()
        for i, source in enumerate(sources.tolist()):
            at = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            values = divergence(p[i][at], q[at])
            if len(at) > best_ranks:
                cut = np.partition(values, len(values) - best_ranks)[len(values) - best_ranks]
                at, values = at[values >= cut], values[values >= cut]
            best = sorted(zip((-values).tolist(), [words[x].encode() for x in at.tolist()]))[:best_ranks]
            out.extend((first["lang"], source, None, word.decode(), -value, 0) for value, word in best)
    columns = zip(*out) if out else [[] for _ in _PARTS]
    return pa.table([pa.array(list(c), type=t) for c, t in zip(columns, _PARTS.types)], schema=_PARTS)


def divergences(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) that occurs.

    Part ``pair``: the other sources of the language by the divergence from them, over all terms that
    ``least_documents`` of the language's documents hold. Part ``term``: terms that the source has
    more often than its language, by their divergence, up to rank ``term_ranks``. Ranks fall with the
    value, ties by item in UTF-8 order. All arithmetic is exact.

    Null texts, languages and sources count as empty strings; an empty text makes its source occur.
    Repeated rows are documents of their own. A language of one source has no pairs, one without
    common terms has pairs of value 0. Other columns are not looked at. An empty table gives no rows.
    """
    counts, codes = term_counts(docs, text_col, lang_col, source_col)
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("total"))
    kept = materialize(kept.where(F.col("d") >= least_documents).select("lang", "term", "total"), "kept_terms")
    held = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    held = materialize(held, "kept_counts")

    # One row per language and one per source of it.
    langs = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("lang_size"))
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = codes.select("lang", "name", "source").join(sizes, ["lang", "source"], "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("size", "vocabulary", "lang_size")]
    groups = groups.join(langs, "lang", "left").select("lang", "name", "source", *zero)
    groups = materialize(groups, "audited_sources")
    blocks = groups.groupBy("lang").agg((F.floor(F.max("source") / BLOCK)).cast("int").alias("last"))
    groups = groups.join(blocks, "lang")

    n_shards = F.ceil(F.greatest("vocabulary", F.lit(1)) / SHARD_TERMS).cast("int")
    shard = F.pmod(F.xxhash64("term"), n_shards).cast("int")
    named = groups.select("lang", "source", "size", "vocabulary", "lang_size", "last")
    entries = held.join(named, ["lang", "source"]).withColumn("shard", shard)
    bare = named.withColumn("shard", F.explode(F.sequence(F.lit(0), n_shards - 1)))
    bare = bare.withColumns({"term": F.lit(None).cast("string"), "total": F.lit(None).cast("bigint"), "n": F.lit(None).cast("bigint")})
    own = F.floor(F.col("source") / BLOCK).cast("int")
    columns = ["lang", "source", "size", "vocabulary", "lang_size", "shard", "term", "total", "n"]
    dealt = entries.select(*columns, "last").unionByName(bare.select(*columns, "last"))
    dealt = dealt.select(*columns, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("x"))
    dealt = dealt.select(*columns, F.least("own", "x").alias("low"), F.greatest("own", "x").alias("high"))
    block = BLOCK
    parts = dealt.groupBy("lang", "shard", "low", "high").applyInArrow(
        lambda table: shard_parts(table, term_ranks, block),
        "lang string, source int, other int, term string, value bigint, seen bigint",
    )
    parts = materialize(parts, "divergence_parts")

    # Terms that neither source has are the same for both of them, wherever they are.
    pairs = parts.where(F.col("other").isNotNull()).groupBy("lang", "source", "other")
    pairs = pairs.agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    scaled_one = lambda size: f"1 + cast({SCALE} div greatest({size} + vocabulary, 1) as bigint)"
    mine = groups.select("lang", "source", "name", "vocabulary", "size")
    theirs = groups.select("lang", F.col("source").alias("other"), F.col("name").alias("item"), F.col("size").alias("other_size"))
    pairs = pairs.join(mine, ["lang", "source"]).join(theirs, ["lang", "other"])
    pairs = pairs.withColumn("p", F.expr(scaled_one("size"))).withColumn("q", F.expr(scaled_one("other_size")))
    rest = F.when(F.col("vocabulary") > F.col("seen"), (F.col("vocabulary") - F.col("seen")) * F.expr("(p - q) * (p - q) div q"))
    pairs = pairs.select("lang", F.col("name").alias("source"), F.lit("pair").alias("part"), "item", (F.col("value") + F.coalesce(rest, F.lit(0))).alias("value"))
    terms = parts.where(F.col("term").isNotNull()).join(mine, ["lang", "source"])
    terms = terms.select("lang", F.col("name").alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best)
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= term_ranks)
    return pairs.withColumn("rank", rank).unionByName(terms)
