import random
import re

import pytest

from wordloom.llm import near_dedup
from wordloom.llm.components import connected_components, joined_components


def shingles(text, width):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(found) < width:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def brute(rows, width, percent):
    """Component of every row by comparing all pairs."""
    sets = [shingles(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)] = min(names.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), names.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows(words):
    r = random.Random(4)
    out = [(0, None), (1, ""), (2, " \t "), (3, "one"), (4, "ONE "), (5, "one two"), (6, "x" * 300_000)]
    # A large group whose members are each a few edits away from one text, and so partly from
    # each other; chains; and unrelated texts.
    base = words(120, 1)
    for k in range(120):
        copy = list(base)
        for _ in range(r.randrange(0, 5)):
            copy[r.randrange(len(copy))] = f"edit{r.randrange(10**6)}"
        out.append((1000 - k, " ".join(copy)))
    chain = words(200, 2)
    for k in range(12):
        out.append((2000 + k, " ".join(chain)))
        chain[k * 10 : k * 10 + 5] = [f"link{k}{i}" for i in range(5)]
    out += [(3000 + k, " ".join(words(60, 100 + k))) for k in range(40)]
    return out + [(990, out[20][1].upper()), (50, out[30][1]), (None, out[40][1]), (None, None)]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_match_all_pairs(docs_of, rows, width, percent):
    docs = docs_of([(doc_id, text, "s") for doc_id, text in rows])
    got = near_dedup.near_duplicates(docs, width=width, percent=percent).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(
        brute(rows, width, percent), key=key
    )
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_dealt_out_groups_give_the_same(docs_of, rows, monkeypatch):
    # Functions run in the workers see the values through the plan, not through this module.
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(near_dedup, "HUBS", 1)
    docs = docs_of([(doc_id, text, "s") for doc_id, text in rows])
    got = near_dedup.near_duplicates(docs, width=3, percent=85).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, c) for i, _, c in brute(rows, 3, 85)}


def test_one_of_each_component_stays(docs_of, rows):
    some = [(doc_id, text, "s") for doc_id, text in rows if doc_id is not None] + [(5, "one two", "s")]
    docs = docs_of(some)
    left = near_dedup.drop_near_duplicates(docs, width=5, percent=80)
    assert left.columns == docs.columns
    want = {c for _, _, c in brute([(i, t) for i, t, _ in some], 5, 80)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)


def test_texts_without_an_id_link_others(docs_of, words):
    base = words(60, 3)
    # 5 is near the first text without an id, which is near the second, which alone is near 9.
    texts = [" ".join(base[:k] + [f"x{j}{i}" for i in range(60 - k)]) for j, k in ((0, 60), (1, 57), (2, 54), (3, 51))]
    chain = [" ".join(base[3 * j : 3 * j + 48]) for j in range(4)]
    rows = [(5, chain[0], "s"), (None, chain[1], "s"), (None, chain[2], "s"), (None, chain[2], "s"), (9, chain[3], "s")]
    rows += [(i, text, "s") for i, text in enumerate(texts, 20)] + [(None, "quite another text without any id", "s"), (None, "", "s")]
    some = [(i, text) for i, text, _ in rows]
    got = near_dedup.near_duplicates(docs_of(rows), width=3, percent=85).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute(some, 3, 85), key=key)
    pair = [(5, chain[0], "s"), (None, " ".join(base[:47]), "s")]
    got = near_dedup.near_duplicates(docs_of(pair), width=3, percent=85).collect()
    assert [r.component_id for r in got] == [5, 5]


def test_columns_named_like_those_inside(spark):
    rows = [(1, "one two three four five six", "a", "b"), (1, "one two three four five six", "a", "b"), (2, "other", "c", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __hash string, __gone string")
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(map(tuple, left.collect())) == [rows[0], rows[2]]


def test_empty_table(docs_of):
    assert near_dedup.near_duplicates(docs_of([])).count() == 0
    assert near_dedup.drop_near_duplicates(docs_of([])).count() == 0


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (5, 4), (200, 201), (200, 201)]
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    want = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert {r.node: r.root for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_are_joined_by_more_links(spark):
    table = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names))
    r = random.Random(8)
    first = [(r.randrange(200), r.randrange(200)) for _ in range(90)]
    more = [(r.randrange(230), r.randrange(230)) for _ in range(60)] + [(5, 5), first[0], first[0]]
    roots = connected_components(table(first, "ab"))
    got = joined_components(roots, table(more, "ab"))
    want = connected_components(table(first + more, "ab"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    again = joined_components(roots, table([], "ab"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, roots.collect()))
    low = {}
    for a, b in first + more:
        low.setdefault(a, a), low.setdefault(b, b)
    for _ in range(300):
        for a, b in first + more:
            low[a] = low[b] = min(low[a], low[b])
    assert dict(map(tuple, want.collect())) == {n: root for n, root in low.items() if any(n in x for x in first + more if x[0] != x[1])}
