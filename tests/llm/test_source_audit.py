import random
import re
from collections import Counter, defaultdict

import pytest

from wordloom.llm import source_audit

SCHEMA = "text string, lang string, source string, term string, n string, number int, shard int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(spark, rows, **options):
    df = source_audit.divergences(spark.createDataFrame([(*row, "t", "n", 1, 2) for row in rows], SCHEMA), **options)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def brute(rows, least=3, ranks=200):
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def rates(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (size + len(kept)) for t in kept}

        whole = rates(sum((counts[lang, s] for s in names), Counter()))
        p = {s: rates(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in names if o != s]
            terms = [
                (-((p[s][t] - whole[t]) ** 2 // whole[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    vocabulary = ["Äpfel", "İstanbul", "ÉTÉ", "été", "naïve", "a", "B", "日本", "x y", "ſ"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    out = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{r.randrange(9)}"
        words = r.choices(vocabulary, weights=[1 / (k + 1 + len(source)) for k in range(len(vocabulary))], k=r.randrange(0, 60))
        out.append((r.choice([" ", "-", "1", ". ", "\n", "'"]).join(words), r.choice(["en", "de"]), source))
    return [*out, *out[:20], *[("Same words here", "en", f"copy{i}") for i in range(4)]]


def test_equals_brute_force(spark, rows):
    want = brute(rows)
    assert audited(spark, rows) == want and {r[2] for r in want} == {"pair", "term"}


@pytest.mark.parametrize("changed", [{"BLOCK": 3}, {"SHARD_TERMS": 7}, {"BLOCK": 1, "SHARD_TERMS": 20}, {"PIECE_BYTES": 300, "HELD": 50}])
def test_layout_changes_nothing(spark, rows, monkeypatch, changed):
    for name, value in changed.items():
        monkeypatch.setattr(source_audit, name, value)
    assert audited(spark, rows) == brute(rows)


def test_ranks_are_cut_at_the_limit(spark, rows):
    assert audited(spark, rows, term_ranks=4, least_documents=10) == brute(rows, 10, 4)


def test_nulls_empty_texts_and_lone_sources(spark):
    rows = [
        (None, "en", "a"), ("", "en", "b"), ("one two", None, None), ("two one", "", ""), ("one", None, "c"), ("12 ;;", "fr", "x"),
        ("one one", "", "c"), (None, "fr", "y"), ("word", "es", "only"), (None, None, None),
    ]
    want = brute(rows)
    assert audited(spark, rows) == want
    assert ("en", "a", "pair", "b", 0, 1) in want and not [r for r in want if r[0] == "es"]


def test_very_long_text(spark):
    rows = [("abc def " * 300_000, "en", "long"), *[("abc xyz", "en", f"s{i}") for i in range(3)]]
    assert audited(spark, rows) == brute(rows)


def test_great_counts_stay_exact():
    import numpy as np

    counts = np.array([0, 5, 10**13, 3 * 10**13])
    size = 4 * 10**13 + 9
    assert source_audit.scaled(counts, size).tolist() == [1 + 10**9 * (c + 1) // size for c in counts.tolist()]


def test_empty(spark):
    assert audited(spark, []) == []
