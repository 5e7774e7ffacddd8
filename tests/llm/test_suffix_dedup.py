import collections
import hashlib
import random

import numpy as np
import pytest

from wordloom.llm import suffix_dedup


def brute(texts, length):
    seen = collections.Counter()
    raws = [(text or "").encode() for text in texts]
    for raw in raws:
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone, end = bytearray(len(raw)), 0
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                for k in range(max(i, end), i + length):
                    gone[k] = 1
                end = i + length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def texts(words):
    r = random.Random(1)
    make = lambda n: " ".join(words(n, r.random(), "abcdé"))
    shared = [make(150) for _ in range(4)]
    out = [None, "", "a" * 5000, "ab" * 2000, "x" + "a" * 900, make(200) * 3]
    out += [make(r.randrange(5, 60)) + r.choice(shared)[r.randrange(0, 200) :] + make(r.randrange(60)) for _ in range(40)]
    return out + out[8:11] + [out[20][:500] + "ZZ" + out[20][500:]]


@pytest.mark.parametrize(("length", "hot"), [(400, 2000), (256, 2000), (400, 3)])
def test_removal_matches_brute_force(docs_of, texts, length, hot):
    docs = docs_of([(i, text, "s") for i, text in enumerate(texts)])
    got = suffix_dedup.remove_repeats(docs, length=length, digest=True, hot=hot).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, length)


def test_long_text_and_repeated_rows(docs_of, words):
    long = " ".join(words(60_000, 2))
    other = long[300_000:301_000] + " end"
    rows = [(1, long, "s"), (2, other, "s"), (3, "y" * 399, "s"), (3, "y" * 399, "s"), (None, "z" * 401, None)]
    got = suffix_dedup.remove_repeats(docs_of(rows), digest=True).collect()
    want = brute([text for _, text, _ in rows], 400)
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)


def test_spans_and_kept_bytes(docs_of):
    row = suffix_dedup.remove_repeats(docs_of([(1, "b" * 500, "s"), (2, "x" + "b" * 450, "s")])).orderBy("doc_id").collect()
    assert row[0].spans == [[0, 500]] and bytes(row[1].kept) == b"x" and row[1].n_removed == 450


def test_empty_table(docs_of):
    assert suffix_dedup.remove_repeats(docs_of([]), digest=True).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_two_stage_order_is_the_suffix_order(seed):
    r = np.random.default_rng(seed)
    data = np.append(r.integers(97, 97 + 1 + seed, 3000, dtype=np.uint8), 255).astype(np.uint8)
    starts = np.zeros(len(data), dtype=bool)
    starts[:2800] = r.random(2800) < 0.7
    raw, order = data.tobytes(), suffix_dedup.suffix_order(data, starts, 50)
    mine = [i for i in order.tolist() if starts[i]]
    assert sorted(mine) == np.flatnonzero(starts).tolist()
    assert [raw[i : i + 50] for i in mine] == sorted(raw[i : i + 50] for i in mine)
