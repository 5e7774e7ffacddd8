import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from wordloom.llm import encoding, token_counts, token_planes

ODD = [
    None, "", "  \n ", "a\x1cb c", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "İstanbul Σας ΟΔΟΣ", "été ́x",
    "don't we'll it's, 'S x'S.", "1,234.5 a1b2 ...,", "a,.b.,c. d!, e?. ", "日本語 テキスト.", "\x00 a\x00b", "a\x85b c",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(encoding.default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_like_whole_texts(tokenizer):
    import pyarrow as pa

    r = random.Random(3)
    odd = ["".join(r.choice("aAbÉéßİ ,.'\n\t1٣́ !<|>Σσςsdmtrevl日\x1c\x85") for _ in range(r.randrange(60))) for _ in range(400)]
    for texts in (ODD + odd, odd[:50], ["plain words, here. And more"] * 3, []):
        flat, counts = encoding.Encoder(encoding.default_path()).encode(pa.array(texts, pa.string()))
        want = [ids_of(tokenizer, text) for text in texts]
        assert counts.tolist() == [len(x) for x in want]
        assert flat.tolist() == [x for one in want for x in one]


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("top", [0, 1, 255, 256, 49407, (1 << 32) - 1])
def test_planes_round_trip(unit, top):
    ids = np.random.default_rng(1).integers(0, top, 1003, endpoint=True, dtype=np.uint32)
    assert (token_planes.from_planes(token_planes.to_planes(ids, unit), len(ids), unit) == ids).all()


def test_encoded_at_once_is_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_planes, "SLICE_BYTES", 1000)
    texts = ["word " * 40] * 50 + [None, "", "long " * 900, ""] + ["x"] * 3
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    pieces = [piece.column(1).to_pylist() for piece in token_planes._slices(batch)]
    assert [text for piece in pieces for text in piece] == texts
    assert all(sum(len(text or "") for text in piece) <= 1000 + max(len(text or "") for text in piece) for piece in pieces)
    assert len(pieces) > 10 and list(token_planes._slices(batch.slice(0, 0))) == []


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_files_hold_every_document(spark, docs_of, tokenizer, monkeypatch, unit):
    rows = [(i, text, "s") for i, text in enumerate(ODD)]
    rows += [(50, "many words " * 60_000, "s"), (7, "repeated id", "s"), (7, "repeated id", "s"), (None, "no id", None)]
    blocks, index = token_planes.write_blocks(docs_of(rows), unit=unit)
    got = token_planes.read_digests(blocks, index).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, stream = 0, []
    for row, (doc_id, text, _) in zip(got, rows, strict=True):
        ids = ids_of(tokenizer, text) + [1]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, at, len(ids), crc)
        at, stream = at + len(ids), stream + ids
    for start, count in ((0, 10), (65_530, 20), (at - 5, 50), (0, at)):
        assert token_planes.read_range(blocks, index, start, count).tolist() == stream[start : start + count]


def test_empty_table(docs_of):
    blocks, index = token_planes.write_blocks(docs_of([]))
    assert blocks.count() == 0 and index.count() == 0
    assert token_planes.read_digests(blocks, index).count() == 0


def test_length_histogram_answers_every_limit(docs_of, tokenizer):
    rows = [(i, text, "s") for i, text in enumerate(ODD)] + [(99, "long text " * 3000, "s"), (99, "long text " * 3000, "s")]
    lengths = np.array([len(ids_of(tokenizer, text)) for _, text, _ in rows])
    table = token_counts.token_counts(docs_of(rows))
    for row in table.collect():
        assert row.n_docs == (lengths == row.length).sum()
        assert row.docs_at_least == (lengths >= row.length).sum()
        assert row.tokens_at_least == lengths[lengths >= row.length].sum()
        assert row.tokens_truncated == np.minimum(lengths, row.length).sum()
        assert row.docs_truncated == (lengths > row.length).sum() and row.tokens_total == lengths.sum()
        assert row.quantile == pytest.approx((lengths <= row.length).mean())
    for limit in (0, 1, 5, 700, 10**6):
        assert token_counts.truncated_total(table, limit) == np.minimum(lengths, limit).sum()
    assert token_counts.token_counts(docs_of([])).count() == 0
