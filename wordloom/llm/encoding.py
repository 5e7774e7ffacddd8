"""Token ids of texts by a public tokenizer, with repeated words looked up instead of encoded."""

from __future__ import annotations

import json
import string
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Words remembered by one worker; a full memory is emptied, which costs time and no result.
REMEMBERED = 600_000

# Texts with these are given to the library whole: its own special tokens, and four characters
# that are white space for some functions and not for others.
_ODD = r"<\||[\x1c-\x1f]"
# A mark between a letter or digit and white space is a piece of its own; a space before it
# changes no id and leaves fewer different words.
_MARKED = r"([a-zA-Z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}])([,.])(\s|$)"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = {}, 0
    for byte in range(256):
        out[byte] = chr(byte) if byte in printable else chr(256 + extra)
        extra += byte not in printable
    return out


class _Words(dict):
    """Word to the number of its entry in ``starts``; an unknown word is encoded and added."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.letters = _byte_letters()
        self.ids, self.starts = array("I"), array("Q", [0])

    def __missing__(self, word: str) -> int:
        # Plain Latin letters with ASCII marks before and behind are up to three pieces, and the
        # model can be asked for the letters directly. All else takes the whole tokenizer.
        tail = word.rstrip(string.punctuation)
        core = tail.lstrip(string.punctuation)
        if core.isalpha() and max(core) < "ɐ" and "İ" not in core and word[0] != "'":
            before, behind = tail[: len(tail) - len(core)], word[len(tail) :]
            outer = [self.span(part) if part else () for part in (before, behind)]
            core = core.lower()
            if not core.isascii():
                core = core.encode().decode("latin-1").translate(self.letters)
            ids = [*outer[0], *[token.id for token in self.model.tokenize(core)], *outer[1]]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        number = self[word] = len(self)
        self.ids.extend(ids)
        self.starts.append(len(self.ids))
        return number

    def span(self, word: str) -> array:
        number = self[word]
        return self.ids[self.starts[number] : self.starts[number + 1]]


class Encoder:
    """Encodes batches of texts to one flat id array and the number of ids of each text.

    If the tokenizer drops white space, maps each character by itself and has no piece that spans
    white space, a text's ids are those of its words in order, and each different word is encoded
    once. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        normal = described.get("normalizer") or {}
        kinds = [x.get("type") for x in normal.get("normalizers", [])]
        pieces = (described.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split = pieces[0]
        self.by_word = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and split.get("type") == "Split"
            and split.get("behavior") == "Removed"
            and split.get("invert") is True
            and split["pattern"].get("Regex")
            == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            and [x.get("type") for x in pieces[1:]] == ["ByteLevel"]
            and not any(x["lstrip"] or x["rstrip"] for x in described.get("added_tokens", []))
        )
        self.words = _Words(self.tokenizer)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each text has; null is empty."""
        # A slice is copied first: Arrow's string functions misread the buffers of some slices.
        texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
        if not self.by_word:
            return self._whole(texts)
        odd = pc.match_substring_regex(texts, _ODD)
        if pc.any(odd).as_py():
            return self._mixed(texts, odd)
        if len(self.words) > REMEMBERED:
            self.words = _Words(self.tokenizer)
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _MARKED, r"\1 \2\3")
        split = pc.utf8_split_whitespace(spaced)
        coded = split.values.dictionary_encode()
        find = self.words.__getitem__
        known = np.fromiter(map(find, coded.dictionary.to_numpy(zero_copy_only=False)), dtype=np.int64)
        # Views of the growing arrays; they are gone before the next word is added.
        starts = np.frombuffer(self.words.starts, dtype=np.int64)
        ids = np.frombuffer(self.words.ids, dtype=np.uint32)
        first, size = starts[known].astype(np.int32), np.diff(starts)[known].astype(np.int32)
        numbers = coded.indices.to_numpy()
        upto = np.zeros(len(numbers) + 1, dtype=np.int64)
        np.cumsum(size[numbers], out=upto[1:])
        flat = np.empty(int(upto[-1]), dtype=np.uint32)
        for low in range(0, len(numbers), 1 << 16):
            part = numbers[low : low + (1 << 16)]
            size_here = size[part]
            shift = first[part] - (upto[low : low + len(part)] - upto[low]).astype(np.int32)
            end = low + len(part)
            at = np.repeat(shift, size_here) + np.arange(upto[end] - upto[low], dtype=np.int32)
            flat[upto[low] : upto[end]] = ids[at]
        return flat, np.diff(upto[split.offsets.to_numpy()])

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
        counts = np.array([len(x.ids) for x in made], dtype=np.int64)
        flat = [np.array(x.ids, dtype=np.uint32) for x in made]
        return np.concatenate(flat or [np.zeros(0, dtype=np.uint32)]), counts

    def _mixed(self, texts: pa.Array, odd: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts that need the whole tokenizer among others, put back in order."""
        plain, whole = self.encode(texts.filter(pc.invert(odd))), self._whole(texts.filter(odd))
        parts = {False: [np.split(plain[0], np.cumsum(plain[1])), 0],
                 True: [np.split(whole[0], np.cumsum(whole[1])), 0]}
        flat = []
        for kind in odd.to_pylist():
            pieces, at = parts[kind]
            flat.append(pieces[at])
            parts[kind][1] += 1
        return np.concatenate(flat), np.array([len(x) for x in flat], dtype=np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process; it outlives a task, so known words stay known."""
    return Encoder(path)
