"""Token ids of whole texts with a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The steps and the word pattern of tokenizer files that split on white space,
# lower-case and then code each word on its own.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKENIZERS = ["Split", "ByteLevel"]
# The letters and numbers of Latin-1, lower-cased.
LETTERS, NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\t-\\r {LETTERS}{NUMBERS}]+"
)
# Latin-1 without control letters and spaces that only some of the steps take for white space.
PLAIN = bytes([*range(9, 14), *range(32, 127), *range(161, 256)])
CACHED_WORDS = 200_000
SLICE_CHARS = 2_000_000


class Encoder:
    """Ids of texts, as ``encode(text, add_special_tokens=False)`` gives them.

    Where the file codes each word on its own, the words of a Latin-1 text are
    looked up among those met before and only new ones are coded. The words
    kept are bounded by ``CACHED_WORDS``. Any other text or file takes the
    library's own way.
    """

    def __init__(self, content: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.by_word = _codes_words_alone(json.loads(content))
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self.tokenizer.model)

    def __call__(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.bytes(text), "<u4")

    def bytes(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if not self._by_words(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        self._trim()
        return b"".join(map(self.words.__getitem__, SPLIT.findall(text.lower())))

    def many(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for own, each in self.parts(texts):
            ids.append(own)
            counts.append(each)
        return np.concatenate(ids), np.concatenate(counts)

    def parts(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for slices of the texts, one after the other.

        What stands between white space is looked up once for all texts of a slice.
        """
        for part in _slices(texts):
            self._trim()
            plain = [t if t and self._by_words(t) else "" for t in part]
            own, each = self._plain(plain)
            odd = [k for k, t in enumerate(part) if t and not plain[k]]
            if odd:
                cut = np.split(own, np.cumsum(each)[:-1])
                for k in odd:
                    cut[k] = self(part[k])
                own, each = np.concatenate(cut), np.array([len(c) for c in cut])
            yield own, each

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
        chunks = lists.flatten().dictionary_encode()
        # through numpy: Arrow's own list makes an object of its own for every value on the way
        coded = self._chunks(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(coded), "<u4")
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        begins = np.cumsum(lengths) - lengths
        at = chunks.indices.to_numpy()
        n = lengths[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        shift = (begins[at] - ends[:-1]).astype(np.int32)  # a slice has far less than 2**31 ids
        ids = flat[np.repeat(shift, n) + np.arange(ends[-1], dtype=np.int32)]
        return ids, np.diff(ends[lists.offsets.to_numpy()])

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of lower-cased chunks without white space."""
        words, split, join = self.words, SPLIT.findall, b"".join
        known = words.__getitem__
        return [words[c] if c.isalpha() else join(map(known, split(c))) for c in chunks]

    def _by_words(self, text: str) -> bool:
        return self.by_word and _is_plain(text) and not any(s in text for s in self.specials)

    def _trim(self) -> None:
        if len(self.words) >= CACHED_WORDS // 2:
            self.words.age()


def _slices(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
    part: list[str | None] = []
    held = 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= SLICE_CHARS:
            yield part
            part, held = [], 0
    if part:
        yield part


def _is_plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return False


class _Words(dict):
    """Ids of words as little-endian bytes; a word met for the first time is coded.

    ``age`` forgets the words that were not met since it was called last.
    """

    def __init__(self, model) -> None:
        self.code = model.tokenize
        self.letters = _byte_letters()
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            pieces = [p.id for p in self.code(word.translate(self.letters))]
            ids = pack(f"<{len(pieces)}I", *pieces)
        self[word] = ids
        return ids

    def age(self) -> None:
        self.older = dict(self)
        self.clear()


@lru_cache(maxsize=1)
def encoder(content: str) -> Encoder:
    return Encoder(content)


def tokenizer_content(path: str) -> str:
    """The file's text, which travels with the tasks: executors need not have the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _codes_words_alone(spec: dict) -> bool:
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    model = spec.get("model") or {}
    return (
        [s["type"] for s in steps] == NORMALIZERS
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and [s["type"] for s in splits] == PRE_TOKENIZERS
        and splits[0]["pattern"] == {"Regex": WORD_PATTERN}
        and (splits[0]["behavior"], splits[0]["invert"]) == ("Removed", True)
        and not (splits[1]["add_prefix_space"] or splits[1]["use_regex"])
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and spec.get("post_processor") is None
        and all(not t["normalized"] for t in spec.get("added_tokens") or [])
    )


def _byte_letters() -> dict[int, str]:
    """Latin-1 letter to the printable stand-ins of its UTF-8 bytes: bytes that do not
    print are numbered from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {b: chr(b) for b in prints}
    for b in range(256):
        if b not in stand_in:
            stand_in[b] = chr(256 + len(stand_in) - len(prints))
    return {c: "".join(stand_in[b] for b in chr(c).encode()) for c in range(256)}
