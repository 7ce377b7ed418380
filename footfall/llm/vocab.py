"""Encoding with a public vocabulary inside tasks, one word at a time through a cache."""

from __future__ import annotations

import json
import re
import struct
from functools import cached_property, lru_cache

import numpy as np

_CACHED_WORDS = 800_000
_CACHED_CHARS = 64
# Signs that Python splits at but vocabularies do not take for white space.
_NO_SPACE = "\x1c\x1d\x1e\x1f"
# Text for which the split below equals the vocabulary's own: up to U+017F, but for U+0130,
# whose lower case is two code points.
_SIMPLE = re.compile("[\x00-įı-ſ]*")
_LETTER, _NUMBER, _BLANK = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
# The rules of a vocabulary file that the split below spells out for simple text.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {
                "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
            },
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# The same split pattern over the signs of simple text.
_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+"
)


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    signs = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [signs[b] for b in range(256)]


class _Ids(dict):
    """The packed ids of chunks seen lately; others are encoded when they are asked for.

    Of two halves the older one goes when the newer is full, so what texts repeat stays.
    """

    def __init__(self, encode):
        super().__init__()
        self._encode, self._older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        packed = self._older.get(chunk)
        if packed is None:
            packed = self._encode(chunk)
        if len(chunk) <= _CACHED_CHARS:
            if len(self) >= _CACHED_WORDS // 2:
                self._older = self.copy()
                self.clear()
            self[chunk] = packed
        return packed


class Vocabulary:
    """A tokenizer file whose text is split at white space, which it drops.

    ``plain`` takes the strings of special tokens for ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        self.plain = plain
        with open(path, encoding="utf-8") as source:
            rules = json.load(source)
        # other rules: the library splits every word
        self._spelt_out = (rules["normalizer"], rules["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        probe = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        if probe("It's 12 up.") != [i for w in ("It's", "12", "up.") for i in probe(w)]:
            raise ValueError("the vocabulary must drop white space and split texts there")
        self._chunks = _Ids(self._chunk)
        self._signs = dict(enumerate(byte_signs()))
        self._tokenize = self.tokenizer.model.tokenize

    @cached_property
    def tokens(self) -> list[str]:
        return [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]

    @cached_property
    def numerals(self) -> list[str]:
        return [str(i) for i in range(self.size)]

    @cached_property
    def specials(self) -> dict[str, int]:
        added = self.tokenizer.get_added_tokens_decoder()
        return {} if self.plain else {t.content: i for i, t in added.items() if t.special}

    @cached_property
    def inner(self):
        """The merges without the mark of a word's end: for fragments that end inside a word."""
        from tokenizers.models import BPE

        model = json.loads(open(self.path, encoding="utf-8").read())["model"]
        return BPE(model["vocab"], [tuple(m) for m in model["merges"]])

    @cached_property
    def suffix(self) -> str:
        return self.tokenizer.model.end_of_word_suffix or ""

    # --- whole texts ---------------------------------------------------------------
    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers, equal to the library's."""
        out = []
        for text in texts:
            if any(sign in text for sign in _NO_SPACE):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
                continue
            out.append(b"".join(map(self._chunks.__getitem__, text.split())))
        return out

    def _chunk(self, chunk: str) -> bytes:
        if not self._spelt_out:
            simple = False
        elif chunk.isascii() and chunk.isalpha():  # one word
            words, simple = [chunk.lower()], True
        elif _SIMPLE.fullmatch(chunk) and (self.plain or "<|" not in chunk):
            words, simple = _WORD.findall(chunk.lower()), True
        else:
            simple = False
        if not simple:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        elif words == [chunk]:
            ids = [t.id for t in self._tokenize(self.spelt(chunk))]
        else:  # a word is a chunk of its own
            return b"".join(map(self._chunks.__getitem__, words))
        return struct.pack(f"<{len(ids)}I", *ids)

    def spelt(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self._signs)

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes, special tokens kept."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])

    # --- words of long texts ---------------------------------------------------------
    def words(self, text: str) -> list[str]:
        """The spelt words of a text by the vocabulary's own rules; special tokens as they are."""
        specials = "|".join(re.escape(s) for s in self.specials)
        parts = re.split(f"({specials})", text) if specials else [text]
        out: list[str] = []
        for part in parts:
            if part in self.specials:
                out.append(part)
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                out += [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def word_ids(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        return [t.id for t in self._tokenize(word)]

    def fragment_ids(self, spelt: str, ends_word: bool) -> list[int]:
        model = self.tokenizer.model if ends_word else self.inner
        return [t.id for t in model.tokenize(spelt)]

    def bare(self, token_id: int) -> str:
        """The signs a token stands for, without the mark of a word's end."""
        token = self.tokens[token_id]
        return token[: len(token) - len(self.suffix)] if self.ends_word(token_id) else token

    def ends_word(self, token_id: int) -> bool:
        return bool(self.suffix) and self.tokens[token_id].endswith(self.suffix)


@lru_cache(maxsize=4)
def vocabulary(path: str, plain: bool = False) -> Vocabulary:
    """One vocabulary per Python worker."""
    return Vocabulary(path, plain)
