"""Token ids of a ``tokenizers`` file, by words whose ids are remembered.

For the vocabulary used here white space always ends a token (see ``WordEncoder``), so a text's ids are those of its
words one after the other, and a word needs encoding only once as long as it is remembered.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

from .common import worker_memo

#: Printable bytes stand for themselves in byte-level vocabularies, the others are moved past 255.
_KEPT = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Letters, and digits with fractions, of Latin-1 after lower-casing, as Unicode classes them.
_LETTER, _NUMBER = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
_ASCII_BLANK = re.compile("[ \t\n\x0b\x0c\r]+")
_UNSAFE = re.compile("[\x1c-\x1f]")
#: The file's split pattern for words of Latin-1 characters without controls.
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
_LATIN = re.compile("[\x21-\x7e\xa1-\xff]*")


#: How the files that words are encoded for are made. Any other file goes through its tokenizer.
_MAKE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed", "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def is_known_make(spec: dict) -> bool:
    """Whether a file's normalizer, split, decoder and model are those that ``WordEncoder`` takes apart."""
    special = all(token["content"].startswith("<|") and token["special"] for token in spec.get("added_tokens", ()))
    model = all(spec["model"].get(key) == value for key, value in _MODEL.items())
    return special and model and all(spec.get(key) == value for key, value in _MAKE.items())


def split_words(text: str) -> list[str]:
    """Runs between white space that the tokenizer surely takes as such."""
    if _UNSAFE.search(text):
        return [word for word in _ASCII_BLANK.split(text) if word]
    return text.split()


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return array("I", ids).tobytes()


def load(path: str):
    """The file's tokenizer without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordEncoder:
    """Ids as little-endian unsigned 32-bit bytes, the same as ``encode(text, add_special_tokens=False)``.

    Texts are taken apart for files of one make only (``is_known_make``); for others each text goes to the tokenizer whole.
    Where the normalizer and split keep white space a border: NFC composes nothing with it, lower-casing is by
    character, the split pattern matches no white space. Words of Latin-1 characters are split here by the same pattern
    and their pieces given to the file's model; other words, and words that may hold a special token, go through the
    whole tokenizer. A piece is a word that the pattern leaves whole, so both are held together: at most twice ``remembered``.
    """

    def __init__(self, path: str, remembered: int = 400_000) -> None:
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as file:
            self.known = is_known_make(json.load(file))
        self.model = self.tokenizer.model
        self.remembered = remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        moved = iter(range(256, 512))
        self.alphabet = {b: chr(b) if b in set(_KEPT) else chr(next(moved)) for b in range(256)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(vocabulary.values()) + 1)
        for name, at in vocabulary.items():
            self.names[at] = name

    @classmethod
    def here(cls, path: str) -> WordEncoder:
        """The one of this worker process."""
        return worker_memo(("word-encoder", path), lambda: cls(path))

    def library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _spelled(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.alphabet)
        return _packed([token.id for token in self.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        ids = self.young.get(word) or self.old.get(word)
        if ids is None:
            if _LATIN.fullmatch(word) and "<|" not in word:
                pieces = _PIECES.findall(word.lower())
                ids = self._spelled(word) if pieces == [word] else b"".join(map(self._word, pieces))
            else:
                ids = self.library(word)
        if len(self.young) >= self.remembered:
            self.young, self.old = {}, self.young
        self.young[word] = ids
        return ids

    def words(self, words: list[str]) -> bytes:
        found = list(map(self.young.get, words))
        if None in found:
            found = [self._word(word) if ids is None else ids for word, ids in zip(words, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        return self.words(split_words(text)) if self.known else self.library(text)

    def decode(self, ids: bytes) -> str:
        """As ``decode(ids, skip_special_tokens=False)``: without a decoder the tokens' strings joined by blanks."""
        if not self.known:
            return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])
