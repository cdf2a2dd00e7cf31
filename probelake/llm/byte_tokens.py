"""Token ids of a byte-level ``tokenizers`` file, from the same merges in the faster encoder of ``tiktoken``.

Only files of one well-known make are taken that way; all others, and texts that hold a special token, go through the
tokenizer itself, so any file gives its own ids.
"""

from __future__ import annotations

import json
from array import array

from .common import worker_memo
from .tokens import load

#: Fixed value: the split pattern of the byte-level pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Printable bytes stand for themselves in byte-level vocabularies, the others are moved past 255.
_KEPT = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
    "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes to ids of a byte-level file whose ids follow its merges; None for files of another make."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = all(model.get(key, value) == value for key, value in _MODEL.items()) and spec.get("normalizer") is None
    byte_level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if not (plain and byte_level):
        return None
    moved = iter(range(256, 512))
    byte_of = {chr(b) if b in set(_KEPT) else chr(next(moved)): b for b in range(256)}
    added = {token["content"] for token in spec.get("added_tokens", ())}
    vocabulary = {name: at for name, at in model["vocab"].items() if name not in added}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    in_order = [vocabulary.get(name) for name in merged] == list(range(256, 256 + len(merged)))
    if not in_order or len(vocabulary) != 256 + len(merged) or any(c not in byte_of for name in vocabulary for c in name):
        return None
    return {bytes(byte_of[c] for c in name): at for name, at in vocabulary.items()}


class ByteEncoder:
    """``encode`` gives the ids of ``tokenizer.encode(text, add_special_tokens=False)`` as little-endian 32-bit bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ranks = merge_ranks(spec)
        self.special = [token["content"] for token in spec.get("added_tokens", ())]
        self.path, self.tokenizer, self.ordinary = path, None, None
        if ranks is not None:
            import tiktoken

            encoding = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.ordinary = encoding.encode_ordinary

    @classmethod
    def here(cls, path: str) -> ByteEncoder:
        """The one of this worker process."""
        return worker_memo(("byte-encoder", path), lambda: cls(path))

    def library(self, text: str) -> list[int]:
        if self.tokenizer is None:
            self.tokenizer = load(self.path)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        plain = self.ordinary is not None and not any(token in text for token in self.special)
        return array("I", self.ordinary(text) if plain else self.library(text)).tobytes()
