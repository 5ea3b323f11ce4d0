"""A byte-level BPE vocabulary file, read once per Python worker.

The file is one of the tokenizers library. Its merge list is in the order of its ids (checked when it is read), so a
faster encoder of the same vocabulary gives the same ids; a test holds both libraries against each other.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken

#: Fixed value: the splitting pattern of this kind of file (pre-tokenizer ByteLevel with use_regex).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letters by which such files write bytes: printable Latin-1 for itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocab:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("only byte-level BPE files without a normalizer and a prefix space are read")
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        words, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {as_bytes(w): i for w, i in words.items() if w not in special}
        made = [ranks[as_bytes("".join(m if isinstance(m, list) else m.split(" ")))] for m in merges]
        if made != list(range(made[0], made[0] + len(made))) or made[0] != 256:
            raise ValueError("the merges are not in the order of the ids")
        self.special = special
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (1 + max(max(ranks.values()), *special.values(), 0))
        for b, i in ranks.items():
            self.bytes[i] = b
        for s, i in special.items():
            self.bytes[i] = s.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text without special tokens, in one go."""
        if not text:
            return np.empty(0, np.uint32)
        return np.frombuffer(self.coder.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).tobytes(), np.uint32)

    def piece(self, octets: bytes) -> np.ndarray:
        """Ids of bytes that lie within one word of the splitting pattern."""
        return np.array(self.coder._encode_single_piece(octets), np.uint32)


@lru_cache(maxsize=4)
def vocab(path: str) -> Vocab:
    return Vocab(path)
