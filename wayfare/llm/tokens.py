"""Token ids by a public byte-level BPE vocabulary file (path is a parameter).

The file is in the format of the ``tokenizers`` library.  Where it is a plain
byte-level BPE whose merges are in id order, texts are encoded by ``tiktoken``
with ranks read from the same file, which gives the same ids several times
faster; any other file, and any text with one of the file's added tokens, is
encoded by ``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np

#: Fixed value: the split pattern of byte-level BPE as the file format defines it.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._ranks(spec)

    @functools.cached_property
    def slow(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ranks(self, spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if not plain or model.get("dropout") or model.get("byte_fallback"):
            return None
        letters, vocab = _byte_letters(), model["vocab"]
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if any(x is None for x in merged) or merged != sorted(merged):
            return None
        ranks = {}
        for token, i in vocab.items():
            if token not in self.added:
                ranks[bytes(letters[c] for c in token)] = i
        import tiktoken

        return tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(t in text for t in self.added):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
