"""Token ids of byte-level BPE vocabularies, as the tokenizers library gives them.

``Vocabulary`` holds the text of a ``tokenizers`` file, read once on the driver
and broadcast (megabytes, whatever the corpus). A worker builds its encoder
once. Where the file is a plain byte-level BPE whose ids follow its merges, the
merges run in tiktoken's encoder, which is several times faster and gives the
same ids (each token of such a vocabulary encodes to itself, so both libraries
meet the same merges in the same order; the tests check all tokens, all code
points and whole texts against the library). Any other file, and texts that
hold one of the file's special strings, go to the library itself.
"""

from __future__ import annotations

import json
from array import array
from functools import cached_property, lru_cache

# fixed value: the split of byte-level BPE pre-tokenization
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level files."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of texts for one vocabulary file (its JSON text)."""

    def __init__(self, source: str):
        self.source = source
        spec = json.loads(source)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.core = self._core(spec)

    @cached_property
    def library(self):
        """The tokenizers library's own encoder; built when first needed, as it takes memory in every worker."""
        from tokenizers import Tokenizer
        return Tokenizer.from_str(self.source)

    @staticmethod
    def _core(spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and not spec.get("post_processor")
                 and not spec.get("truncation") and not spec.get("padding")
                 and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain:
            return None
        vocab, byte_of = model["vocab"], _byte_of()
        for k, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if vocab.get(a + b) != 256 + k:  # ids must follow the merges
                return None
        added = {t["content"] for t in spec.get("added_tokens") or []}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
        import tiktoken
        return tiktoken.Encoding("byte_level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if self.core is not None and not any(s in text for s in self.special):
            got = self.core.encode_ordinary(text)
        else:
            got = self.library.encode(text, add_special_tokens=False).ids
        return _packed(got)

    def count(self, text: str) -> int:
        if self.core is not None and not any(s in text for s in self.special):
            return len(self.core.encode_ordinary(text))
        return len(self.library.encode(text, add_special_tokens=False))


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if out.itemsize != 4:
        out = array("L", ids)
    import sys
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@lru_cache(2)
def encoder(source: str) -> Encoder:
    """The worker's encoder for a file's text; built once in a process."""
    return Encoder(source)


def read_vocabulary(path: str) -> str:
    """The file's text (driver side; a parameter names the path)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
