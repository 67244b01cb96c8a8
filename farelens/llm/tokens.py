"""Token ids of a byte-level BPE file (``tokenizers`` format), encoded by ``tiktoken``.

``tiktoken`` merges by the rank of the joined bytes, ``tokenizers`` by its list
of merges.  Both give the same ids when the n-th merge makes the n-th token
after the single bytes and every token encodes to itself; ``merges_by_rank``
checks that once on the driver.  Other files are encoded by ``tokenizers``.
"""

from __future__ import annotations

import json

import numpy as np

# Fixed values of byte-level BPE: the pattern that cuts a text into words, and
# the printable character that stands for each byte.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: b for b in _PRINTABLE} | {
    b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _PRINTABLE)}


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    return _token_bytes(_spec(path))


def _token_bytes(spec: dict) -> dict[int, bytes]:
    char_bytes = {chr(c): b for b, c in BYTE_CHARS.items()}
    # An added token may be listed in the vocabulary, too, and is no byte string.
    return {i: bytes(char_bytes[c] for c in token) for token, i in spec["model"]["vocab"].items()
            if all(c in char_bytes for c in token)}


def merges_by_rank(path: str) -> bool:
    """Whether encoding by ranks gives the ids that encoding by the file's merges gives."""
    from tokenizers import Tokenizer

    spec = _spec(path)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model["type"] == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
             and pre.get("use_regex", True) and not pre.get("add_prefix_space")
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "ignore_merges")))
    if not plain:
        return False
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    vocab = model["vocab"]
    made = {"".join(p) for p in pairs}
    singles = [t for t in vocab if t not in made]
    if any(len(t) != 1 for t in singles) or len(singles) != 256:
        return False
    ranked = [vocab["".join(p)] for p in pairs]
    if ranked != sorted(ranked) or (ranked and min(ranked) <= max(vocab[t] for t in singles)):
        return False
    encode = Tokenizer.from_file(path).model.tokenize
    return all([t.id for t in encode(token)] == [i] for token, i in vocab.items())


class ByteBpe:
    """Encodes texts one by one; holds the vocabulary and nothing of the texts.

    With ``added`` the file's added tokens are found in texts, as
    ``Tokenizer.encode`` does; otherwise their strings are plain text.
    ``ranked`` is what ``merges_by_rank`` said.
    """

    def __init__(self, path: str, ranked: bool, added: bool):
        spec = _spec(path)
        self.path, self.added, self._slow = path, added, None
        self.strings = [t["content"] for t in spec.get("added_tokens") or ()] if added else []
        self.fast = None
        if ranked:
            import tiktoken

            ranks = {b: i for i, b in _token_bytes(spec).items()}
            self.fast = tiktoken.Encoding(path, pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def slow(self):
        """The tokenizer itself, loaded when a text needs it."""
        if self._slow is None:
            import os

            # Spark runs a worker per core; threads inside one would only compete.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = not self.added
        return self._slow

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.fast is None or any(s in text for s in self.strings):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
