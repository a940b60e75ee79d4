"""Token ids as the ``tokenizers`` library gives them, at the speed the data needs.

:class:`Encoder` loads a tokenizer file. Byte-level BPE files of the usual form also get a twin in ``tiktoken``, built from
the same vocabulary and about five times as fast: merging the pair of lowest id first is the same as applying the merges
in order when ids rise with the merges, which is checked on loading. ``tests/llm`` compares both on every code point.
Files of another form are encoded by the library alone.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

# The pre-tokenization that byte-level BPE uses (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _twin(spec: dict):
    """A ``tiktoken`` encoding of the same ids, or None where the file has features it lacks."""
    import tiktoken

    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
        and spec["normalizer"] is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
    )
    if not plain or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"]["".join(p)] for p in pairs]
    added = {a["content"]: a["id"] for a in spec["added_tokens"]}
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    if made != sorted(set(made)) or any(bytes([b]) not in ranks for b in range(256)) or len(ranks) != 256 + len(made):
        return None
    return tiktoken.Encoding("twin", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=added)


class Encoder:
    """``path``: a ``tokenizers`` file. Added tokens inside a text are recognised, as is the library's default."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, processors

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.twin = _twin(spec)
        self.longest_added = max([0, *(len(a["content"]) for a in spec["added_tokens"])])
        if self.twin:  # offsets of whole pieces, leading blanks included; ids stay the same
            self.library.post_processor = processors.ByteLevel(trim_offsets=False)

    def ids(self, text: str) -> np.ndarray:
        if self.twin:
            try:
                return self.twin.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                # the twin's expression gives up on about a million blanks in a row; the library does not
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    @property
    def can_splice(self) -> bool:
        """Word starts depend on the text from there on only, so encodings of overlapping chunks can be joined."""
        return self.twin is not None

    def word_starts(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Code-point offsets of the starts of pre-tokens, the tokens before each, and all tokens."""
        found = self.library.encode(text, add_special_tokens=False)
        if not len(found):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        words = np.array(found.word_ids, dtype=np.int64)
        first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
        offsets = found.offsets
        return np.array([offsets[i][0] for i in first], dtype=np.int64), first, len(words)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)
