"""Ids of texts under a word-end BPE vocabulary, made once per distinct word.

The vocabulary's normaliser and pre-tokenizer never join anything across white
space, so a text's ids are those of its words (parts between spaces or line
feeds) in turn. Words of plain Latin letters and ASCII signs go many at once
through a rank table made from the same file: the end of a pre-token is written
as one capital letter, which no lower-cased word holds, so that the ids are the
vocabulary's own (tests compare with the library). All other words are encoded
by the library itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

# --- fixed values: the pre-tokenizer's pattern, for lower-cased plain words -----
PRE_TOKEN = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^ a-z0-9ß-öø-ſ]+"
WORD_END = "</w>"
# -----------------------------------------------------------------------------
# ASCII signs and precomposed Latin letters whose lower case is one letter.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
_PIECE = re.compile(PRE_TOKEN)
_END = "A"
# Distinct words one encoder remembers before it starts anew.
REMEMBERED = 400_000


def _byte_names() -> dict[str, int]:
    """Character that stands for a byte in the vocabulary -> that byte: printable
    bytes stand for themselves, the others for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class WordIds:
    """Texts -> ids as little-endian unsigned integers of ``dtype``."""

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        with open(vocabulary, encoding="utf-8") as f:
            names = json.load(f)["model"]["vocab"]
        byte = _byte_names()
        end = _END.encode()
        ranks = {}
        for name, n in names.items():
            word = name.removesuffix(WORD_END)
            ranks[bytes(byte[c] for c in word) + (end if word != name else b"")] = n
        self.space = ranks[b" "]
        self.ranked = tiktoken.Encoding("words", pat_str=f"[^{_END} ]+{_END}| ", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {"": b""}

    def _whole(self, word: str) -> bytes:
        return np.array(self.library.encode(word, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known = {"": b""}
        plain = [w for w in words if _PLAIN.fullmatch(w) and "<|" not in w]
        self.known.update((w, self._whole(w)) for w in words.difference(plain))
        if plain:
            marked = _PIECE.sub(rf"\g<0>{_END}", " ".join(plain).lower())
            ids = np.array(self.ranked.encode_ordinary(marked), dtype=np.int64)
            cuts = np.flatnonzero(ids == self.space)
            flat, size = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            starts, ends = np.append(0, cuts + 1) * size, np.append(cuts, len(ids)) * size
            self.known.update((w, flat[a:b]) for w, a, b in zip(plain, starts.tolist(), ends.tolist(), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        words = set().union(*split)
        # words of this call are learned even if older ones have to be forgotten for them
        if not words <= self.known.keys():
            new = words.difference(self.known)
            if len(self.known) + len(new) > REMEMBERED:
                new = words
            self._learn(new)
        known = self.known
        return [b"".join(map(known.__getitem__, own)) for own in split]
