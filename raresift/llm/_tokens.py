"""Byte-pair ids of whole texts by the ``tokenizers`` library, with a cache of pieces.

Byte-level BPE never merges across the pieces that its pre-tokenizer cuts, so
a text's ids are its pieces' ids end to end.  Texts are cut before spaces and
around line feeds where a piece surely ends; unknown pieces go through the
library's model once, known ones are looked up by a 64-bit hash.  Texts in
which such a cut isn't sure (runs of white space, special tokens) go through
the tokenizer whole.
"""

from __future__ import annotations

import os

import numpy as np
import regex

from raresift.llm._text import hash_words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_PIECES = 2_000_000

#: The byte-level pre-tokenizer's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def default_tokenizer() -> str:
    """Path of the tokenizer file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts with the tokenizer file at ``path``, special tokens not added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        pre = self.tokenizer.pre_tokenizer
        #: Pieces are only cut for the byte-level pre-tokenizer with its usual pattern.
        self.cuts = (
            isinstance(pre, ByteLevel)
            and not pre.add_prefix_space
            and "use_regex=False" not in repr(pre)
            and self.tokenizer.normalizer is None
            and isinstance(self.tokenizer.model, BPE)
        )
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(PATTERN)
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the known pieces
        self.at = np.zeros(0, np.int64)  # where their ids begin in flat
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _piece(self, piece: str) -> list[int]:
        tokenize = self.tokenizer.model.tokenize
        return [
            t.id
            for word in self.pattern.findall(piece)
            for t in tokenize(word.encode().decode("latin-1").translate(_LETTERS))
        ]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Add pieces, given with their hashes in ascending order."""
        found = [self._piece(p) for p in pieces]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for f in found for i in f), np.uint32, int(size.sum()))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        to = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = (
            np.insert(old, to, new) for old, new in ((self.keys, keys), (self.at, at), (self.size, size))
        )

    def _sure(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text, whether its pieces can be cut."""
        n = len(offsets) - 1
        if not self.cuts:
            return np.zeros(n, bool)
        end = np.zeros(len(data) + 1, bool)
        end[offsets] = True
        after = np.append(data[1:], 0)
        space = _SPACE[data]
        bad = space & _SPACE[after]
        # white space beyond ASCII (lead and second byte), and the space that ends a text
        lead = (data == 0xC2) & ((after == 0x85) | (after == 0xA0))
        lead |= (data == 0xE1) & (after == 0x9A)
        lead |= (data == 0xE2) & ((after == 0x80) | (after == 0x81))
        lead |= (data == 0xE3) & (after == 0x80)
        bad |= lead
        bad &= ~end[1:]
        bad |= (data == 0x20) & end[1:]
        for token in self.special:
            bad |= (data == token[0]) & (after == token[1] if len(token) > 1 else True)
        return np.diff(np.concatenate([[0], np.cumsum(bad)])[offsets]) == 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): ids of all texts end to end (uint32) and n + 1 offsets.

        ``data`` and ``offsets`` are the texts' UTF-8 bytes as ``text_bytes`` gives them.
        """
        if len(self.keys) > CACHE_PIECES:
            self._reset()
        n, sure = len(offsets) - 1, self._sure(data, offsets)
        raw = data.tobytes()
        feed = data == 0x0A
        begins = feed | (data == 0x20)
        begins[1:] |= feed[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        if not sure.all():
            begins &= np.repeat(sure, np.diff(offsets))
        starts = np.flatnonzero(begins)
        first = np.searchsorted(starts, offsets)
        last = np.repeat(offsets[1:], np.diff(first))
        ends = np.minimum(np.append(starts[1:], len(data)), last)
        hashes, where, index = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        to = np.searchsorted(self.keys, hashes)
        fresh = np.ones(len(hashes), bool)
        inside = to < len(self.keys)
        fresh[inside] = self.keys[to[inside]] != hashes[inside]
        if fresh.any():
            self._learn(hashes[fresh], [raw[starts[i] : ends[i]].decode() for i in where[fresh]])
            to = np.searchsorted(self.keys, hashes)
        at, size = self.at[to][index], self.size[to][index]
        done = np.cumsum(size)
        total = int(done[-1]) if len(done) else 0
        ids = self.flat[np.arange(total) + np.repeat(at - (done - size), size)]
        cuts = np.concatenate([[0], done])[first]
        if sure.all():
            return ids, cuts
        parts = [ids[cuts[i] : cuts[i + 1]] for i in range(n)]
        whole = np.flatnonzero(~sure)
        texts = [raw[offsets[i] : offsets[i + 1]].decode() for i in whole]
        for i, e in zip(whole, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            parts[i] = np.asarray(e.ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The task process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
