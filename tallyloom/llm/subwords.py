"""Subword ids of whole texts with a given public vocabulary."""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

_encoders: dict[tuple[str, str], object] = {}
_spaced: dict[tuple[str, str], np.ndarray] = {}
#: White space that words may hold: it is none of ASCII's.
_ODD = re.compile(r"[^\S ]")


@dataclass(frozen=True)
class Subwords:
    """A byte-level vocabulary: ``ranks`` is its file, ``special`` the text of its end id."""

    ranks: str
    pattern: str
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)

    def _encoder(self):
        """The encoder, made once per worker."""
        key = (self.ranks, self.pattern)
        if key not in _encoders:
            import tiktoken

            with open(self.ranks, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            _encoders[key] = tiktoken.Encoding("given", pat_str=self.pattern, mergeable_ranks=ranks,
                                               special_tokens=dict(self.special))
        return _encoders[key]

    def id_bytes(self, text: bytes | None) -> bytes:
        """Ids of a text, four bytes each; special strings in it are their own ids."""
        if not text:
            return b""
        # ids come as one array: no list of them, and no words to remember
        return self._encoder().encode_to_numpy(text.decode(), allowed_special="all").astype("<u4", copy=False).tobytes()

    def _begins_with_space(self) -> np.ndarray:
        """Of each id, whether its bytes begin with a space."""
        key = (self.ranks, self.pattern)
        if key not in _spaced:
            encoder = self._encoder()
            _spaced[key] = np.zeros(encoder.n_vocab, bool)
            for token in encoder.token_byte_values():
                _spaced[key][encoder.encode_single_token(token)] = token[:1] == b" "
        return _spaced[key]

    def word_ids(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, given one after the other, each after a space, and how many ids
        each word has. They are encoded at once: a piece of text never goes on across a
        single space. Words with other white space are encoded each for itself."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text, alone = b" " + b" ".join(words), []
        if _ODD.search(text.decode()):
            alone = [i for i, word in enumerate(words) if _ODD.search(word.decode())]
            words = list(words)
            own = [np.frombuffer(self.id_bytes(b" " + words[i]), "<u4").astype(np.int64) for i in alone]
            for i in alone:
                words[i] = b"a"
            text = b" " + b" ".join(words)
        ids = np.frombuffer(self.id_bytes(text), "<u4").astype(np.int64)
        begin = np.flatnonzero(self._begins_with_space()[ids])
        sizes = np.diff(np.append(begin, len(ids)))
        if alone:
            parts, at = [], 0
            for i, found in zip(alone, own):
                parts += [ids[at:begin[i]], found]
                at, sizes[i] = begin[i] + sizes[i], len(found)
            ids = np.concatenate([*parts, ids[at:]])
        return ids, sizes
