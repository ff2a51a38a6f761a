"""Byte-level BPE ids. Tokenizers are public files, named by a path and never trained here."""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The same vocabulary for ``tokenizers``, with the tokens added to it.
WITH_ADDED = "byte_bpe_50k.json"
#: Words whose ids a worker keeps at most.
KEPT_WORDS = 400_000


@cache
def encoding(path: str | None = None) -> tiktoken.Encoding:
    """The encoding of a file of ranks; the same ids as those of its ``tokenizers`` form."""
    return tiktoken.Encoding(
        path or "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={}
    )


@cache
def _ranks(path: str | None) -> dict[bytes, int]:
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def token_bytes(path: str | None = None) -> list[bytes]:
    """The bytes of each id."""
    ranks = _ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@cache
def tokenizer() -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(WITH_ADDED))


@cache
def added_tokens() -> dict[str, int]:
    """Texts that are one token wherever they stand, ``<|endoftext|>`` for one, and their ids."""
    return {token.content: number for number, token in tokenizer().get_added_tokens_decoder().items()}


class WordEncoder:
    """Encodes many texts by encoding each of their words once.

    A pre-token can't reach over a space that stands alone before a word, so there texts may be
    cut without changing ids. A text with two white spaces in a row is encoded as it is.
    """

    def __init__(self, path: str | None = None):
        table = token_bytes(path)
        self.encoding = encoding(path)
        # Without its look-ahead, which matters for runs of white space alone, the pattern runs
        # on an automaton.
        self.quick = tiktoken.Encoding(
            "quick",
            pat_str=public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", ""),
            mergeable_ranks=_ranks(path),
            special_tokens={},
        )
        self.opens = np.array([t.startswith(b" ") for t in table])
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain = [not re.search(r"\s\s|\x00", t) for t in texts]
        words = [t.replace(" ", "\x00 ").split("\x00") if p and t else None for t, p in zip(texts, plain)]
        if len(self.index) > KEPT_WORDS:
            self.clear()
        index = self.index
        new = dict.fromkeys(w for each in words if each for w in each if w not in index)
        if new:
            self._add(list(new))
        out = []
        for text, each in zip(texts, words):
            if each is None:
                out.append(np.array(self.encoding.encode_ordinary(text), np.uint32))
                continue
            at = np.fromiter(map(index.__getitem__, each), np.int64, len(each))
            first, size = self.starts[at], self.starts[at + 1] - self.starts[at]
            ends = np.cumsum(size)
            out.append(self.flat[np.arange(ends[-1]) + np.repeat(first - ends + size, size)])
        return out

    def encode_with_added(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text by ``tokenizers``: texts that hold an added token are encoded there."""
        holds = [any(a in t for a in added_tokens()) for t in texts]
        out = self.encode(["" if h else t for t, h in zip(texts, holds)])
        for n in np.flatnonzero(holds):
            out[n] = np.array(tokenizer().encode(texts[n], add_special_tokens=False).ids, np.uint32)
        return out

    def _add(self, new: list[str]) -> None:
        # Words with a space before them can be encoded in one call: each begins with the one
        # token that has the space. Not so if white space ends the word, as at a text's end.
        together = [w[:1] == " " and not w[-1].isspace() for w in new]
        spaced = [w for w, yes in zip(new, together) if yes]
        bare = [w for w, yes in zip(new, together) if not yes]
        ids = np.array(self.quick.encode_ordinary("".join(spaced)), np.uint32)
        begins = np.flatnonzero(self.opens[ids]) if len(ids) else np.zeros(0, np.int64)
        assert len(begins) == len(spaced)
        parts, sizes = [ids], np.diff(np.append(begins, len(ids)))
        more = [np.array(self.quick.encode_ordinary(w), np.uint32) for w in bare]
        sizes = np.concatenate([sizes, np.array([len(m) for m in more], np.int64)])
        for w in (*spaced, *bare):
            self.index[w] = len(self.index)
        self.flat = np.concatenate([self.flat, *parts, *more])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)]).astype(np.int64)


@cache
def word_encoder(path: str | None = None) -> WordEncoder:
    """One for each worker process."""
    return WordEncoder(path)
