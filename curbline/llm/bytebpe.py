"""Byte-level BPE with the tokenizers library: the byte table, the vocabulary, remembered pieces.

These are helpers that run inside Arrow batches; bpe.py and token_counts.py are the operators.
"""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

REMEMBERED = 200_000  # pieces in each of the two generations of a memo
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # cut into pieces
PLAIN = 0x250  # below it that pattern's classes are the same in every library


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it has a shape, else the
    next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = [], 0x100
    for byte in range(256):
        if byte in shown:
            table.append(chr(byte))
        else:
            table.append(chr(spare))
            spare += 1
    return table


TO_CHAR = byte_alphabet()
TO_BYTE = {char: byte for byte, char in enumerate(TO_CHAR)}


def spelled(data: bytes) -> str:
    return "".join([TO_CHAR[b] for b in data])


def unspelled(token: str) -> bytes:
    return bytes([TO_BYTE[c] for c in token])


def _span_class(kind: str) -> str:
    found = [c for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind]
    return "".join(re.escape(chr(c)) for c in found)


def _plain_pattern() -> re.Pattern:
    letter, digit, blank = _span_class("L"), _span_class("N"), r"\t-\r \x85\xa0"
    return re.compile(
        rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{digit}]+| ?[^{blank}{letter}{digit}]+"
        rf"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


PLAIN_PIECES = _plain_pattern()
UNUSUAL = re.compile(rf"[\x1c-\x1f{chr(PLAIN)}-\U0010ffff]")


class Memo(dict):
    """What `make` gives for a key, remembered for about the last 200,000 to 400,000 keys."""

    def __init__(self, make: Callable, most: int = REMEMBERED):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class RankVocabulary:
    """Encodes and decodes by a file of base64 tokens and ranks.

    Merging goes by the rank of the merged token, as every pair of tokens that adds up to a token
    is a merge with that token's place. A piece that is a token is taken as it is. Text is cut by
    `pattern` first: the usual one by an equal pattern of the standard library where all characters
    are below U+0250, all else by the tokenizers library itself.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        ordered = sorted(ranks, key=ranks.get)
        merges = [
            (spelled(t[:i]), spelled(t[i:]))
            for t in ordered
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        vocab = {spelled(t): r for t, r in ranks.items()}
        self.model = models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0)
        self.usual = pattern == USUAL
        self.splitter = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.memo = Memo(self._piece)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in vocab.items():
            tokens[rank] = unspelled(token)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _piece(self, piece: str) -> bytes:
        tokens = self.model.tokenize(spelled(piece.encode()))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def pieces(self, text: str) -> Iterable[str]:
        if self.usual and UNUSUAL.search(text) is None:
            return PLAIN_PIECES.findall(text)
        return [piece for piece, _ in self.splitter.pre_tokenize_str(text)]

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pieces(text)))

    def decode(self, ids: np.ndarray, step: int = 1 << 20) -> bytes:
        """The bytes of the tokens. Tokens may end inside a character; the bytes join up again."""
        parts = []
        for at in range(0, len(ids), step):
            own = ids[at : at + step]
            lengths = self.lengths[own]
            ends = np.cumsum(lengths)
            shift = np.repeat(self.starts[own] - (ends - lengths), lengths)
            parts.append(self.bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(parts)

    def spans(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and end character of every token. Where a character is split between tokens, all
        of them span it."""
        lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        char = np.cumsum(lead) - 1
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return char[starts], char[ends - 1] + 1


class JsonVocabulary:
    """Token counts as the tokenizers library gives them for its own file format, without special
    tokens added; the strings of added tokens inside texts count as the library counts them.

    For a byte-level vocabulary with the usual cut into pieces, plain text is cut here and each
    piece is given to the library's model once. Any other text, and any other kind of
    vocabulary, is encoded whole by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            kind = json.load(source)
        self.tokenizer = Tokenizer.from_file(path)
        cut_by = kind.get("pre_tokenizer") or {}
        self.known = (
            kind.get("normalizer") is None
            and kind.get("post_processor") is None
            and cut_by.get("type") == "ByteLevel"
            and cut_by.get("use_regex", True)
            and not cut_by.get("add_prefix_space")
            and kind["model"]["type"] == "BPE"
        )
        added = [t["content"] for t in kind.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.memo = Memo(lambda piece: len(self.tokenizer.model.tokenize(spelled(piece.encode()))))

    def count(self, text: str) -> int:
        if self.known and UNUSUAL.search(text) is None and self.added.search(text) is None:
            return sum(map(self.memo.__getitem__, PLAIN_PIECES.findall(text)))
        return len(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)


_loaded: dict[tuple, object] = {}


def loaded(kind: type, *args):
    """One vocabulary per worker process and file."""
    key = (kind.__name__, *args)
    if key not in _loaded:
        _loaded[key] = kind(*args)
    return _loaded[key]
