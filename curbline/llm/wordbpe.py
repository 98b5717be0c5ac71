"""Ids of a word-end BPE vocabulary, with the ids of every piece remembered per worker.

A helper that runs inside Arrow batches; packing.py is the operator.
"""

from __future__ import annotations

import json
import re

import numpy as np

from .bytebpe import Memo, UNUSUAL, _span_class, spelled

# fixed values: how the vocabulary's file says that text is prepared
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _plain_words() -> re.Pattern:
    """The same cut by the standard library, for text of plain characters only."""
    letter, digit, blank = _span_class("L"), _span_class("N"), r"\t-\r \x85\xa0"
    return re.compile(rf"[{letter}]+|'(?:[stmd]|re|ve|ll)|[{digit}]|[^{blank}{letter}{digit}]+")


PLAIN_WORDS = _plain_words()


class WordVocabulary:
    """Ids as the tokenizers library gives them for its own file, without added special tokens.

    Where the file asks for the usual preparation, a text whose lower case holds nothing from U+0250
    on and none of the file's added tokens is cut here, and each word is given to the library's
    model once: such text is its own composed form, and white space between words is
    dropped whatever it is. Any other text, and any other file, is encoded by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            kind = json.load(source)
        self.tokenizer = Tokenizer.from_file(path)
        steps = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        self.known = (
            (kind.get("normalizer") or {}).get("normalizers") == NORMAL
            and kind.get("post_processor") is None
            and steps[0].get("pattern") == {"Regex": CUT}
            and steps[0].get("behavior") == "Removed"
            and steps[0].get("invert") is True
            and [s.get("type") for s in steps[1:]] == ["ByteLevel"]
            and not steps[1].get("add_prefix_space")
            and not steps[1].get("use_regex", True)
            and kind["model"]["type"] == "BPE"
        )
        added = [t["content"] for t in kind.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.memo = Memo(self._word)

    def _word(self, word: str) -> bytes:
        return np.array([t.id for t in self.tokenizer.model.tokenize(spelled(word.encode()))], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        lower = text.lower()
        if self.known and UNUSUAL.search(lower) is None and UNUSUAL.search(text) is None and self.added.search(text) is None:
            return b"".join(map(self.memo.__getitem__, PLAIN_WORDS.findall(lower)))
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, "<u4").tobytes()
