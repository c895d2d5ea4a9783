"""Token ids of a public byte-pair tokenizer file, for many texts, faster than its own library but with the same ids.

The tokenizer drops white space, so a text's ids are those of its chunks between ASCII white space, joined. Ids of chunks
of up to LONGEST bytes are kept in a bounded cache. Chunks not in it are cut into words and encoded together, by a byte-pair encoder that merges by rank of
the merged bytes; a closing byte stands for the vocabulary's word end. Both ways give the same ids where each
vocabulary entry, encoded alone, is itself one token: if two neighbouring tokens' union were an entry but not by the listed
pair, the entry alone would pass the same state and end there, too. tests/llm checks this for the whole vocabulary.
Chunks with characters beyond Latin, controls or special tokens go through the tokenizers library itself.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from faultline.llm.common import LONGEST

WORD_END = "</w>"
CLOSE = "\x01"
#: Characters for which the letters and numbers of Unicode are the ranges below.
_PLAIN = re.compile(r"[\n\x21-\x7e¡-įı-ɏ]*")
_LETTERS, _NUMBERS = "a-zA-ZªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\n{_LETTERS}{_NUMBERS}]+|\n")
_SPECIAL = "<|"


def byte_of_letter() -> dict[str, int]:
    """The bytes behind the letters of a byte-level vocabulary: printable ones are themselves, the others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by a tokenizer file of lower-cased byte-level byte-pairs with word ends."""

    def __init__(self, path: str, most: int = 200_000):
        self.library = Tokenizer.from_file(path)
        model = json.loads(open(path, encoding="utf-8").read())["model"]
        letters = byte_of_letter()

        def raw(token: str) -> bytes:
            end = token.endswith(WORD_END) and token != WORD_END
            body = token[: -len(WORD_END)] if end else token
            return bytes(letters[c] for c in body) + (CLOSE.encode() if end else b"")

        merged = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        names = {bytes([b]): c for c, b in letters.items()}
        names |= {bytes([b]) + CLOSE.encode(): c + WORD_END for c, b in letters.items()}
        names |= {raw(a + b): a + b for a, b in merged}
        self.ids = np.array([model["vocab"][x] for x in names.values()], np.uint32)
        ranks = {x: i for i, x in enumerate(names)}
        self.newline = ranks[b"\n"]
        self.pairs = tiktoken.Encoding("words", pat_str=rf"[^\n{CLOSE}]+{CLOSE}|\n", mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[bytes, bytes] = {}
        self.most = most

    def _learn(self, chunks: list[bytes]) -> None:
        text = b"\n".join(chunks).decode()
        if not _PLAIN.fullmatch(text) or _SPECIAL in text:
            plain = []
            for chunk in chunks:
                text = chunk.decode()
                if _PLAIN.fullmatch(text) and _SPECIAL not in text:
                    plain.append(chunk)
                else:
                    self.cache[chunk] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            chunks, text = plain, b"\n".join(plain).decode()
        marked = CLOSE.join(_WORDS.findall(text.lower())) + CLOSE + "\n"
        found = np.asarray(self.pairs.encode_ordinary(marked), np.uint32)
        stops = 4 * np.flatnonzero(found == self.newline)
        data = self.ids[found].tobytes()
        for chunk, start, stop in zip(chunks, [0, *(stops + 4).tolist()], stops.tolist()):
            self.cache[chunk] = data[start:stop]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """For each text its ids, as unsigned 32-bit little-endian numbers; none for null."""
        split = [(t or b"").split() for t in texts]
        if len(self.cache) >= self.most:
            self.cache.clear()
        if new := set().union(*split).difference(self.cache):
            self._learn(list(new))
        get = self.cache.__getitem__
        found = [b"".join(map(get, chunks)) for chunks in split]
        for chunk in new:
            if len(chunk) > LONGEST:
                del self.cache[chunk]
        return found


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a file; it stays for later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
