"""Ids of a byte-level pair model: whole texts from held ids of their chunks.

A chunk is a run of blanks and the run of other characters behind it. The model's own split
pattern never takes a blank behind another character into one match, so a text's ids are its
chunks' ids in a row. Texts with rarer white space or a special token's string are encoded whole
by the library instead.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

#: Chunks whose ids a worker holds at once; a full store is emptied.
HELD_CHUNKS = 600_000
HELD_LENGTH = 64
CHUNKS = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space beyond blank, tab and line ends, where a chunk's end may fall inside a match.
RARE_SPACE = "\x0b\x0c\x1c-\x1f\x85\xa0  -     　"


class ChunkEncoder:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        model = json.loads(open(path, encoding="utf-8").read())
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        ids = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        pre = model["pre_tokenizer"]
        if model["normalizer"] is not None or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or ids != sorted(ids):
            raise ValueError("a byte-level model without normalizer is expected, its merges in the order of their ids")
        self.special = [x["content"] for x in model["added_tokens"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.encode = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.odd = re.compile("|".join([f"[{RARE_SPACE}]", *map(re.escape, self.special)])).search
        self.held: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        ids = np.array(self.encode(chunk), dtype="<u4").tobytes()
        if len(chunk) <= HELD_LENGTH:
            if len(self.held) >= HELD_CHUNKS:
                self.held.clear()
            self.held[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers, without begin or end."""
        if self.odd(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        held, chunk = self.held.get, self._chunk
        return b"".join([held(c) or chunk(c) for c in CHUNKS.findall(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)
