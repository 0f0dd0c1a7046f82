"""Token ids of the public byte-level BPE vocabulary, as packed little-endian bytes.

The vocabulary file is a parameter (default: the 50k byte-level BPE of
``public_tokenizers``). Its rank form gives the ids of the ``tokenizers`` file and is
several times faster; the tests hold one against the other. Texts are first cut at the
tokens that the ``tokenizers`` file adds to the vocabulary, which have ids of their own, and
each stretch between them is encoded by one call. A table of the words seen so far would
save time only while few words are new.
"""

from __future__ import annotations

import base64
import json
import re
import struct
from functools import lru_cache


class ByteBpe:
    def __init__(self, ranks_file: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.added = {t: struct.pack("<I", i) for t, i in (added or {}).items()}
        # a match per added token, the longer first; never matches without any
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")

    def pack(self, text: str) -> bytes:
        """Ids of the whole text as unsigned little-endian 32-bit integers."""
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self._pack_plain(text[at:m.start()]), self.added[m.group()]]
            at = m.end()
        return b"".join([*out, self._pack_plain(text[at:])]) if out else self._pack_plain(text)

    def _pack_plain(self, text: str) -> bytes:
        ids = self.encoding.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def byte_bpe(ranks_file: str | None = None, pattern: str | None = None, tokenizer_file: str | None = None) -> ByteBpe:
    """The encoder of a rank file; ``tokenizer_file`` names the file whose added tokens count
    (default: that of the default ranks, none for other ranks)."""
    import public_tokenizers

    if tokenizer_file is None and ranks_file is None:
        tokenizer_file = public_tokenizers.path("byte_bpe_50k.json")
    added = {}
    if tokenizer_file is not None:
        with open(tokenizer_file, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return ByteBpe(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN, added)
