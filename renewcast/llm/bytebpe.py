"""The byte-level BPE vocabulary: ids of texts, and the bytes of ids.

The public rank file and the library's JSON file hold the same vocabulary; ids are made from the ranks, which is
several times faster, and are those of the ``tokenizers`` library (tests/llm/test_packing.py compares them).  What
the rank library refuses (its pattern gives up on endless runs of white space) is encoded by ``tokenizers``.
"""
from __future__ import annotations

import base64
import os

import public_tokenizers

RANKS, JSON = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
END = "<|endoftext|>"


class ByteBpe:
    """plain: the special token's string in a text is ordinary text, else it is that token."""

    def __init__(self, plain: bool, ranks: str = RANKS, json: str = JSON):
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={END: len(table)})
        self.bytes = [b""] * (len(table) + 1)
        for raw, k in table.items():
            self.bytes[k] = raw
        self.bytes[len(table)] = END.encode()
        self.plain, self.json, self.library = plain, json, None

    def _slow(self, text: str) -> list[int]:
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(public_tokenizers.path(self.json))
            self.library.no_truncation()
            self.library.no_padding()
            self.library.encode_special_tokens = self.plain
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        try:
            return self.coder.encode_ordinary(text) if self.plain else self.coder.encode(text, allowed_special="all")
        except BaseException as refused:  # The library panics where its pattern gives up; that is no Exception.
            if isinstance(refused, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self._slow(text)
