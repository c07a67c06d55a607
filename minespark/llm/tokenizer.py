"""A public byte-level BPE, loaded once per Python worker."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import regex
import tiktoken

#: Folder of the public vocabularies; a parameter everywhere, never copied.
FOLDER = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
#: Pre-splitting of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The characters of White_Space, which \s means in the encoder; Python's differs by a few control characters.
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class ByteBpe:
    """Encodes text, or the bytes of one unsplit piece."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self._enc = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()}
        own = PATTERN.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.split = regex.compile(own)
        self.white_end = regex.compile(f"[{WHITE}]$")

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text; strings of special tokens are ordinary text."""
        return self._enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of bytes that are merged as one piece, without pre-splitting."""
        return self._enc._encode_single_piece(piece) if piece else []


@lru_cache(maxsize=4)
def load(name: str = "byte_bpe_50k", folder: str = FOLDER) -> ByteBpe:
    return ByteBpe(os.path.join(folder, f"{name}.tiktoken"))
