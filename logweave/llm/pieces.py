"""Pieces of a SentencePiece BPE model.

In a model whose pieces have the word mark only in front, no piece reaches from
one word into the next: a text may be cut before any mark that follows another
character, and the parts have the pieces of the whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import sentencepiece as spm
from sentencepiece import sentencepiece_model_pb2 as model_pb2

MARK = "▁"


def read_model(path: str) -> bytes:
    """The model's bytes (half a megabyte), read once on the driver."""
    with open(path, "rb") as file:
        return file.read()


class Pieces:
    """Encodes marked text exactly as the model does, and decodes ids."""

    def __init__(self, model: bytes):
        proto = model_pb2.ModelProto()
        proto.ParseFromString(model)
        normal = [p.piece for p in proto.pieces if p.type == 1]
        spec = proto.normalizer_spec
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in normal) or \
                spec.precompiled_charsmap or spec.remove_extra_whitespaces or \
                not spec.add_dummy_prefix or not spec.escape_whitespaces or \
                proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("needs a BPE model with byte fallback, an identity "
                             "normaliser and word marks in front only")
        self.names = [p.piece for p in proto.pieces]
        self.bytes = [int(p.piece[3:5], 16) if p.type == 6 else -1 for p in proto.pieces]
        self.byte_id = {b: i for i, b in enumerate(self.bytes) if b >= 0}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.longest = max(map(len, normal))
        self.dtype = np.dtype(np.uint16 if len(self.names) <= 1 << 16 else np.uint32)
        # A byte below 128 is a character by itself.
        self.shown = [chr(b) if 0 <= b < 128 else n
                      for n, b in zip(self.names, self.bytes, strict=True)]
        self.partial = np.array([b >= 128 for b in self.bytes])
        # Words come with their marks; the model must not add one.
        proto.normalizer_spec.add_dummy_prefix = False
        self.library = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def encode(self, marked: str) -> np.ndarray:
        """Ids of a marked text, or of a part of one between two words."""
        return np.array(self.library.encode(marked, num_threads=1), self.dtype)

    def decode(self, ids: np.ndarray) -> str:
        """Text with marks turned into blanks; bytes that aren't UTF-8 become
        replacement characters."""
        listed = ids.tolist()
        if not self.partial[ids].any():
            return "".join(map(self.shown.__getitem__, listed)).replace(MARK, " ")
        out, held = [], bytearray()
        for i in listed:
            if self.bytes[i] >= 0:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.names[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")


@lru_cache(2)
def pieces_of(model: bytes) -> Pieces:
    """One encoder a worker and model."""
    return Pieces(model)
