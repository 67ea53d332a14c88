"""Read a SentencePiece model file without the library that wrote it.

The file is one protocol-buffer message. Only the fields the encoders need are decoded:
pieces (text, score, kind), the model kind, byte fallback, the normaliser's switches and
its compiled character map.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

MARKER = "▁"  # stands for a space

# Fixed values of the file format: kinds of pieces and kinds of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    character_map: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            if wire == 2:
                size, at = _varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"wire type {wire} in a model file")
            value, at = data[at : at + size], at + size
        yield number, value


def _piece(data: bytes) -> tuple[str, float, int]:
    text, score, kind = "", 0.0, NORMAL
    for number, value in _fields(data):
        if number == 1:
            text = value.decode()
        elif number == 2:
            score = struct.unpack("<f", value)[0]
        elif number == 3:
            kind = value
    return text, score, kind


def parse_model(data: bytes) -> PieceModel:
    """Decode a model file's bytes."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            model.pieces.append(_piece(value))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 35:
                    model.byte_fallback = bool(v)
                elif n == 40:
                    model.unk_id = v
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.character_map = v
                elif n == 3:
                    model.add_dummy_prefix = bool(v)
                elif n == 4:
                    model.remove_extra_whitespaces = bool(v)
                elif n == 5:
                    model.escape_whitespaces = bool(v)
    return model


def load_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return parse_model(file.read())
