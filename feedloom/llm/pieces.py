"""A piece vocabulary as lattice edges, shared by lattice likelihood and N-best segmentation."""

from __future__ import annotations

from dataclasses import dataclass, field

from feedloom.llm.common import TOKENIZERS, per_worker, sentence_pieces

SPACE = "▁"  # What a space is in pieces.
#: A raw U+2581 of a text stands for itself, not for a space: it becomes this character, which no
#: text and no piece holds, and so falls back to its bytes.
RAW = "\ud800"


@dataclass
class Pieces:
    """Ids of the ordinary pieces and of the 256 byte pieces, with the file's own scores."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    size: int
    texts: list[bytes] = field(repr=False)

    def __post_init__(self):
        self.prefixes = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.unknown = min(self.scores.values(), default=0.0) - 10.0
        #: No piece goes on after a space that follows another character, nor holds a line end:
        #: every segmentation then has a boundary before each run of spaces and around line ends.
        self.breaks = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids)

    def edges(self, values: dict[str, float]) -> dict[str, float | None]:
        """Value of each piece, None for what only begins pieces."""
        return {p: values.get(p) for p in self.prefixes}


def prepared(text: str) -> str:
    return text.replace(SPACE, RAW).replace(" ", SPACE)


def raw_bytes(char: str) -> bytes:
    return (SPACE if char == RAW else char).encode("utf-8", "replace")


def load_pieces(folder: str = TOKENIZERS) -> Pieces:
    def load():
        sp = sentence_pieces(folder)
        ids, byte_ids = {}, [0] * 256
        out = [b""] * sp.get_piece_size()
        for k in range(sp.get_piece_size()):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                byte_ids[int(piece[3:5], 16)] = k
                out[k] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                ids[piece] = k
                out[k] = piece.replace(SPACE, " ").encode()
        scores = {p: sp.get_score(k) for p, k in ids.items()}
        return Pieces(ids, scores, byte_ids, sp.get_piece_size(), out)

    return per_worker(("lattice", folder), load)
