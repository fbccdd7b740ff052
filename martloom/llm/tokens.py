"""Token ids of whole texts, and flat files of ids in a mounted shared folder."""

from __future__ import annotations

import itertools
import os
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CUT = "\x01"
# White space before a space: there a piece could not be encoded alone.  Or the mark itself.
RUNS = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}] |\\x01"
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏα-ωА-я]"
# Ends of pieces that no merge crosses: one line break between a mark and a letter, and a letter before either.
ENDS = [(f"([.,;:!?]\n)({LETTER})", f"\\1{CUT}\\2"), (f"({LETTER})([.,;:!?\n])", f"\\1{CUT}\\2")]


def load(path: str, plain_specials: bool = False) -> Tokenizer:
    """A tokenizer; with plain_specials its special tokens' strings are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses the cores
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


def width(tokenizer: Tokenizer) -> str:
    """The smallest unsigned type that holds every id."""
    return "<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


class Pieces:
    """Ids of pieces already encoded by this Python worker, kept across batches and tasks.

    Only speed depends on it; it starts anew beyond `most` pieces, so memory is bounded.
    """

    def __init__(self, tokenizer: Tokenizer, most: int = 1_000_000):
        self.tokenizer, self.most = tokenizer, most
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # a byte-level token has a character for each byte
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint16 if width(self.tokenizer) == "<u2" else np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _add(self, pieces: list[str], lines: list[str], sizes: np.ndarray | None) -> None:
        """Encode lines; sizes are the bytes of the pieces that stand in them, None if each line is a piece."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(found), self.flat.dtype, sum(map(len, found)))
        if sizes is None:
            ends = np.cumsum([len(x) for x in found])
        else:
            ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(sizes)) + 1
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces))))
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        self.flat = np.concatenate([self.flat, ids])

    def places(self, pieces: list[str]) -> np.ndarray:
        """The place of each piece; flat[ends[i]:ends[i + 1]] are its ids."""
        if len(self.place) > self.most:
            self.clear()
        joined, alone = [], []
        for piece in pieces:
            if piece not in self.place:
                # Pieces from a space to a letter can stand in one line, as words do.
                (joined if piece[:1] == " " and len(piece) > 1 and not piece[-1].isspace() else alone).append(piece)
        if alone:
            self._add(alone, alone, None)
        if joined:
            sizes = np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in joined), np.int64, len(joined))
            self._add(joined, ["".join(joined[i : i + 500]) for i in range(0, len(joined), 500)], sizes)
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))


def pieces_of(path: str, plain_specials: bool = False) -> Pieces:
    """The pieces known to this process for a tokenizer."""
    kept = sys.modules.setdefault("martloom_llm_pieces", types.ModuleType("martloom_llm_pieces")).__dict__
    if (path, plain_specials) not in kept:
        kept[path, plain_specials] = Pieces(load(path, plain_specials))
    return kept[path, plain_specials]


def encode(known: Pieces, texts: pa.Array, by_spaces: bool = True) -> list[np.ndarray]:
    """Ids of every text of a batch, exactly as the tokenizer encodes the whole text.

    A byte-level BPE never merges across the start of white space nor across the end of a
    run of letters, so a text is the pieces between its spaces, each with its space in
    front and cut after words, and every different piece is encoded once.  Texts with white space before a space, and all texts for
    tokenizers of another kind (by_spaces=False), are encoded whole.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    out: list = [None] * len(texts)
    if by_spaces:
        odd = pc.match_substring_regex(texts, RUNS).to_numpy(zero_copy_only=False)
    else:
        odd = np.ones(len(texts), bool)
    for i in np.flatnonzero(odd):
        ids = known.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids
        out[i] = np.array(ids, known.flat.dtype)
    rest = np.flatnonzero(~odd)
    if len(rest):
        marked = texts.take(pa.array(rest))
        for end, cut in ENDS:
            marked = pc.replace_substring_regex(marked, end, cut)
        pieces = pc.split_pattern(pc.replace_substring(marked, " ", CUT + " "), CUT)
        starts = pieces.offsets.to_numpy()
        starts = starts - starts[0]
        coded = pieces.flatten().dictionary_encode()
        which = known.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        begin, sizes = known.ends[which], known.ends[which + 1] - known.ends[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        tokens = known.flat[np.repeat(begin - ends[:-1], sizes) + np.arange(ends[-1])]
        for k, i in enumerate(rest):
            out[i] = tokens[ends[starts[k]] : ends[starts[k + 1]]]
    return out


def new_file(folder: str, suffix: str) -> str:
    """Path of a file that no other attempt of a task writes."""
    os.makedirs(folder, exist_ok=True)
    return os.path.join(folder, f"{uuid.uuid4().hex}{suffix}")
