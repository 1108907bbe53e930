"""The pieces of a public SentencePiece model."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    """Ordinary pieces with ids and scores; byte pieces by value."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: tuple[int, ...]
    size: int
    unknown: int


@functools.cache
def load(path: str = MODEL) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, raw = {}, {}, [-1] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            raw[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i)):
            ids[piece], scores[piece] = i, model.get_score(i)
    return Pieces(ids, scores, tuple(raw), model.get_piece_size(), model.unk_id())


def prefixes(words) -> dict[str, int]:
    """Every proper prefix of the given strings, as a dict that tells where a search may go on."""
    return {w[:n]: 1 for w in words for n in range(1, len(w))}


def codes_of(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Numbers:
    """Whole numbers of 0 or more to values, for arrays of them: open addressing, a few probes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing):
        bits = max(4, (4 * len(keys) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.missing, self.keys = missing, np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, missing, values.dtype)
        slot, left, self.probes = self._slot(keys), np.arange(len(keys)), 1
        while True:
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            left = left[self.keys[slot[left]] != keys[left]]
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key; of another key the one for missing."""
        slot = self._slot(keys)
        out, left = self.values[slot], np.flatnonzero(self.keys[slot] != keys)
        if len(left):
            slot, own = slot[left], keys[left]
            out[left] = self.missing
            for _ in range(1, self.probes):
                slot = (slot + 1) & self.mask
                here = self.keys[slot]
                hit = here == own
                out[left[hit]] = self.values[slot[hit]]
                go = ~hit & (here >= 0)
                left, slot, own = left[go], slot[go], own[go]
                if not len(left):
                    break
        return out


class Trie:
    """Strings as a machine in arrays: state 0 is the start; ``next`` leads on from (state, character);
    a state with ``final`` of 0 or more is the end of that string."""

    def __init__(self, ids: dict[str, int]):
        letters = sorted({c for p in ids for c in p})
        self.size = max(1, len(letters))
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        number = {c: i for i, c in enumerate(letters)}
        states, final, arcs = {"": 0}, [-1], []
        for piece, i in ids.items():
            state = 0
            for n in range(1, len(piece) + 1):
                after = states.setdefault(piece[:n], len(states))
                if after == len(final):
                    final.append(-1)
                    arcs.append((state * self.size + number[piece[n - 1]], after))
                state = after
            final[state] = i
        keys, after = np.array(sorted(arcs), np.int64).reshape(-1, 2).T.copy()
        self.final, self.next = np.array(final, np.int32), Numbers(keys, after, -1)
        self.more = np.zeros(len(final), bool)
        self.more[keys // self.size] = True
        self.first = np.full(self.size + 1, -1)  # from the start, and -1 for other characters
        self.first[keys[keys < self.size]] = after[keys < self.size]

    def arcs(self, letters: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every string found: where it starts, where it ends and which it is. ``ends`` has, for each
        letter, the end of its part of the text, which no string crosses."""
        start = np.arange(len(letters))
        state = self.first[letters]
        start, state = start[state >= 0], state[state >= 0]
        at, found = start + 1, []
        while len(start):
            piece = self.final[state]
            hit = piece >= 0
            found.append((start[hit], at[hit], piece[hit]))
            go = self.more[state] & (at < ends[start])
            start, state, at = start[go], state[go], at[go]
            letter = letters[at]
            state = np.where(letter >= 0, self.next.get(np.maximum(state * self.size + letter, 0)), -1)
            go = state >= 0
            start, state, at = start[go], state[go], at[go] + 1
        empty = np.empty(0, np.int64)
        return tuple(np.concatenate([empty, *x]) for x in zip(*found)) if found else (empty, empty, empty)
