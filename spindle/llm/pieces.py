"""The fixed public piece vocabulary and its vectorised lattice."""

from __future__ import annotations

import numpy as np

#: Path of the public SentencePiece model (a parameter of the operators; never copied).
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"


def read_pieces(path: str = MODEL_FILE) -> tuple[list[tuple[int, str, float]], dict[int, int]]:
    """Ordinary pieces ``(id, piece, score)`` and the ids of the 256 byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal, byte = [], {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            byte[int(sp.id_to_piece(i)[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            normal.append((i, sp.id_to_piece(i), float(sp.get_score(i))))
    return normal, byte


class Trie:
    """Pieces as a trie whose edges lie in an open-addressing hash table, so
    that many words walk it at once."""

    BITS = 19

    def __init__(self, pieces: list[tuple[int, str]]):
        nodes: dict[tuple[int, int], int] = {}
        self.piece = [-1]
        self.longest = max((len(p) for _, p in pieces), default=1)
        for i, p in pieces:
            node = 0
            for c in p:
                key = (node, ord(c))
                if key not in nodes:
                    nodes[key] = len(self.piece)
                    self.piece.append(-1)
                node = nodes[key]
            self.piece[node] = i
        self.piece = np.asarray(self.piece, np.int32)
        size = 1 << self.BITS
        while size < 4 * len(nodes):
            raise ValueError("the trie is too large for its table")
        self.keys, self.child = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        for (node, c), child in nodes.items():
            key = node << 21 | c
            at = self._slot(np.array([key]))[0]
            while self.keys[at] >= 0:
                at = (at + 1) & (size - 1)
            self.keys[at], self.child[at] = key, child

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Child by character; 0 where there is none."""
        key = (node.astype(np.int64) << 21) | code.astype(np.int64)
        at = self._slot(key)
        found = self.keys[at]
        out = np.where(found == key, self.child[at], 0)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.child[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


def code_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words as a zero-padded matrix, and their lengths."""
    n = np.fromiter((len(w) for w in words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros((len(words), int(n.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < n[:, None]] = flat
    return out, n


def edges(trie: Trie, codes: np.ndarray, n: np.ndarray):
    """Yield ``(start, end, words, piece ids)``; each word at most once in a
    step, starts ascending.  A character that is no piece by itself gets an
    edge of id -1."""
    for start in range(codes.shape[1]):
        at = np.flatnonzero(n > start)
        node = np.zeros(len(at), np.int32)
        for end in range(start + 1, min(start + trie.longest, codes.shape[1]) + 1):
            node = trie.step(node, codes[at, end - 1])
            piece = trie.piece[node]
            if end == start + 1:
                yield start, end, at, np.where(node > 0, piece, -1)
            else:
                some = piece >= 0
                if some.any():
                    yield start, end, at[some], piece[some]
            go = (node > 0) & (n[at] > end)
            at, node = at[go], node[go]
            if not len(at):
                break


class Cutter:
    """Cuts texts where no piece can cross: between two characters that stand
    side by side in no piece.  The best path of a text is that of its units."""

    def __init__(self, pieces: list[str]):
        pairs = {(ord(a), ord(b)) for p in pieces for a, b in zip(p, p[1:])}
        chars = sorted({c for ab in pairs for c in ab})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[chars] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            self.joined[self.number[a], self.number[b]] = True

    def units(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Starts of the units of all texts; ``first``: where texts start."""
        k = self.number[codes]
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.joined[k[:-1], k[1:]]
        cut[first[first < len(codes)]] = True
        return np.flatnonzero(cut)
