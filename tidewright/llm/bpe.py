"""Byte-level BPE with an existing vocabulary: merges over arrays of symbols, for many pieces at once."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

#: Where the vocabulary files of public tokenizers lie; a parameter of every operator that counts tokens.
TOKENIZERS = os.environ.get("TIDEWRIGHT_TOKENIZERS", "/opt/tokenizers")
RANKS = "byte_bpe_50k.tiktoken"

#: The pre-split pattern that belongs to the rank files, for Python's regex module. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = r"\t-\r\x{1C}-\x{1F}\x{85}\p{Z}"
#: The same for the JVM, with the Unicode blanks spelt out.
JVM_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"

_NEVER = np.int64(1 << 40)


class Ranks:
    """Merge ranks of a vocabulary, as a sorted table of symbol pairs."""

    def __init__(self, path: str):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.rank[base64.b64decode(token)] = int(rank)
        pairs = [
            (self.rank[token[:cut]] << 32 | self.rank[token[cut:]], rank)
            for token, rank in self.rank.items()
            for cut in range(1, len(token))
            if token[:cut] in self.rank and token[cut:] in self.rank
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair, self.merged = table[:, 0].copy(), table[:, 1].copy()
        self.byte = np.array([self.rank.get(bytes([b]), 0) for b in range(256)], np.int64)
        #: True for two bytes that stand side by side in some token; no merge ever crosses any other boundary.
        self.inner = np.zeros(1 << 16, bool)
        for token in self.rank:
            codes = np.frombuffer(token, np.uint8).astype(np.int64)
            self.inner[codes[:-1] << 8 | codes[1:]] = True

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], _NEVER)

    def _joined(self, symbol: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Merge ranks of the pairs that begin at ``at``."""
        after = np.minimum(at + 1, len(symbol) - 1)
        found = self._lookup(symbol[at], symbol[after])
        return np.where((after > at) & (owner[after] == owner[at]), found, _NEVER)

    def count_one(self, piece: bytes) -> int:
        """Tokens of one piece, one merge at a time (leftmost of the lowest rank): linked symbols and a heap."""
        import heapq

        symbol = [self.rank.get(bytes([b]), 0) for b in piece]
        names = [bytes([b]) for b in piece]
        after, before, alive = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1)), [True] * len(piece)
        heap: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(symbol):
                joined = names[i] + names[after[i]]
                if joined in self.rank:
                    heapq.heappush(heap, (self.rank[joined], i, joined))

        for i in range(len(symbol) - 1):
            offer(i)
        left = len(symbol)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if not alive[i] or after[i] >= len(symbol) or names[i] + names[after[i]] != joined:
                continue
            gone = after[i]
            names[i], alive[gone], after[i] = joined, False, after[gone]
            if after[i] < len(symbol):
                before[after[i]] = i
            left -= 1
            offer(i)
            offer(before[i])
        return left

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece.

        The pieces lie side by side as one symbol array, cut at the boundaries that no token crosses. Each round joins all
        adjacent pairs with the merge ranks and applies, in every part, the pairs of its lowest rank; parts without a
        mergeable pair leave. Merging several pairs of one rank at once equals one at a time unless a lower rank appears
        afterwards; such parts are counted one merge at a time.
        """
        length = np.array([len(p) for p in pieces], np.int64)
        code = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        if not len(code):
            return np.zeros(len(pieces), np.int64)
        piece = np.repeat(np.arange(len(pieces)), length)
        new = np.ones(len(code), bool)
        new[1:] = (piece[1:] != piece[:-1]) | ~self.inner[code[:-1] << 8 | code[1:]]
        start = np.append(np.flatnonzero(new), len(code))
        parts = len(start) - 1
        total = np.zeros(parts, np.int64)
        exact: set[int] = set()
        symbol, owner = self.byte[code], np.cumsum(new) - 1
        last = np.full(parts, -1, np.int64)
        several = np.zeros(parts, bool)
        rank = self._joined(symbol, owner, np.arange(len(symbol)))
        while len(symbol):
            begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, begin)
            size = np.diff(np.append(begin, len(symbol)))
            who = owner[begin]
            done = lowest == _NEVER
            total[who[done]] = size[done]
            odd = ~done & several[who] & (lowest < last[who])
            exact.update(who[odd].tolist())
            last[who] = lowest
            stay = np.repeat(~done & ~odd, size)
            hit = stay & (rank == np.repeat(lowest, size))
            # of overlapping equal pairs (aaa) every second one merges, from the left
            at = np.flatnonzero(hit)
            if len(at):
                chain = np.flatnonzero(np.r_[True, np.diff(at) != 1])
                odd_place = (np.arange(len(at)) - np.repeat(chain, np.diff(np.append(chain, len(at))))) % 2
                at = at[odd_place == 0]
            several[who] = np.bincount(owner[at], minlength=parts)[who] > 1
            symbol[at] = rank[at]
            keep = stay
            keep[at + 1] = False
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            # only pairs beside a merge have another rank now
            moved = (np.cumsum(keep) - 1)[at]
            near = np.concatenate([moved[moved > 0] - 1, moved])
            rank[near] = self._joined(symbol, owner, near)
        for i in exact:
            total[i] = self.count_one(code[start[i] : start[i + 1]].astype(np.uint8).tobytes())
        return np.bincount(piece[start[:-1]], weights=total, minlength=len(pieces)).astype(np.int64)


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


class Counter:
    """Token counts of distinct pieces, with a bounded memory of the pieces seen by this worker."""

    MOST_PIECES = 1_000_000

    def __init__(self, path: str):
        self.ranks, self.known = ranks(path), {}

    def __call__(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        fresh = [p for p in pieces if p not in known]
        if len(known) + len(fresh) > self.MOST_PIECES:
            known.clear()
            fresh = pieces
        if fresh:
            known.update(zip(fresh, self.ranks.count([p.encode("utf-8", "replace") for p in fresh]).tolist()))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def vocabulary_path(tokenizers: str | None = None, name: str = RANKS) -> str:
    return os.path.join(tokenizers or TOKENIZERS, name)
