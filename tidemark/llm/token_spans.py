"""Tokens of two tokenizers over the same bytes, coalesced into groups and expanded into links.

Runs inside tasks and imports nothing of the package, so it travels with the job.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# How the byte-level vocabulary file writes bytes and splits words, and how the piece vocabulary writes space and bytes.
PLAIN_BYTES = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"


class Bytes:
    """A byte-level vocabulary file of the tokenizers library; its merges are applied by tiktoken, which is faster."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        others = [b for b in range(256) if b not in PLAIN_BYTES]
        byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {x["content"] for x in read["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in read["model"]["vocab"].items() if token not in special}
        self.known = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(read["model"]["vocab"].values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.asarray(self.known.encode_ordinary(" " + x), np.int64) for x in texts]


class Pieces:
    """A piece vocabulary file of the sentencepiece library, which puts a space before each text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.known = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.known.get_piece_size()
        names = [self.known.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.known.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.asarray(x, np.int64) for x in self.known.encode(list(texts), num_threads=1)]


class Aligned(NamedTuple):
    """Of each text: tokens, groups and links, the digest of its groups, its distinct pairs of ids (where they begin), and how often each occurs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    sha: list[str]
    starts: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


class Aligner:
    """Aligns batches of texts; a pair of ids is written as one number, ``a * wide + b``."""

    def __init__(self, a: Bytes, b: Pieces) -> None:
        self.sides = (a, b)
        self.lengths = [np.array([len(x) for x in s.bytes], np.int64) for s in self.sides]
        self.wide = len(b.bytes)
        # what follows an id: another of its side, the other side, another group, or nothing
        size = max(len(a.bytes), len(b.bytes))
        self.words = np.array([[f"{i}{mark}" for i in range(size)] for mark in (",", "|", ";", "")], object)

    def whole(self, ids: np.ndarray, side: int, line: bytes) -> bool:
        """Whether the tokens' bytes joined are the line."""
        return self.lengths[side][ids].sum() == len(line) and b"".join(map(self.sides[side].bytes.__getitem__, ids.tolist())) == line

    def align(self, texts: Sequence[str | None]) -> Aligned:
        count = len(texts)
        asked = [i for i, x in enumerate(texts) if x]
        both = [side.ids([texts[i] for i in asked]) for side in self.sides]
        kept, ids, starts, ends, sides, owner, base = [], [], [], [], [], [], 0
        for i, *found in zip(asked, *both):
            line = b" " + texts[i].encode()
            if not all(self.whole(x, side, line) for side, x in enumerate(found)):
                continue
            kept.append(i)
            for side, x in enumerate(found):
                stop = base + np.cumsum(self.lengths[side][x])
                ids.append(x)
                ends.append(stop)
                starts.append(stop - self.lengths[side][x])
                sides.append(np.full(len(x), side))
                owner.append(np.full(len(x), i))
            base += len(line)
        if not kept:
            none = np.zeros(count, np.int64)
            return Aligned(none, none, none, none, [""] * count, np.zeros(count + 1, np.int64), none[:0], none[:0])
        ids, starts, ends, sides, owner = map(np.concatenate, (ids, starts, ends, sides, owner))

        order = np.lexsort((sides, starts))
        ids, starts, ends, sides, owner = ids[order], starts[order], ends[order], sides[order], owner[order]
        reached = np.maximum.accumulate(ends)
        breaks = np.r_[True, starts[1:] >= reached[:-1]]
        group = np.cumsum(breaks)
        n_a, n_b, n_groups = (np.bincount(owner[x], minlength=count) for x in (sides == 0, sides == 1, breaks))

        # behind the last token of each start the newest of either side both cover that byte
        place = np.arange(len(ids))
        newest = [np.maximum.accumulate(np.where(sides == side, place, 0)) for side in (0, 1)]
        at = np.flatnonzero(np.r_[starts[1:] != starts[:-1], True])
        pair = ids[newest[0][at]] * self.wide + ids[newest[1][at]]
        by = np.lexsort((pair, owner[at]))
        pair, of = pair[by], owner[at][by]
        new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])])
        times = np.diff(np.r_[new, len(pair)])
        offsets = np.r_[0, np.cumsum(np.bincount(of[new], minlength=count))]

        by = np.lexsort((starts, sides, group))
        ids, group, sides, owner = ids[by], group[by], sides[by], owner[by]
        mark = np.where(np.r_[sides[1:] != sides[:-1], True], 1, 0)
        mark[np.r_[group[1:] != group[:-1], True]] = 2
        mark[np.r_[owner[1:] != owner[:-1], True]] = 3
        words = self.words[mark, ids].tolist()
        bounds = np.r_[0, np.cumsum(np.bincount(owner, minlength=count))].tolist()
        sha = [hashlib.sha256("".join(words[i:j]).encode()).hexdigest() if i < j else "" for i, j in zip(bounds, bounds[1:])]
        return Aligned(n_a, n_b, n_groups, np.bincount(of, minlength=count), sha, offsets, pair[new], times)
