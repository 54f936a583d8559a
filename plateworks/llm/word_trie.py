"""Tries of words: a node for every run of words, with its count and its CRC-32 state.

An edge is a word; the node of the run ``a b c`` hangs below that of ``a b`` and takes that
node's CRC on by the bytes of `` c``, so no run is ever spelled out. A trie belongs to one
task. It is emptied when it has ``NODES`` nodes, after its counts have been added to the
buckets' totals, so that its memory is bounded and nothing is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np

#: Nodes at which a trie is emptied (some 150 bytes each).
NODES = 400_000
#: Bytes of text that are split into words at a time.
BLOCK_BYTES = 1 << 19

# A-Z become a-z; everything below U+0080 that is neither letter nor digit separates words.
_SEPARATED = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def separated(text: bytes) -> bytes:
    """Lower-cased A-Z, every separator as a blank."""
    return text.translate(_SEPARATED)


class Block:
    """Words of one or more texts, or of a part of a long one.

    Text ``doc[k]`` has the words ``begin[k]`` to ``end[k]``; those before ``fresh[k]`` were
    in the block before and are here so that runs across the cut are complete.
    """

    def __init__(self):
        self.words: list[bytes] = []
        self.doc, self.begin, self.fresh, self.end = [], [], [], []

    def add(self, doc: int, words: list[bytes], known: int) -> None:
        self.doc.append(doc)
        self.begin.append(len(self.words))
        self.fresh.append(len(self.words) + known)
        self.words += words
        self.end.append(len(self.words))


def blocks(texts: list[bytes | None], longest: int) -> Iterator[Block]:
    """All words of all texts in blocks; a null text has none."""
    block, size = Block(), 0
    for doc, text in enumerate(texts):
        text, at, tail = separated(text or b""), 0, []
        while at < len(text):
            cut = len(text) if len(text) - at <= BLOCK_BYTES else text.find(b" ", at + BLOCK_BYTES)
            cut = len(text) if cut < 0 else cut
            words = tail + text[at:cut].split()
            block.add(doc, words, len(tail))
            size += cut - at
            at, tail = cut, words[len(words) - longest + 1 :] if longest > 1 else []
            if size >= BLOCK_BYTES:
                yield block
                block, size = Block(), 0
    if block.doc:
        yield block


class _Roots(dict):
    """Nodes of single words."""

    def __init__(self, trie: WordTrie):
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        node = self[word] = self.trie.grow(zlib.crc32(word))
        self.trie.spelling[node] = b" " + word
        return node


class WordTrie:
    """Nodes of runs of up to ``longest`` words."""

    def __init__(self, longest: int, buckets: int, gains: np.ndarray | None = None):
        self.longest, self.buckets, self.gains = longest, buckets, gains
        self.totals = np.zeros(buckets, np.int64)
        self._empty()

    def _empty(self) -> None:
        self.roots, self.edges, self.spelling = _Roots(self), {}, {}
        self.size = 0
        self.crc = np.zeros(1 << 12, np.uint32)
        self.count = np.zeros(1 << 12, np.int64)

    def grow(self, crc: int) -> int:
        if self.size == len(self.crc):
            self.crc, self.count = np.resize(self.crc, 2 * self.size), np.concatenate([self.count, np.zeros(self.size, np.int64)])
        self.crc[self.size] = crc
        self.size += 1
        return self.size - 1

    def fold(self) -> None:
        """Add the counts to the buckets' totals and start anew."""
        np.add.at(self.totals, (self.crc[: self.size] % self.buckets).astype(np.int64), self.count[: self.size])
        self._empty()

    def paths(self, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of run: the nodes at which runs end, and the index in the block of the text they are in."""
        doc = np.repeat(np.arange(len(block.doc)), np.subtract(block.end, block.begin))
        last, fresh = np.array(block.end, np.int64)[doc], np.array(block.fresh, np.int64)[doc]
        at = np.arange(len(block.words))
        word = np.fromiter(map(self.roots.__getitem__, block.words), np.int64, len(block.words))
        node = word
        for k in range(self.longest):
            if k:  # from the node of the run's first k words along the next word
                inside = at + k < last
                at, node, doc, last, fresh = at[inside], node[inside], doc[inside], last[inside], fresh[inside]
                node = self._along(node, word[at + k])
            new = at + k >= fresh
            yield node[new], doc[new]

    def _along(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        pairs, where = np.unique(parent << 32 | word, return_inverse=True)
        nodes = np.empty(len(pairs), np.int64)
        for k, pair in enumerate(pairs.tolist()):
            node = self.edges.get(pair)
            if node is None:
                node = self.edges[pair] = self.grow(zlib.crc32(self.spelling[pair & 0xFFFFFFFF], int(self.crc[pair >> 32])))
            nodes[k] = node
        return nodes[where]

    def count_block(self, block: Block) -> None:
        for node, _ in self.paths(block):
            self.count[: self.size] += np.bincount(node, minlength=self.size)
        if self.size >= NODES:
            self.fold()

    def score_block(self, block: Block, features: np.ndarray, weight: np.ndarray) -> None:
        """Add each text's number of runs and the sum of their nodes' gains."""
        for node, doc in self.paths(block):
            gain = self.gains[self.crc[: self.size] % self.buckets]
            found, gained = np.bincount(doc, minlength=len(block.doc)), np.zeros(len(block.doc), np.int64)
            full = np.flatnonzero(found)
            if len(full):
                gained[full] = np.add.reduceat(gain[node], (np.cumsum(found) - found)[full])
            np.add.at(features, block.doc, found)
            np.add.at(weight, block.doc, gained)
        if self.size >= NODES:
            self._empty()
