"""Encoding of a corpus with a public byte-level BPE by walking a trie of its distinct words.

For byte-pair encoding each prefix of a word has one last token, and the encoding of a prefix is that of the prefix
without its last token, followed by it. So a trie of the distinct words needs one state per node, its last token: of
the tokens that end the prefix, the one that really stays a token of its own next to the last token of what is left.
The states are passed down depth first, and a prefix that many words share is worked out once. Tasks keep their trie
from batch to batch; no words or ids are shuffled.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary's file (a parameter everywhere) and the pattern that its words are split by (fixed value).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Nodes after which a task starts a new trie, and bytes from which a word is encoded along its own path. Neither changes ids.
MOST_NODES, LONG_WORD = 400_000, 1024
#: Answers about pairs of tokens that a task remembers.
MOST_PAIRS = 1_000_000


class Vocabulary:
    """Tokens and ranks, with the two questions the walk asks."""

    def __init__(self, content: bytes):
        pairs = (line.split() for line in content.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {r: t for t, r in self.ranks.items()}
        ends: dict[bytes, set[int]] = {}
        for t in self.ranks:
            ends.setdefault(t[-2:], set()).add(len(t))
        #: By the last two bytes of a prefix: lengths of tokens that may end it, the longest first.
        self.lengths = {e: sorted(n, reverse=True) for e, n in ends.items()}
        self.longest = max(map(len, self.ranks), default=1)
        self._stays: dict[tuple[int, int], bool] = {}

    def merge(self, word: bytes) -> list[int]:
        """Plain byte-pair encoding; only used on one or two tokens, to see whether they stay as they are."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def stays(self, before: int, token: int) -> bool:
        """Whether the two tokens, put together, are encoded as just these two; before is -1 at the begin of a word."""
        key = (before, token)
        got = self._stays.get(key)
        if got is None:
            if len(self._stays) >= MOST_PAIRS:
                self._stays.clear()
            alone = self.tokens[token]
            got = self.merge(alone) == [token] if before < 0 else self.merge(self.tokens[before] + alone) == [before, token]
            self._stays[key] = got
        return got


    def last_token(self, tail: bytes, depth: int, token_at) -> tuple[int, int]:
        """The last token of a prefix of `depth` bytes and its length; tail holds the prefix' last bytes, as many as the
        longest token has or all, and token_at(d) is the last token of the prefix of d bytes."""
        for n in (*self.lengths.get(tail[-2:], ()), *((1,) if depth > 1 else ())):
            if n <= depth:
                t = self.ranks.get(tail[len(tail) - n :])
                if t is not None and self.stays(token_at(depth - n), t):
                    return t, n
        raise ValueError(f"no token ends {tail!r}")

    def along(self, word: bytes) -> list[int]:
        """Encoding of one word by the last tokens of its prefixes: a trie of a single path, as two arrays of numbers."""
        tokens, sizes = array("i", bytes(4 * (len(word) + 1))), array("i", bytes(4 * (len(word) + 1)))
        tokens[0] = -1
        for d in range(1, len(word) + 1):
            tokens[d], sizes[d] = self.last_token(word[max(0, d - self.longest) : d], d, tokens.__getitem__)
        out, d = [], len(word)
        while d:
            out.append(tokens[d])
            d -= sizes[d]
        return out[::-1]


class PrefixTrie:
    """Trie over the bytes of words; each node has its last token and the node before that token."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.children: list[dict[int, int]] = [{}]
        self.token, self.before = [-1], [0]

    def walk(self, words: list[bytes]) -> list[int]:
        """Inserts words, which must be sorted, and gives the node of each. As sorted words follow each other depth
        first, states are passed down as nodes are made, and a prefix that the trie has is only passed through."""
        path, nodes, out = bytearray(), [0], []
        for word in words:
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del path[shared:], nodes[shared + 1 :]
            for b in word[shared:]:
                down = self.children[nodes[-1]]
                path.append(b)
                child = down.get(b)
                if child is None:
                    child = down[b] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                    self.before.append(-1)
                    nodes.append(child)
                    self._state(child, path, nodes)
                else:
                    nodes.append(child)
            out.append(nodes[-1])
        return out

    def _state(self, node: int, path: bytearray, nodes: list[int]) -> None:
        depth = len(path)
        tail = bytes(path[-self.v.longest :])
        t, n = self.v.last_token(tail, depth, lambda d: self.token[nodes[d]])
        self.token[node], self.before[node] = t, nodes[depth - n]

    def encoding(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.token[node])
            node = self.before[node]
        return out[::-1]


class Encoder:
    """Encodes texts batch by batch over one trie."""

    def __init__(self, content: bytes, pattern: str = PATTERN):
        self.v, self.split = Vocabulary(content), regex.compile(pattern).findall
        self._new()

    def _new(self) -> None:
        self.trie, self.known = PrefixTrie(self.v), {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text; null and empty texts have no tokens. Special tokens' strings are ordinary text."""
        if len(self.trie.children) > MOST_NODES:
            self._new()
        words = [self.split(t) if t else [] for t in texts]
        fresh = {w for of_text in words for w in of_text if w not in self.known}
        short, long_words = [], []
        for w in fresh:
            b = w.encode("utf-8", "surrogatepass")
            if len(b) < LONG_WORD:
                short.append((b, w))
            else:
                self.known[w] = self.v.along(b)
                long_words.append(w)
        short.sort()
        for (_, w), n in zip(short, self.trie.walk([b for b, _ in short]), strict=True):
            self.known[w] = self.trie.encoding(n)
        known = self.known
        out = [[i for w in of_text for i in known[w]] for of_text in words]
        for w in long_words:  # they are worked out anew where they come again, so that memory stays bounded
            del known[w]
        return out


def _content(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: about 1 MB whatever the corpus


def encode(documents: DataFrame, key: str, text: str, *, vocabulary: str = VOCABULARY, keep: list[str] | None = None, count_only: bool = False) -> DataFrame:
    """(key, keep..., ids) or, with count_only, (key, keep..., n_tokens) of every document, without a shuffle."""
    content, keep = _content(documents, vocabulary), keep or []
    selected = documents.select(F.col(key), F.col(text).alias("_text"), *[F.col(c) for c in keep])
    types = dict(selected.dtypes)
    ddl = ", ".join([f"`{c}` {types[c]}" for c in (key, *keep)] + ["n_tokens bigint" if count_only else "ids array<int>"])
    names = [key, *keep, "n_tokens" if count_only else "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(content.value)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = encoder.encode(part.column(1).to_pylist())
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                if count_only:
                    out = pa.array(lengths)
                else:
                    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                    out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))))
                yield pa.RecordBatch.from_arrays([part.column(0), *[part.column(i + 2) for i in range(len(keep))], out], names)

    return selected.mapInArrow(run, ddl)
