"""Byte-level BPE encoding and decoding with a published vocabulary.

The encoding of a word never changes that of its prefixes' *last tokens*: the encoding of a prefix
of length i ends in one token t, and what stands before t is the encoding of the prefix of length
i - len(t). Hence one token per trie node is enough. The distinct new words of a slice are walked in
byte order, which is the depth-first order of their trie: the path from the root is a stack, and
states of prefixes shared with the word before are kept, so each shared prefix is computed once.

A token may follow another if no merge across their seam would come before the merges that complete
them; that is asked once per pair and remembered.

A worker remembers the tokens of words by 64-bit hash in sorted arrays (``word_ids.Memory``), from task
to task; when these are full, words not met since the last time go.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import map_rows
from glosswell.llm.word_ids import Memory, gathered

#: Fixed value: how byte-level BPE cuts text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose tokens a worker remembers, some 35 bytes each, and pairs of tokens; bounds memory, never results.
REMEMBERED_WORDS, REMEMBERED_PAIRS = 1_200_000, 250_000
#: Longer words are encoded anew each time.
REMEMBERED_LENGTH = 64
NEVER = 1 << 40
#: The same cut for texts of these characters alone, by the faster standard module.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7eÀ-ÖØ-öø-ÿ]*")
COMMON = re.compile(
    r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+"
)


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Table:
    """A byte string for each token."""

    def __init__(self, names: list[bytes]):
        self.flat = np.frombuffer(b"".join(names), np.uint8)
        self.size = np.array([len(x) for x in names], np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> bytes:
        return gathered(self.flat, self.begin[ids], self.size[ids]).tobytes()


class Encoder:
    """One vocabulary in one worker."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = byte_names()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.ids = {bytes(names[c] for c in t): i for t, i in vocab.items()}
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.joined = [vocab[a + b] for a, b in pairs]
        self.parts = {}
        for pair, rank in self.ranks.items():
            self.parts.setdefault(self.joined[rank], (rank, pair))
        self.spines: tuple[dict, dict] = ({}, {})
        self.lengths = {i: len(t) for i, t in self.bytes_of.items()}
        self.ending: dict[bytes, int] = {}
        for t in self.ids:
            self.ending[t[-2:]] = max(self.ending.get(t[-2:], 1), len(t))
        self.special = special
        self.words = regex.compile(WORDS)
        self.marks = regex.compile("(" + "|".join(regex.escape(s) for s in special) + ")") if special else None
        self.memory = Memory("<i4")
        names = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.raw = Table(names)
        self.decimals = Table([b"%d," % i for i in range(len(names))])
        self.follows: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token while it is merged, smallest first, each with the rank
        of the merge that takes it up."""
        if (known := self.spines[side].get(token)) is None:
            known, taken = [(token, NEVER)], token
            while taken in self.parts:
                rank, parts = self.parts[taken]
                taken = parts[side]
                known.append((taken, rank))
            known.reverse()
            self.spines[side][token] = known
        return known

    def may_follow(self, before: int, token: int) -> bool:
        """Whether no merge across the seam comes before the merges that complete both tokens.

        Equal ranks are the same pair: the one further left comes first.
        """
        left, right = self.spine(before, 1), self.spine(token, 0)
        i = j = 0
        while True:
            (x, x_rank), (y, y_rank) = left[i], right[j]
            rank = self.ranks.get((x, y), NEVER)
            if rank < x_rank and rank <= y_rank and rank < NEVER:
                return False
            if x_rank <= y_rank:
                i += 1
            else:
                j += 1
            if i == len(left) or j == len(right):
                return True

    def stands_alone(self, token: int) -> bool:
        """Whether the merge rules give this token for its own bytes; plain merging of a few bytes."""
        ids = [self.ids[bytes([b])] for b in self.bytes_of[token]]
        while len(ids) > 1:
            rank, at = min((self.ranks.get(p, NEVER), i) for i, p in enumerate(zip(ids, ids[1:])))
            if rank == NEVER:
                break
            ids[at : at + 2] = [self.joined[rank]]
        return ids == [token]

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """The tokens of words, depth first through their common prefixes."""
        known: dict[str, bytes] = {}
        ids_of, follows, longest, lengths = self.ids.get, self.follows, self.ending, self.lengths
        before, path = b"", [-1]
        for raw, word in sorted((w.encode(), w) for w in words):
            shared, most = 0, min(len(before), len(raw))
            while shared < most and before[shared] == raw[shared]:
                shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest.get(raw[max(0, end - 2) : end], 1)), end):
                    if (token := ids_of(raw[start:end])) is None:
                        continue
                    if start:
                        key = path[start] << 32 | token
                        if (fits := follows.get(key)) is None:
                            fits = follows[key] = self.may_follow(path[start], token)
                    elif (fits := self.whole.get(token)) is None:
                        fits = self.whole[token] = self.stands_alone(token)
                    if fits:
                        path.append(token)
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            ids, end = [], len(raw)
            while end:
                ids.append(path[end])
                end -= lengths[path[end]]
            ids.reverse()
            known[word] = np.array(ids, "<i4").tobytes()
            before = raw
        return known

    def cut(self, text: str) -> list[str]:
        return (COMMON if PLAIN.fullmatch(text) else self.words).findall(text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        # A text is cut at the strings of special tokens, which stand between its other pieces.
        pieces, special, counts = [], {}, []
        for text in texts:
            own = self.marks.split(text) if self.marks and text else [text or ""]
            for piece in own:
                if piece in self.special:
                    special[len(pieces)] = self.special[piece]
                    piece = ""
                pieces.append(self.cut(piece))
            counts.append(len(own))
        ids, ends = self.words_ids(list(chain.from_iterable(pieces)))
        ends = ends[np.cumsum([0, *map(len, pieces)])]
        out, at = [], 0
        for n in counts:
            if n == 1 and at not in special:
                out.append(ids[ends[at] : ends[at + 1]])
            else:
                parts = [np.array([special[i]], "<i4") if i in special else ids[ends[i] : ends[i + 1]] for i in range(at, at + n)]
                out.append(np.concatenate(parts))
            at += n
        return out

    def words_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many there are before each."""
        hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        found, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self.memory.find(found)[1])
        if len(new):
            fresh = [words[i] for i in at[new].tolist()]
            known = self.learn(fresh)
            self.memory.add(found[new], [known[w] for w in fresh])
        place, _ = self.memory.find(found)
        size = self.memory.size[place][which]
        ids = gathered(self.memory.flat, self.memory.begin[place][which], size)
        long = [i for i, a in zip(new.tolist(), at[new].tolist()) if len(words[a]) > REMEMBERED_LENGTH]
        if long:
            self.memory.drop(found[long])
        self.memory.trim(REMEMBERED_WORDS)
        if len(self.follows) > REMEMBERED_PAIRS:
            self.follows.clear()
        return ids, np.concatenate([[0], np.cumsum(size)])

    def decode(self, ids: np.ndarray) -> str:
        return self.raw.joined(ids).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers with commas between."""
        return self.decimals.joined(ids)[:-1]


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file that every machine has at ``path``."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def lists(ids: list[np.ndarray]) -> pa.ListArray:
    starts = [0, *accumulate(map(len, ids))]
    values = np.concatenate([np.zeros(0, "<i4"), *ids])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values))


def encode(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids: the tokens of each whole text.

    One row per row of ``documents``, also for repeated rows and null ids. A null or empty text has
    no tokens. Other columns are not read. Strings of special tokens inside a text give their
    token, as the usual library does.
    """

    def work(part: pa.RecordBatch) -> dict:
        return {"doc_id": part.column("doc_id"), "ids": lists(encoder(vocabulary).encode(part.column("text").to_pylist()))}

    return map_rows(
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        work,
        "doc_id long, ids array<int>",
        "text",
    )


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids, text: the text that the tokens stand for; bytes that are no UTF-8 become U+FFFD.

    A null list is decoded as an empty one.
    """

    def work(part: pa.RecordBatch) -> dict:
        back = encoder(vocabulary).decode
        ids = part.column("ids")
        return {
            "doc_id": part.column("doc_id"),
            "ids": ids,
            "text": [back(x.values.to_numpy()) if x.is_valid else "" for x in ids],
        }

    return map_rows(encoded.select("doc_id", "ids"), work, "doc_id long, ids array<int>, text string")
