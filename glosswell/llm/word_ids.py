"""Tokens of a published vocabulary that never joins words across blanks, by the library that reads it.

The normaliser and the splitter of such a vocabulary treat a text between blanks on its own, and letters
apart from what is neither letter nor digit, so the tokens of a text are those of its stretches one
after another. Stretches are told apart by 64-bit hashes, found for all texts of a slice in a few array
passes (``words``). A worker remembers the tokens of stretches in sorted arrays of some 30 bytes each, so
the library is only asked for those that are new; when the memory is full, those not met since the last
time go.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from glosswell.llm.words import SPACED, texts_words, words_of

#: Stretches that a worker remembers, and the longest one it does; bounds memory, never results.
REMEMBERED, LONGEST = 1_500_000, 64
#: Stretches given to the library at once.
AT_ONCE = 4_096
LETTERS = "[a-zß-öø-ÿ]+"
#: Letters that are a word by themselves to the splitter, and what may follow them as another one.
WORD = re.compile(LETTERS)
WORD_AND_MARKS = re.compile(f"({LETTERS})([!-/:-@\\[-`{{-~]+)")
#: Special tokens begin so; they are told before letters are lower-cased.
SPECIAL = "<|"


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` from ``begin`` on, one after another."""
    upto = np.cumsum(size)
    return flat[np.repeat(begin - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)]


class Memory:
    """Ids by hash: sorted hashes, where each one's ids begin in a flat array, and how many they are."""

    def __init__(self, kind: str):
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.met = np.zeros(0, bool)
        self.flat = np.zeros(0, kind)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash, and whether it is there."""
        place = np.searchsorted(self.hashes, hashes)
        place[place == len(self.hashes)] = 0
        there = self.hashes[place] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        self.met[place[there]] = True
        return place, there

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        """Distinct hashes that are not there yet."""
        more = np.frombuffer(b"".join(ids), self.flat.dtype)
        size = np.array([len(x) for x in ids], np.int64) // more.itemsize
        at = np.concatenate([self.hashes, hashes])
        order = np.argsort(at, kind="stable")
        self.hashes = at[order]
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.met = np.concatenate([self.met, np.ones(len(hashes), bool)])[order]
        self.flat = np.concatenate([self.flat, more])

    def drop(self, hashes: np.ndarray) -> None:
        """Forget these; their ids go with the next trim."""
        kept = ~np.isin(self.hashes, hashes)
        self.hashes, self.begin, self.size, self.met = (x[kept] for x in (self.hashes, self.begin, self.size, self.met))

    def trim(self, most: int) -> None:
        """Between slices: beyond ``most``, keep what was met since the last time, all else if that is too much."""
        if len(self.hashes) <= most and len(self.flat) <= 8 * most:
            return
        kept = self.met if 2 * np.count_nonzero(self.met) <= most else np.zeros(len(self.met), bool)
        self.flat = gathered(self.flat, self.begin[kept], self.size[kept])
        self.hashes, self.size = self.hashes[kept], self.size[kept]
        self.begin = np.cumsum(self.size) - self.size
        self.met = np.zeros(len(self.hashes), bool)


class WordIds:
    """One vocabulary in one worker. Ids are kept in the smallest integers that do."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.ends = np.zeros(size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memory = Memory(self.kind)

    def ask(self, words: list[str]) -> dict[str, bytes]:
        """The library's ids for these stretches. Words of letters alone go in one text, told apart by the
        tokens that end a word."""
        made: dict[str, bytes] = {}
        plain = [w for w in words if len(w) <= LONGEST and WORD.fullmatch(w)]
        for begin in range(0, len(plain), AT_ONCE):
            part = plain[begin : begin + AT_ONCE]
            ids = np.array(self.library.encode(" ".join(part), add_special_tokens=False).ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("the vocabulary does not mark the ends of words")
            raw, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
            made.update((w, raw[a:b]) for w, a, b in zip(part, [0, *ends], ends))
        other = [w for w in words if w not in made]
        for begin in range(0, len(other), AT_ONCE):
            part = other[begin : begin + AT_ONCE]
            for w, x in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False)):
                made[w] = np.array(x.ids, self.kind).tobytes()
        return made

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Remember distinct new stretches. Marks behind letters are looked up apart from them."""
        parts = [m.groups() if (m := WORD_AND_MARKS.fullmatch(w)) else (w,) for w in words]
        own = dict.fromkeys(p for x in parts if len(x) > 1 for p in x)
        raw = " ".join(own).encode()
        own_hashes = words_of(raw, SPACED)[0]
        place, there = self.memory.find(own_hashes)
        memory, known = self.memory, {}
        for p, i, found in zip(own, place.tolist(), there.tolist()):
            if found:
                known[p] = memory.flat[memory.begin[i] : memory.begin[i] + memory.size[i]].tobytes()
        known |= self.ask(list({p for x in parts for p in x} - known.keys()))
        ids = [known[x[0]] if len(x) == 1 else known[x[0]] + known[x[1]] for x in parts]
        new = dict(zip(hashes.tolist(), ids)) | {
            h: known[p] for h, p, found in zip(own_hashes.tolist(), own, there.tolist()) if not found
        }
        memory.add(np.fromiter(new, np.uint64, len(new)), list(new.values()))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each whole text."""
        plain = [t or "" for t in texts.to_pylist()]
        special = {i: t for i, t in enumerate(plain) if SPECIAL in t}
        raw, hashes, first, last, bounds = texts_words(["" if i in special else t for i, t in enumerate(plain)], SPACED)
        found, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~self.memory.find(found)[1]
        words = [raw[a:b].lower().decode() for a, b in zip(first[at[new]].tolist(), last[at[new]].tolist())]
        if words:
            self.learn(found[new], words)
        place, _ = self.memory.find(found)
        own = self.memory.size[place][which]
        ids = gathered(self.memory.flat, self.memory.begin[place][which], own)
        ends = np.concatenate([[0], np.cumsum(own)])[bounds]
        out = [ids[a:b] for a, b in zip(ends, ends[1:])]
        for i, t in special.items():
            out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, self.kind)
        self.memory.trim(REMEMBERED)
        return out


ENCODERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's encoder for a vocabulary file that every machine has at ``path``."""
    if path not in ENCODERS:
        ENCODERS[path] = WordIds(path)
    return ENCODERS[path]
