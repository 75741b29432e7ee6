"""Fill-in-the-middle: texts cut at two token boundaries and put in an order to learn infilling from.

A token is a word with the blanks before it, or the blanks at the end. The boundaries of all texts of
a slice are found in a few array passes and kept as a rank index (``ranks``): a cut after so many tokens
is predicted from its rank and corrected exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import map_rows
from glosswell.llm.ranks import RankIndex

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Settings:
    """Which texts are cut, by a hash of seed and id: ``cut`` of a hundred, ``suffix_first`` of a hundred of these."""

    seed: int = 42
    cut: int = 50
    suffix_first: int = 80


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, over all texts in a row, of where each begins and where its tokens end; the rank at
    which each text begins; each text's number of tokens."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    lengths = np.array([len(t) for t in texts], np.int64)
    last = np.cumsum(lengths)
    ends = np.ones(len(points), bool)
    ends[:-1] = ~blank[:-1] & blank[1:]
    ends[last[lengths > 0] - 1] = True
    ends = np.flatnonzero(ends) + 1
    upto = np.searchsorted(ends, last, "right")
    counts = np.diff(upto, prepend=0)
    first = np.cumsum(counts + 1) - counts - 1
    offsets = np.empty(len(ends) + len(texts), np.int64)
    offsets[first] = last - lengths
    offsets[np.arange(len(ends)) + np.repeat(np.arange(1, len(texts) + 1), counts)] = ends
    return offsets, first, counts


def drawn(doc_id: Column, seed: int) -> Column:
    """Four numbers of 32 bits from a seed and an id; a null id counts as an empty one."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: every text as it is to be learned from.

    n tokens are cut after the smaller and after the larger of two drawn ranks, 0 to n. ``form`` is
    plain (the text as it is), psm (prefix, suffix, middle) or spm (suffix, prefix, middle), each part
    after its mark. A text that is empty or holds a mark is plain, so every output can be read back.
    ``prefix_chars`` and ``middle_chars`` count code points, null where plain.

    One row per row of ``documents``; null texts are empty, rows with a null id share one draw, repeated
    rows give repeated rows. Further columns are not read. A task holds one slice of texts, or one text.
    """
    numbered = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), drawn(F.col("doc_id").cast("long"), settings.seed).alias("draw")
    )

    def work(part: pa.RecordBatch) -> dict:
        texts = [t or "" for t in part.column("text").to_pylist()]
        draws = np.array(part.column("draw").to_pylist(), np.int64).reshape(-1, 4)
        offsets, first, counts = boundaries(texts)
        index = RankIndex(offsets)
        cuts = np.sort(draws[:, :2] % (counts + 1)[:, None], axis=1)
        ends = index.offset(first[:, None] + cuts) - offsets[first][:, None]
        out: dict = {"doc_id": part.column("doc_id"), "n": counts, "form": [], "prefix_chars": [], "middle_chars": [], "output": []}
        for text, (a, b), (*_, whether, which) in zip(texts, ends.tolist(), draws.tolist()):
            plain = not text or whether % 100 >= settings.cut or any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            if plain:
                row = "plain", None, None, text
            elif which % 100 < settings.suffix_first:
                row = "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
            else:
                row = "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
            for column, value in zip(("form", "prefix_chars", "middle_chars", "output"), row):
                out[column].append(value)
        return out

    return map_rows(
        numbered, work, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string", "text"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of; null where either is null."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
    )
