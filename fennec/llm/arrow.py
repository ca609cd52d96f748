"""Arrow batches of whole texts, cut into pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

#: Characters that one piece of a batch holds at most (a longer text is a piece of its own).
PIECE_CHARS = 2_000_000


def pieces(batch: pa.RecordBatch, col: str, max_chars: int = PIECE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of ``batch`` with the texts of ``col`` (null: empty)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > max_chars:
            part = batch.slice(start, i - start)
            yield part, [t or "" for t in part.column(col).to_pylist()]
            start, total = i, 0
        total += n
    if start < len(lengths):
        part = batch.slice(start)
        yield part, [t or "" for t in part.column(col).to_pylist()]


class WordCache(dict):
    """What is computed once per word, emptied when it holds too much.
    ``compute`` maps a list of words to a list of values.

    A Python worker runs tasks of many stages; the cache in use empties the one
    used before it, so that only one operator's words stay in memory."""

    in_use: "WordCache | None" = None

    def __init__(self, compute, max_words: int = 300_000, max_chars: int = 12_000_000):
        super().__init__()
        self.compute, self.max_words, self.max_chars, self.chars = compute, max_words, max_chars, 0

    def empty(self) -> None:
        self.clear()
        self.chars = 0

    def values_of(self, words: list[str]) -> list:
        if WordCache.in_use is not self:
            if WordCache.in_use is not None:
                WordCache.in_use.empty()
            WordCache.in_use = self
        if len(self) > self.max_words or self.chars > self.max_chars:
            self.empty()
        got = list(map(self.get, words))
        missing = [i for i, g in enumerate(got) if g is None]
        if missing:
            new = list(dict.fromkeys([words[i] for i in missing]))
            self.update(zip(new, self.compute(new)))
            self.chars += sum(map(len, new))
            for i in missing:
                got[i] = self[words[i]]
        return got
