"""SentencePiece encoding and decoding by a distinct-chunk table (operator 7).

No piece of the vocabulary holds a whitespace marker behind another character, so no merge
ever crosses the start of a marked word (a run of markers and what follows up to the next
marker). Each distinct marked word is therefore segmented once, by the library, and the ids
of a text are those of its marked words, joined by position. The table belongs to a task
and is emptied at a bounded number of entries: shuffling one row per word of the corpus to
share one table would move several times the corpus.

Defined results: null is as empty: the end id alone, decoded to an empty text. Repeated rows
and null ids are encoded row by row; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemirror.llm.common import arrow_map

#: Distinct marked words that a task holds at most; then it starts anew.
MAX_CHUNKS = 500_000
#: Texts that are looked up together.
MAX_TEXTS = 256
#: Only chunks up to this length stay in the table.
MAX_KEPT_CHARS = 64

_CHUNK = re.compile("[ ▁]+[^ ▁]*")


class ChunkTable:
    """Marked word -> (number of ids, ids as text, decoded text), filled batch by batch."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.library.get_piece_size()
        if any("▁" in self.library.id_to_piece(i).lstrip("▁") for i in range(size)):
            raise ValueError("pieces of this model cross whitespace markers")
        probe = "  x\t\nﬁ　y  "
        if self.library.decode(self.library.encode(probe)) != probe:
            raise ValueError("this model normalises texts; chunks would not be independent")
        self.end = self.library.eos_id()
        self.entries: dict[str, tuple[int, str, str]] = {}

    def _fill(self, chunks: list[str]) -> None:
        """Segment each of ``chunks`` once.

        The library puts one marker in front by itself, so a chunk goes in without its first;
        a lone marker, which no text of its own gives, is looked up.
        """
        lone = [self.library.piece_to_id("▁")]
        ids = self.library.encode([c[1:] for c in chunks], num_threads=1)
        ids = [i or lone for i in ids]
        plain = self.library.decode(ids, num_threads=1)
        for c, i, p in zip(chunks, ids, plain, strict=True):
            self.entries[c] = (len(i), " ".join(map(str, i)), " " + p)

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Per text: number of ids with the end id, the ids as decimal text, the decoded text."""
        out = []
        for start in range(0, len(texts), MAX_TEXTS):
            split = [_CHUNK.findall(" " + t) if t else [] for t in texts[start : start + MAX_TEXTS]]
            if len(self.entries) > MAX_CHUNKS:
                self.entries.clear()
            missing = {c for chunks in split for c in chunks}.difference(self.entries)
            self._fill(list(missing))
            get = self.entries.__getitem__
            for chunks in split:
                found = [get(c) for c in chunks]
                ids = " ".join([e[1] for e in found] + [str(self.end)])
                out.append((sum([e[0] for e in found]) + 1, ids, "".join([e[2] for e in found])[1:]))
            for c in missing:
                if len(c) > MAX_KEPT_CHARS:
                    del self.entries[c]
        return out


_TABLES: dict[str, ChunkTable] = {}


def table(model_file: str) -> ChunkTable:
    """The table of this Python worker."""
    if model_file not in _TABLES:
        _TABLES[model_file] = ChunkTable(model_file)
    return _TABLES[model_file]


def encode(docs: DataFrame, model_file: str, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, ``ids`` array<int> and ``decoded`` string of every whole text.

    ``model_file`` has to be at the same path on every executor.
    """
    return _run(docs, model_file, keep, text, "ids array<int>, decoded string",
                lambda n, ids, plain: (list(map(int, ids.split())), plain))


def digests(docs: DataFrame, model_file: str, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    return _run(docs, model_file, keep, text,
                "n_tokens long, ids_sha256 string, decoded_sha256 string",
                lambda n, ids, plain: (n, _sha(ids), _sha(plain)))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _run(docs, model_file, keep, text, columns, shape):
    kept = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-1])

    def each(*cols):
        chunks = table(model_file)
        return [*cols[:-1], *zip(*(shape(*e) for e in chunks.encode(cols[-1])), strict=True)]

    return arrow_map(kept, each, f"{types}, {columns}" if types else columns)
