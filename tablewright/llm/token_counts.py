"""Token counts under a sentencepiece BPE model, without moving or shuffling pre-tokens.

Method: a map-side two-tier lookup. No piece of the model joins a letter to a space that follows it, or
crosses a line break, so a text falls into pre-tokens whose counts add up. Tier one is a compact broadcast
table of the most frequent pre-tokens and their counts; it is fitted on a bounded sample of rows and only
saves time. Tier two encodes what tier one misses with the library and keeps it in a bounded cache of the
worker. Every pre-token of every text is counted, whichever tier answers.

Defined cases: a null or empty text has no tokens and no bytes.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import Generations, map_columns, model, pieces, ship

SPACE = "▁"
RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")
# Rows of the sample and entries of the table that tier one is made of.
SAMPLE_ROWS = 4000
FREQUENT = 32_768


class PieceCounter:
    """Counts of whole texts; ``frequent`` is tier one."""

    def __init__(self, content: bytes, frequent: dict[str, int]):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("a piece of this model spans words; texts cannot be split before counting")
        # Line breaks end a pre-token only where no piece holds one.
        self.lines = not any("\n" in n for n in names)
        self.frequent = frequent
        self.cache = Generations(200_000)

    def split(self, text: str) -> list[str]:
        """Pre-tokens. One that begins after a line break carries the break in front; all others have one
        space in front that is not written."""
        if not text:
            return []
        if self.lines and SPACE not in text:
            spaced = text.replace("\n", " \n")
            if "  " not in spaced and spaced[0] not in " \n" and spaced[-1] != " ":
                return spaced.split(" ")
        # A leading space that is written marks the pre-tokens of this rarer form.
        return RUNS.findall(SPACE + text.replace(" ", SPACE))

    def measure(self, units: list[str]) -> list[int]:
        """Counts of pre-tokens by the library, which puts one space in front of what it is given."""
        texts = [u[1:] if u[0] == SPACE else u for u in units]
        found = self.processor.encode(texts, num_threads=1)
        # The library gives no token for an empty text, but a lone space is one; a pre-token that follows
        # a line break must not count the space put in front.
        return [
            max(1, len(ids)) if not t else len(ids) - (u[0] == "\n") for u, t, ids in zip(units, texts, found, strict=True)
        ]

    def counts(self, texts: list[str | None]) -> list[int]:
        units = [self.split(t or "") for t in texts]
        frequent = self.frequent
        missed = set().union(*units) - frequent.keys()
        known = self.cache.fill(missed, self.measure)
        out = []
        for u in units:
            found = [frequent.get(x) or known[x] for x in u]
            out.append(sum(found))
        return out


def _counter(content: bytes, packed: bytes) -> PieceCounter:
    def build() -> PieceCounter:
        names, lengths = pickle.loads(packed) if packed else ("", b"")
        return PieceCounter(content, dict(zip(names.split("\x00"), lengths, strict=True)) if lengths else {})

    return model("pieces", hashlib.sha256(content).digest() + hashlib.sha256(packed).digest(), build)


def frequent_table(df: DataFrame, content: bytes, text: str, sample_rows: int, entries: int) -> bytes:
    """The commonest pre-tokens of a sample of about ``sample_rows`` rows, with their counts in one byte each."""
    ship(df.sparkSession)
    rows = df.count()
    if not rows or not entries or not sample_rows:
        return b""
    sample = df.select(text).sample(min(1.0, sample_rows / rows), 7)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(content, b"")
        for piece in pieces(batches, text):
            seen = Counter(u for t in piece.column(0).to_pylist() for u in counter.split(t or "") if "\x00" not in u)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])

    top = (
        sample.mapInArrow(count, "unit string, n long")
        .groupBy("unit")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "unit")
        .limit(entries)
        .select("unit")
    )
    names = [r["unit"] for r in top.collect()]
    lengths = _counter(content, b"").measure(names) if names else []
    kept = [(n, k) for n, k in zip(names, lengths, strict=True) if 0 < k < 256]
    return pickle.dumps(("\x00".join(n for n, _ in kept), bytes(k for _, k in kept))) if kept else b""


def count_tokens(
    df: DataFrame,
    path: str,
    text: str = "text",
    tokens: str = "n_tokens",
    sample_rows: int = SAMPLE_ROWS,
    entries: int = FREQUENT,
) -> DataFrame:
    """Add ``tokens`` bigint: the number of tokens of the whole text, without begin or end."""
    with open(path, "rb") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is too large for a vocabulary")
    packed = frequent_table(df, content, text, sample_rows, entries)
    sent = df.sparkSession.sparkContext.broadcast((content, packed))
    return map_columns(
        df, text, [(tokens, T.LongType())], lambda texts: {tokens: pa.array(_counter(*sent.value).counts(texts.to_pylist()), pa.int64())}
    )
