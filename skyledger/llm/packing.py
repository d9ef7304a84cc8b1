"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed length.

A document is its token ids and an end id. Overlong documents are first cut into full windows,
each a sequence of its own; what is left of each document, shorter than a window, is dealt by hash
to shards and packed there: pieces in order of falling length, each into the open sequence with the
least room that still holds it, which a segment tree over the rooms finds. Shards take a fixed
number of pieces on average, so a shard's memory and the share of padding don't depend on the input's
size. Only lengths are dealt out to be packed; the plan is joined back by piece, which moves the pieces shorter than a window once.

Defined results: a null or empty text is one end id; repeated rows are packed as often as they
come; an empty table gives an empty result; other columns are ignored. A very long text is tokenised whole and cut freely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import vocab
from skyledger.llm.batches import bounded
from skyledger.sources.shared import written

WINDOW, END_ID = 1024, 0
#: Pieces a shard packs on average.
SHARD_PIECES = 32_768
#: Tokens a worker holds before it hands pieces on.
HELD_TOKENS = 1 << 19


class Rooms:
    """Open sequences by remaining room; a segment tree over the rooms 0..window finds the tightest fit."""

    def __init__(self, window: int):
        self.width = 1 << (window + 1).bit_length()
        self.open: list[list[int]] = [[] for _ in range(self.width)]
        self.count = [0] * (2 * self.width)

    def _add(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, sequence) of the least room that is at least ``length``; None if no sequence has it."""
        node = length + self.width
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up to the first filled subtree on the right
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.width
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    rooms, sequences = Rooms(window), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        room, found = rooms.take(length) or (window, sequences)
        sequences += found == sequences
        sequence[i], offset[i] = found, window - room
        if room > length:
            rooms.put(room - length, found)
    return sequence, offset


def padded(used: int, window: int = WINDOW) -> int:
    """Length of a sequence as it is stored: the window, or less where its tokens are a power of two."""
    return used if used & (used - 1) == 0 else window


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, window: int, keep: str) -> DataFrame:
    """(id, start, length, doc_tokens, ids or ids_crc32): documents cut into windows, in one pass over the texts."""
    ids = docs.schema[id_col].dataType.simpleString()
    source = bounded(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    kept = {"ids": "ids array<int>", "ids_crc32": "ids_crc32 long"}[keep]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for key, text in zip(batch["id"], batch["text"], strict=True):
                tokens = np.append(vocab.encode(vocabulary, text), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(tokens), window):
                    part = tokens[start : start + window]
                    value = part.astype(np.int32) if keep == "ids" else zlib.crc32(part.tobytes())
                    rows.append((key, start, len(part), len(tokens), value))
                held += len(tokens)
                if held >= HELD_TOKENS:
                    yield pd.DataFrame(rows, columns=["id", "start", "length", "doc_tokens", keep])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["id", "start", "length", "doc_tokens", keep])

    made = source.mapInPandas(cut, f"id string, start long, length long, doc_tokens long, {kept}")
    return made.withColumn("id", F.col("id").cast(ids))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    window: int = WINDOW, keep: str = "ids", shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset and ids (or, by ``keep``, ids_crc32)."""
    vocabulary = vocabulary or vocab.vocabulary_path("byte_bpe_50k.tiktoken")
    cut = written(
        pieces(docs, id_col, text_col, vocabulary, window, keep).withColumn("piece", F.monotonically_increasing_id()), "pieces"
    )
    full, rest = F.col("length") == window, cut.where(F.col("length") < window)
    shards = max(1, -(-rest.count() // shard_pieces))

    def placed(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("piece", ignore_index=True)
        sequence, offset = best_fit_decreasing(shard["length"].to_numpy(), window)
        at = int(shard["shard"].iloc[0]) if len(shard) else 0
        return pd.DataFrame({"piece": shard["piece"], "sequence": sequence * shards + at, "offset": offset})

    plan = rest.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(shards)).alias("shard")).groupBy("shard").applyInPandas(
        placed, "piece long, sequence long, offset long"
    )
    # Even ids for full windows, odd ids for packed sequences.
    columns = ["id", "start", "length", "doc_tokens", keep]
    whole = cut.where(full).select(*columns, (F.col("piece") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    packed = rest.join(plan, "piece").select(*columns, (F.col("sequence") * 2 + 1).alias("sequence_id"), "offset")
    return whole.unionByName(packed)
