"""Best-fit packing: hierarchical residual packing of token sequences.

Every task tokenises its documents and packs their pieces best-fit, longest first. Full and
nearly full bins are final. Underfull bins then act as items: groups of tasks merge theirs
best-fit, again and again up a tree. After a best-fit round at most one bin of a task is at
most half full, and only such a bin can join another, so a task hands on its ``CARRY`` emptiest
bins at most and the tree's tasks stay small whatever the input.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from bankmart.sources import stage

SEQUENCE = 4096
END = 1
#: Free places of a bin that counts as nearly full.
SLACK = 8
#: Underfull bins that a task hands on, and tasks that a merge joins.
CARRY, FAN_IN = 256, 32
#: Pieces that a task packs at one time.
CHUNK = 400_000
#: Text chunks whose ids a task remembers: those of the last ``CACHE`` to twice as many new ones.
CACHE = 250_000
MARKS = tuple(".,;:!?")
#: Bytes as the characters that stand for them in the vocabulary: printable ones as they are, the rest from 256 on.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


class _Encoder(dict):
    """Lower-case text between blanks to its ids as little-endian bytes.

    The tokenizer drops white space, and no token reaches across it, nor from letters to a mark
    behind them: a text's ids are those of its parts. Plain words go straight to the merges, as
    the steps before leave them as they are. Texts for which lower-casing first might differ are encoded whole.

    Ids of two generations of parts are remembered: a part of the older one that is met again
    joins the younger, and once that is full it takes the older one's place.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.merges = self.model.model
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            if part.isalpha() and (part.isascii() or max(part) < "\u0600"):
                shown = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTES)
                ids = array("I", [t.id for t in self.merges.tokenize(shown)]).tobytes()
            elif part[-1:] in MARKS and part[:-1].isalpha():
                ids = self[part[:-1]] + self[part[-1]]
            else:
                ids = self._encode(part)
        self[part] = ids
        return ids

    def _encode(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        text = text or ""
        low = text.lower()
        end = END.to_bytes(4, "little")
        if "<|" in text or "\u03a3" in text or not (is_normalized("NFC", text) and is_normalized("NFC", low)):
            return self._encode(text) + end
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()
        parts = low.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.__getitem__, parts)) + end


def best_fit(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit, longest first, ties in given order: bin and offset of each item, bin fills.

    Bins of each free size are stacked; a bit set of the free sizes in use finds the tightest.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fills: list[int] = []
    free: list[list[int]] = [[] for _ in range(size + 1)]
    used = 0
    for item, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = used >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                used &= ~(1 << room)
        else:
            room, b = size, len(fills)
            fills.append(0)
        bins[item], offsets[item] = b, fills[b]
        fills[b] += length
        if left := size - fills[b]:
            free[left].append(b)
            used |= 1 << left
    return bins, offsets, fills


def handed_on(fills: np.ndarray) -> np.ndarray:
    """True for the emptiest underfull bins, ``CARRY`` at most."""
    open_bins = np.zeros(len(fills), bool)
    order = np.argsort(fills, kind="stable")[:CARRY]
    open_bins[order] = fills[order] < SEQUENCE - SLACK
    return open_bins


PIECES = [("doc_id", None), ("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids_crc32", LongType()), ("bin", LongType()), ("shift", LongType()), ("fill", LongType()), ("open", BooleanType())]


def _pack_texts(docs: DataFrame, path: str) -> DataFrame:
    """Pieces with their first bins: pieces of a task never wait for another task's."""
    schema = StructType([StructField(n, t or docs.schema["doc_id"].dataType) for n, t in PIECES])
    names = [n for n, _ in PIECES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task = _Encoder(path), TaskContext.get().partitionId()
        next_bin = task << 32
        ids, piece, start, length, crc = [], [], [], [], []

        def flush():
            nonlocal next_bin
            sizes = np.array(length, np.int64)
            bins, offsets, fills = best_fit(sizes)
            fill = np.array(fills, np.int64)
            out = [pa.concat_arrays(ids), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(sizes), pa.array(crc, pa.int64()), pa.array(bins + next_bin), pa.array(offsets), pa.array(fill[bins]), pa.array(handed_on(fill)[bins])]
            next_bin += len(fills)
            for kept in (ids, piece, start, length, crc):
                kept.clear()
            return pa.RecordBatch.from_arrays(out, names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                doc, which = rows.column(0), []
                for k, text in enumerate(rows.column(1).to_pylist()):
                    data = memoryview(encoder.ids(text))
                    n = len(data) // 4
                    for number, begin in enumerate(range(0, n, SEQUENCE)):
                        end = min(n, begin + SEQUENCE)
                        which.append(k)
                        piece.append(number)
                        start.append(begin)
                        length.append(end - begin)
                        crc.append(zlib.crc32(data[4 * begin : 4 * end]))
                ids.append(doc.take(pa.array(which, pa.int64())))
                if len(piece) >= CHUNK:
                    yield flush()
        if piece:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """One merge of the tree: whole bins as items, best fit; rows are first bins with their place."""
    group = group.sort_values(["into", "bin"], ignore_index=True)
    heads, inverse = np.unique(group["into"].to_numpy(), return_inverse=True)
    fill = np.zeros(len(heads), np.int64)
    fill[inverse] = group["total"].to_numpy()
    bins, offsets, fills = best_fit(fill)
    names = np.full(len(fills), np.iinfo(np.int64).max)
    np.minimum.at(names, bins, heads)
    total = np.array(fills, np.int64)
    group["into"] = names[bins][inverse]
    group["shift"] = group["shift"].to_numpy() + offsets[inverse]
    group["total"] = total[bins][inverse]
    group["open"] = handed_on(total)[bins][inverse]
    return group


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end token alone, so every document has a piece. Only
    documents over a whole sequence are cut. Ties go by row order in the input's partitions.
    Repeated rows are packed as rows of their own; an empty table gives no rows; other columns
    are not read. The pieces are written once, so that bins don't change if a task runs again.
    """
    pieces = stage(_pack_texts(docs, tokenizer), "packing-pieces")
    members = pieces.where("open AND shift = 0").select("bin", F.shiftright("bin", 32).alias("task"), F.col("bin").alias("into"), F.lit(0).cast("long").alias("shift"), F.col("fill").alias("total"), "open")
    members = stage(members, "packing-underfull")
    tasks = members.agg(F.coalesce(F.max("task"), F.lit(-1))).first()[0] + 1
    closed = []
    while tasks > 0:
        span = F.floor(F.col("task") / FAN_IN).alias("task")
        work = members.where("open").select("bin", span, "into", "shift", "total", "open")
        closed.append(members.where("NOT open"))
        members = stage(work.groupBy("task").applyInPandas(_merge, work.schema), "packing-round")
        tasks = 0 if tasks <= 1 else -(-tasks // FAN_IN) if tasks > FAN_IN else 0
    moved = members
    for part in closed:
        moved = moved.unionByName(part)
    moved = moved.select("bin", "into", F.col("shift").alias("_by"))
    return pieces.join(moved, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("into", "bin").alias("sequence_id"), (F.col("shift") + F.coalesce("_by", F.lit(0))).alias("offset"),
    )
