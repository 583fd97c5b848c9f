"""Bounded-space online packing of tokenised documents into fixed-length sequences.

Each partition streams its documents past a fixed number of open windows. Whole windows are cut off
long documents at once; the rest of a document goes to the open window it fits best. When it fits
none, the fullest window is emitted: topped up with the document's head if its gap is worth a cut,
else padded. Windows still open at a partition's end are leftovers: their pieces from many partitions
are merged best-fit, longest first. Only those leftovers are shuffled, without any token.
"""
from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import map_batches
from chatloom.session import cut_lineage

LENGTH = 1024
OPEN_WINDOWS = 32
#: gaps up to this many tokens are padded rather than filled by cutting a document
MAX_GAP = 8
#: leftovers of so many partitions are merged together: at most MERGE * OPEN_WINDOWS windows
MERGE = 64
END_ID = 0


@lru_cache(maxsize=4)
def byte_bpe(ranks: str, special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)):
    """text -> ids, for a byte-level BPE whose ranks are in ``ranks``. Special strings inside a text
    become their ids. Built once per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=dict(special))
    return lambda text: coder.encode(text, allowed_special="all")


class Windows:
    """Open windows of one partition. ``place`` yields the windows it emits, as lists of pieces."""

    def __init__(self, length: int, limit: int, max_gap: int):
        self.length, self.limit, self.max_gap = length, limit, max_gap
        self.open: list[tuple[int, int]] = []          # (free tokens, window), sorted
        self.pieces: dict[int, list] = {}
        self.made = 0

    def new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, cut, start: int, end: int):
        """``cut(start, end)`` makes the piece of those tokens."""
        while end - start >= self.length:
            yield self.new(), [cut(start, start + self.length)]
            start += self.length
        while start < end:
            need = end - start
            at = bisect_left(self.open, (need, -1))
            if at < len(self.open):                    # best fit: the smallest gap that holds it
                free, window = self.open.pop(at)
                self.pieces[window].append(cut(start, end))
                if free == need:
                    yield window, self.pieces.pop(window)
                else:
                    insort(self.open, (free - need, window))
                return
            if len(self.open) < self.limit:
                window = self.new()
                self.pieces[window] = [cut(start, end)]
                insort(self.open, (self.length - need, window))
                return
            gap, window = self.open.pop(0)             # none fits: emit the fullest
            if gap > self.max_gap:
                self.pieces[window].append(cut(start, start + gap))
                start += gap
            yield window, self.pieces.pop(window)


PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def pack_documents(docs: DataFrame, load, load_args: tuple, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   open_windows: int = OPEN_WINDOWS, max_gap: int = MAX_GAP, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ``ids``
    if ``with_ids``). ``load(*load_args)`` gives the tokenizer in each worker.

    Every document, also a null or empty text, ends with ``end_id``, so it has at least one token and
    one piece. Repeated rows are packed as documents of their own.
    """
    kind = docs.schema[key].dataType.simpleString()
    extra = ", ids array<int>" if with_ids else ""
    names = [part.strip().split(" ")[0] for part in (PIECE + extra).split(",")]

    def run(batches):
        encode = load(*load_args)
        windows = Windows(length, open_windows, max_gap)
        part = TaskContext.get().partitionId()
        rows: list[tuple] = []

        def flush(is_open: bool):
            cols = list(zip(*rows)) or [()] * (len(names) + 3)
            out = dict(zip(["id", *names, "sequence", "offset"], cols))
            out |= {"part": [part] * len(rows), "open": [is_open] * len(rows)}
            rows.clear()
            return out

        def emit(window, pieces):
            at = 0
            for p in pieces:
                rows.append((*p, window, at))
                at += p[2]

        for b in batches:
            for doc, body in zip(b["id"], b["text"]):
                ids = np.array([*encode(body or ""), end_id], dtype="<u4")
                total = len(ids)

                def cut(start, end, doc=doc, ids=ids, total=total):
                    own = ids[start:end]
                    piece = (doc, start, end - start, zlib.crc32(own.tobytes()), total)
                    return (*piece, own.tolist()) if with_ids else piece

                for window, pieces in windows.place(cut, 0, total):
                    emit(window, pieces)
            if rows:
                yield flush(False)
        for window in sorted(windows.pieces):
            emit(window, windows.pieces[window])
        if rows:
            yield flush(True)

    schema = f"id {kind}, {PIECE}{extra}, sequence long, offset long, part long, open boolean"
    # written once: the two branches below would tokenise twice
    pieces = cut_lineage(map_batches(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), schema, run))
    cols = [F.col("id").alias(key), *names]
    done = pieces.where(~F.col("open")).select(*cols, (F.shiftleft("part", 32) + F.col("sequence")).alias("sequence_id"), "offset")
    left = pieces.where("open").withColumn("group", F.floor(F.col("part") / MERGE).cast("long"))
    merged = merge_leftovers(left, length, kind, names, extra)
    return done.unionByName(merged.select(*cols, "sequence_id", "offset"))


def merge_leftovers(left: DataFrame, length: int, kind: str, names: list[str], extra: str) -> DataFrame:
    """Leftover pieces best-fit into shared windows, longest first; a group holds a bounded number."""
    def merge(pdf):
        pdf = pdf.sort_values(["length", "id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        group = int(pdf["group"].iloc[0])
        free: list[tuple[int, int]] = []
        sequence, offset = [], []
        made = 0
        for n in pdf["length"]:
            at = bisect_left(free, (n, -1))
            if at < len(free):
                gap, window = free.pop(at)
            else:
                gap, window = length, made
                made += 1
            sequence.append((1 << 62) + (group << 32) + window)
            offset.append(length - gap)
            if gap > n:
                insort(free, (gap - n, window))
        return pdf.assign(sequence_id=sequence, offset=offset)[["id", *names, "sequence_id", "offset"]]

    return left.groupBy("group").applyInPandas(merge, f"id {kind}, {PIECE}{extra}, sequence_id long, offset long")
