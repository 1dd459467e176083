"""Token sequences of equal length, packed so that attention cost is balanced and little is padded."""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one packing task takes in, about; and shares of the sequence numbers that a task may use.
GROUP_BYTES = 2 << 20
NUMBERS = 1 << 32
END = 0


@cache
def encoder(ranks_path: str, file_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Byte-level BPE: the ids that the vocabulary's tokenizer file gives as it loads, encoded by its rank file.

    Tokens that the tokenizer file adds to the vocabulary have their own ids wherever a text holds them.
    """
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(file_path, "rb") as whole:
        added = {token["content"]: token["id"] for token in json.load(whole)["added_tokens"]}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> np.ndarray:
        return np.array(encoding.encode(text, allowed_special="all"), "<u4")

    return encode


def byte_bpe(name: str = "byte_bpe_50k") -> Callable[[], Callable[[str], np.ndarray]]:
    """What makes the encoder of an installed public vocabulary, where it is called."""
    import public_tokenizers

    ranks, file = (str(public_tokenizers.path(f"{name}.{form}")) for form in ("tiktoken", "json"))
    pattern = public_tokenizers.PATTERN
    return lambda: encoder(ranks, file, pattern)


def cost(lengths: np.ndarray, linear: float, quadratic: float) -> np.ndarray:
    """Estimated cost of pieces: the layers' work per token and attention within the piece."""
    return linear * lengths + quadratic * lengths.astype(float) ** 2


def pack(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place pieces of at most ``capacity`` tokens into ceil(total / capacity) sequences.

    In descending length, each piece goes to the sequence of lowest cost so far that still has room for it. What fits
    nowhere whole is cut and goes, part by part, to the sequences of lowest cost with any room: as many sequences as the
    tokens need at least, so that fewer than ``capacity`` places stay empty. Returns piece, sequence, length of each
    part, a piece's parts in their order.
    """
    count = -(-int(lengths.sum()) // capacity)
    room, spent = np.full(count, capacity), np.zeros(count)
    weights = cost(lengths, linear, quadratic)
    placed: list[tuple[int, int, int]] = []
    left: list[int] = []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        best = int(np.argmin(np.where(room >= length, spent, np.inf)))
        if room[best] < length:
            left.append(piece)
            continue
        room[best] -= length
        spent[best] += weights[piece]
        placed.append((piece, best, length))
    for piece in left:
        length = int(lengths[piece])
        while length:
            best = int(np.argmin(np.where(room > 0, spent, np.inf)))
            part = min(length, int(room[best]))
            room[best] -= part
            spent[best] += float(cost(np.array([part]), linear, quadratic)[0])
            length -= part
            placed.append((piece, best, part))
    columns = np.array(placed, np.int64).reshape(-1, 3)
    order = np.argsort(columns[:, 0], kind="stable")
    return columns[order, 0], columns[order, 1], columns[order, 2]


def _pieces(batches: Iterable[pa.RecordBatch], encode, capacity: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Tokens of each document, cut at every ``capacity``; dealt to groups by place in the task."""
    task = TaskContext.get().partitionId()
    turn = zlib.crc32(str(task).encode())
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "start": [], "doc_tokens": [], "ids": [], "group": []}
        for key, text in zip(batch["doc_id"], batch["text"], strict=True):
            ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
            for start in range(0, len(ids), capacity):
                out["doc_id"].append(key.as_py())
                out["start"].append(start)
                out["doc_tokens"].append(len(ids))
                out["ids"].append(ids[start : start + capacity].tobytes())
                out["group"].append(turn % groups)
                turn += 1
            if len(out["ids"]) >= 2048:
                yield _batch(out, batch.schema)
                out = {k: [] for k in out}
        yield _batch(out, batch.schema)


def _batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    kinds = {"doc_id": schema.field("doc_id").type, "start": pa.int64(), "doc_tokens": pa.int64(), "ids": pa.binary(), "group": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(columns[k], kind) for k, kind in kinds.items()], list(kinds))


def packed(
    docs: DataFrame, encode_with: Callable[[], Callable[[str], np.ndarray]], capacity: int = 1024, linear: float = 1.0,
    quadratic: float = 1 / 1024, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Every document's tokens in sequences of at most ``capacity``: a row per piece.

    Columns: doc_id, start (ids of the document before the piece), length, ids (little-endian unsigned 32-bit), doc_tokens
    (all ids of the document, with the closing id 0), sequence_id, offset (of the piece in its sequence, gapless).

    Documents are cut at every ``capacity`` ids. Pieces are dealt evenly to groups of about ``group_bytes`` of text,
    whatever their documents, and each group is packed in one task by ``pack``: the cost estimate is ``linear`` per
    token plus ``quadratic`` per pair of tokens of a piece. Fewer than ``capacity`` places of a group stay empty. A null or
    empty text is the closing id alone; rows that repeat are packed as often. Other columns are not read. An empty
    table gives no rows. ``encode_with`` makes the encoder on the executors.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start LONG, doc_tokens LONG, ids BINARY"
    total = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    groups = max(1, math.ceil(total / group_bytes))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(batches, encode_with(), capacity, groups)

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        ids = rows["ids"].to_pylist()
        piece, sequence, length = pack(np.array([len(x) // 4 for x in ids]), capacity, linear, quadratic)
        parts = pd.Series(length)
        before = (parts.groupby(piece).cumsum() - parts).to_numpy()
        offset = (parts.groupby(sequence).cumsum() - parts).to_numpy()
        taken = rows.take(piece)
        return pa.table({
            "doc_id": taken["doc_id"], "start": taken["start"].to_numpy() + before, "length": length,
            "ids": pa.array([ids[p][4 * a : 4 * (a + n)] for p, a, n in zip(piece, before, length, strict=True)], pa.binary()),
            "doc_tokens": taken["doc_tokens"], "sequence_id": key[0].as_py() * NUMBERS + sequence, "offset": offset,
        })

    pieces = docs.select("doc_id", "text").mapInArrow(cut, schema + ", group LONG")
    result = schema.replace("doc_tokens LONG, ids BINARY", "length LONG, ids BINARY, doc_tokens LONG, sequence_id LONG, offset LONG")
    return pieces.groupBy("group").applyInArrow(place, result)
