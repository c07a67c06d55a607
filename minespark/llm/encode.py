"""Encoding of a whole corpus, long texts in parallel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minespark.llm import tokenizer
from minespark.llm.tokenizer import ByteBpe

#: Code points up to which a text is encoded by one call.
LONG_TEXT = 8192
#: Code points of the units into which a longer text is cut, and of the leaves of an unsplit piece.
UNIT = 4096
#: Tokens on each side of a join that are encoded again first; doubled until both sides agree.
WINDOW = 4
#: Neighbouring leaves that one task joins; what it makes of them is joined again.
JOINED_AT_ONCE = 64


def encode_corpus(df: DataFrame, *, doc_id: str, text: str, name: str = "byte_bpe_50k", folder: str = tokenizer.FOLDER, long_text: int = LONG_TEXT, unit: int = UNIT) -> DataFrame:
    """(doc_id, ids): the token ids of each row's text; null and empty texts give an empty list.

    One row out for each row in, repeated rows and null ids included; no special tokens, their strings are
    ordinary text. Other columns are not read. An empty table gives no rows.

    How: texts up to `long_text` code points are encoded where they are read, longer ones by long_ids().
    """
    rows, is_long, key = _rows(df, doc_id, text, long_text)
    short = rows.where(~is_long).mapInArrow(lambda it: _encode_rows(it, name, folder), f"doc_id {key}, ids array<int>")
    return short.unionByName(long_ids(rows.where(is_long), name, folder, unit)).withColumnRenamed("doc_id", doc_id)


def _rows(df: DataFrame, doc_id: str, text: str, long_text: int) -> tuple[DataFrame, Column, str]:
    """(doc_id, text), whether a text is long, and the type of the id."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows, F.coalesce(F.length("text") > long_text, F.lit(False)), dict(rows.dtypes)["doc_id"]


def long_ids(rows: DataFrame, name: str, folder: str, unit: int = UNIT, joined_at_once: int = JOINED_AT_ONCE) -> DataFrame:
    """(doc_id, ids) of long texts, one row for each row (doc_id, text).

    A text, repeated rows of one id once, is pre-split and cut between pieces into units of about `unit` code points; a piece longer than that, which
    nothing splits, is halved until its leaves fit. Units of all texts are spread over the
    cluster and encoded there. Units between pieces simply follow each other. Leaves of one piece are joined pairwise up the
    tree: a window of tokens around the join is encoded again and grows until its first token is the
    left side's and its last the right side's. Neighbouring tokens then all are such as the
    encoder itself puts side by side, which makes the whole the encoder's result. The tree's lower levels are spread too:
    `joined_at_once` neighbouring leaves to a task; where its results meet, the text's own task joins them.
    """
    key = dict(rows.dtypes)["doc_id"]
    units_of = f"doc_id {key}, copies long, text_key string, n int, piece int, leaf int, leaves int"
    texts = rows.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    cut = texts.mapInArrow(lambda it: _cut_rows(it, name, folder, unit), f"{units_of}, text binary, whole boolean")
    units = cut.repartition("text_key", "n").mapInArrow(lambda it: _encode_units(it, name, folder), f"{units_of}, ids array<int>")
    leaves = units.where("leaves > 1").groupBy("doc_id", "text_key", F.floor(F.col("n") / joined_at_once))
    joined = leaves.applyInPandas(lambda p: _join_leaves(p, name, folder), f"{units_of}, ids array<int>")
    whole = units.where("leaves = 1").unionByName(joined).groupBy("doc_id", "text_key").applyInPandas(lambda p: _join_units(p, name, folder), f"doc_id {key}, copies long, ids array<int>")
    return whole.select("doc_id", "ids", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "ids")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _encode_rows(batches: Iterator[pa.RecordBatch], name: str, folder: str) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer.load(name, folder)
    none = np.zeros(0, np.int32)
    for b in batches:
        for at in range(0, b.num_rows, 2000):
            part = b.slice(at, 2000)
            ids = [bpe.encode(t) if t else none for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(ids)], names=["doc_id", "ids"])


def cut_text(bpe: ByteBpe, text: str, unit: int) -> Iterator[tuple[int, int, bytes, bool]]:
    """(piece, leaf, bytes, whole): units of whole pieces (leaf 0), or the leaves of one piece (whole false).

    A unit never ends in white space: the encoder splits a run of it by what follows. Where a long piece
    follows white space, the white pieces before it go alone.
    """
    n, start = 0, 0
    white: list[tuple[int, int]] = []  # pieces since the last place where a unit may end
    for m in bpe.split.finditer(text):
        a, z = m.span()
        may_end = a > start and not bpe.white_end.match(text[a - 1])
        if may_end:
            white = []
        if z - a > unit:
            end = white[0][0] if white else a
            if end > start:
                yield n, 0, text[start:end].encode(), True
                n += 1
            for b, e in white:
                yield n, 0, text[b:e].encode(), False
                n += 1
            for leaf, part in enumerate(_halves(text[a:z], unit)):
                yield n, leaf, part.encode(), False
            n, start, white = n + 1, z, []
            continue
        if may_end and z - start > unit:
            yield n, 0, text[start:a].encode(), True
            n, start = n + 1, a
        if bpe.white_end.match(text[z - 1]):
            white.append((a, z))
    if start < len(text):
        yield n, 0, text[start:].encode(), True


def _halves(piece: str, unit: int) -> list[str]:
    if len(piece) <= unit:
        return [piece]
    mid = len(piece) // 2
    return _halves(piece[:mid], unit) + _halves(piece[mid:], unit)


_UNIT = ["doc_id", "copies", "text_key", "n", "piece", "leaf", "leaves"]


def _cut_rows(batches: Iterator[pa.RecordBatch], name: str, folder: str, unit: int) -> Iterator[pa.RecordBatch]:
    import hashlib

    bpe = tokenizer.load(name, folder)
    for b in batches:
        for one in range(b.num_rows):
            text = b.column("text")[one].as_py()
            key = hashlib.sha256(text.encode()).hexdigest()
            cuts = list(cut_text(bpe, text, unit))
            k = len(cuts)
            leaves = np.bincount([c[0] for c in cuts])  # of each piece
            cols = [
                pa.repeat(b.column("doc_id")[one], k), pa.repeat(b.column("copies")[one], k), pa.array([key] * k), pa.array(range(k), pa.int32()), pa.array([c[0] for c in cuts], pa.int32()),
                pa.array([c[1] for c in cuts], pa.int32()), pa.array([leaves[c[0]] for c in cuts], pa.int32()), pa.array([c[2] for c in cuts], pa.binary()), pa.array([c[3] for c in cuts]),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=[*_UNIT, "text", "whole"])


def _encode_units(batches: Iterator[pa.RecordBatch], name: str, folder: str) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer.load(name, folder)
    for b in batches:
        texts, whole = b.column("text").to_pylist(), b.column("whole").to_pylist()
        ids = [bpe.encode(t.decode()) if w else np.array(bpe.encode_piece(t), np.int32) for t, w in zip(texts, whole)]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _UNIT), _lists(ids)], names=[*_UNIT, "ids"])


def _join_leaves(p: pd.DataFrame, name: str, folder: str) -> pd.DataFrame:
    """Neighbouring leaves of a text's pieces joined: one row of each piece, in place of its first leaf."""
    bpe = tokenizer.load(name, folder)
    p = p.sort_values("n")
    first = p.drop_duplicates("piece").copy()
    first["ids"] = [join_leaves(bpe, [np.asarray(x, np.int32) for x in piece["ids"]]) for _, piece in p.groupby("piece", sort=True)]
    return first[[*_UNIT, "ids"]]


def _join_units(p: pd.DataFrame, name: str, folder: str) -> pd.DataFrame:
    """One text's units to its ids."""
    bpe = tokenizer.load(name, folder)
    p = p.sort_values("n")
    out = [join_leaves(bpe, [np.asarray(x, np.int32) for x in piece["ids"]]) for _, piece in p.groupby("piece", sort=True)]
    one = p[["doc_id", "copies"]].iloc[:1].copy()
    one["ids"] = [np.concatenate(out)]
    return one


def join_leaves(bpe: ByteBpe, leaves: list[np.ndarray]) -> np.ndarray:
    """Ids of a piece from those of its leaves, joined pairwise level by level."""
    while len(leaves) > 1:
        paired = [join_two(bpe, a, b) for a, b in zip(leaves[::2], leaves[1::2])]
        leaves = paired + leaves[len(leaves) - len(leaves) % 2 :]
    return leaves[0]


def join_two(bpe: ByteBpe, left: np.ndarray, right: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Ids of two neighbouring stretches of one piece: the window around the join grows until both sides agree."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    w = window
    while True:
        a, b = left[-w:], right[:w]
        ids = bpe.encode_piece(b"".join(bpe.bytes_of[int(i)] for i in (*a, *b)))
        start_ok = w >= len(left) or ids[0] == a[0]
        end_ok = w >= len(right) or ids[-1] == b[-1]
        if start_ok and end_ok and (len(ids) > 1 or (w >= len(left) and w >= len(right))):
            return np.concatenate([left[: max(0, len(left) - w)], np.array(ids, np.int32), right[w:]])
        w *= 2
