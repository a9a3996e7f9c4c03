"""Large JSON documents as many small ones, cut by byte range in parallel tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beforeafter.staging import broadcast_if_small, stage

#: Characters of a document that one row of the staged text holds, and some fragments more.
CHUNK_CHARS = 1 << 20

_ORDER = ("file", "block", "no")
_CHUNK = "file long, block long, no long, text string, quotes long"
_CHANGE = "file long, block long, no long, pops int, pushed string, tail string, least int"
_STATE = "file long, block long, no long, path string, pending string, member string, clean boolean, balanced boolean"
_PIECE = "file long, member string, block long, no long, head string, body string, foot string"

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_KEY = re.compile(r'("(?:[^"\\]|\\.)*")\s*:\s*$', re.DOTALL)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in schema.split(", ")], dtype=object)


def read_chunks(spark: SparkSession, path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The files' text in rows of some ``chunk_chars``, cut behind commas and written once.

    Commas end records here, so Spark cuts even a file without a line break into byte
    ranges (``spark.sql.files.maxPartitionBytes``) that tasks read by themselves.
    ``file`` (a hash of the path), ``block`` (where its range begins) and ``no`` give
    the order; ``quotes`` counts quotation marks that are not escaped. No escape
    sequence ends in a comma, so none is cut.
    """
    fragments = spark.read.option("lineSep", ",").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_of, no, held, size = None, 0, [], 0

        def chunk() -> pa.RecordBatch:
            text = b"".join(held).decode()
            return pa.RecordBatch.from_pandas(_frame([(*range_of, no, text, int((_bytes(text) == 34).sum()))], _CHUNK))

        for batch in batches:
            if not batch.num_rows:
                continue
            file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
            moved = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *moved], [*moved, batch.num_rows]):
                here = int(file[a]), int(block[a])
                if here != range_of or size >= chunk_chars:
                    if held:
                        yield chunk()
                    no = 0 if here != range_of else no + 1
                    range_of, held, size = here, [], 0
                held.append(_with_commas(batch.column("value").slice(a, b - a)))
                size += len(held[-1])
        if held:
            yield chunk()

    return stage(fragments.mapInArrow(glue, _CHUNK), "json-chunks")


def _with_commas(fragments: pa.Array) -> bytes:
    """The fragments behind each other, a comma behind each."""
    fragments = fragments.cast(pa.large_string())
    _, ends, data = fragments.buffers()
    ends = np.frombuffer(ends, np.int64)[fragments.offset : fragments.offset + len(fragments) + 1]
    out = np.full(int(ends[-1] - ends[0]) + len(fragments), 44, dtype=np.uint8)
    text = np.ones(len(out), dtype=bool)
    text[ends[1:] - ends[0] + np.arange(len(fragments))] = False
    if data is not None:
        out[text] = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return out.tobytes()


def _bytes(text: str) -> np.ndarray:
    """The text's bytes, escape sequences blanked out."""
    data = text.encode()
    if b"\\" in data:
        data = _ESCAPE.sub(b"__", data)
    return np.frombuffer(data, dtype=np.uint8)


def _structure(text: str, quoted: bool) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes, and places, characters and depths of the commas, braces and
    brackets outside strings; ``quoted``: the text starts inside one.

    Depths are relative to the start. An opening character counts with the depth it
    opens, a closing one with the depth it closes.
    """
    data = _bytes(text)
    outside = ((np.cumsum(data == 34) + quoted) & 1) == 0
    at = np.flatnonzero(outside & np.isin(data, np.frombuffer(b",{}[]", dtype=np.uint8)))
    kind = data[at]
    opens, closes = (kind == 123) | (kind == 91), (kind == 125) | (kind == 93)
    return text.encode(), at, kind, np.cumsum(opens.astype(np.int64) - closes) + closes


def _key(kind: int, text: str) -> str | None:
    """The key in front of an opening brace, as it stands there; null for none."""
    found = _KEY.search(text)
    return found[1] if kind == 123 and found else None


def _changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each chunk does to the state: how many levels it closes, the character and
    the text before it for each level it leaves open, the text behind its last
    structural character, and the least depth of one (null without any)."""
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            data, at, kind, depth = _structure(r.text, bool(r.quoted))
            if not len(at):
                rows.append((r.file, r.block, r.no, 0, "[]", r.text, None))
                continue
            after = depth - ((kind == 125) | (kind == 93))
            least, end = int(min(0, after.min())), int(after[-1])
            opens = np.flatnonzero(((kind == 123) | (kind == 91)) & (depth <= end))
            # The level still open at a depth is the one opened there last.
            last = {int(depth[i]): int(i) for i in opens}
            pushed = []
            for i in (last[d] for d in range(least + 1, end + 1)):
                begin = int(at[i - 1]) + 1 if i else 0
                pushed.append((int(kind[i]), data[begin : int(at[i])].decode(), i == 0))
            tail = data[int(at[-1]) + 1 :].decode()
            rows.append((r.file, r.block, r.no, -least, json.dumps(pushed), tail, int(depth.min())))
        yield _frame(rows, _CHANGE)


def _states(levels: int):
    """Keys of all open levels, and the member cut, at the start of each chunk; chunks
    come file by file in order. A file ends with a row that says whether it balances."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, path, pending, member, sound = None, [], "", None, True
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.file != file:
                    if file is not None:
                        rows.append((file, *[None] * 6, sound and not path))
                    file, path, pending, member, sound = r.file, [], "", None, True
                clean = not pending and len(path) <= levels + 1
                key_text = pending if len(path) <= levels else ""
                rows.append((file, r.block, r.no, json.dumps(path), key_text, member, clean, None))
                deep, met = len(path), not pd.isna(r.least)
                sound = sound and r.pops <= deep
                path = path[: max(0, deep - int(r.pops))]
                for kind, text, first in json.loads(r.pushed):
                    key = _key(kind, pending + text if first else text)
                    # The outermost object has no key.
                    path = [*path, "" if not path and kind == 123 else key]
                pending = r.tail if met else pending + r.tail
                if len(path) <= levels or (len(path) == levels + 1 and not pending):
                    member = None
                elif member is None or (met and deep + r.least <= levels + 1):
                    member = f"{r.block}:{r.no}"
            yield _frame(rows, _STATE)
        if file is not None:
            yield _frame([(file, *[None] * 6, sound and not path)], _STATE)

    return run


def _pieces(levels: int):
    """Whole objects at the last level as they stand in a chunk, and parts of the member
    that its start or end cuts, under the number of the chunk where the member begins."""
    floor = levels + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.itertuples(index=False):
                rows += _cut(r)
            yield _frame(rows, _PIECE)

    def _cut(r) -> Iterator[tuple]:
        data, at, kind, depth = _structure(r.text, bool(r.quoted))
        path = json.loads(r.path)
        depth, path = depth + len(path), path[:floor]
        here = f"{r.block}:{r.no}"

        def piece(begin: int, end: int, member: str | None = None) -> Iterator[tuple]:
            body = data[begin:end].decode()
            if len(path) >= floor and None not in path[:floor] and (body.strip() or member):
                keys = path[1:floor]
                yield (r.file, member, r.block, r.no, "{" + "".join(f"{k}:{{" for k in keys), body, "}" * floor)

        edges = np.flatnonzero(depth <= floor)
        begin = 0
        if len(path) >= floor and not r.clean:
            # The start lies inside a member: its text up to the first edge goes to it.
            if not len(edges):
                yield from piece(0, len(data), r.member)
                return
            begin = int(at[edges[0]])
            yield from piece(0, begin, r.member)
            begin += kind[edges[0]] == 44
        for i in edges[kind[edges] != 44]:
            where = int(at[i])
            if kind[i] in (123, 91):
                before = int(at[i - 1]) + 1 if i else 0
                text = ("" if i else r.pending) + data[before:where].decode()
                path.append("" if not path and kind[i] == 123 else _key(kind[i], text))
                begin = where + 1
            else:
                yield from piece(begin, where)
                path = path[:-1]
        # What is open at the end: whole members up to the last edge, then a cut one.
        if len(path) < floor:
            return
        last = int(edges[-1]) if len(edges) else None
        cut = begin if last is None or kind[last] != 44 or depth[last] != floor else int(at[last]) + 1
        if cut > begin:
            yield from piece(begin, cut - 1)
        if cut < len(data):
            yield from piece(cut, len(data), here)

    return run


def split_documents(spark: SparkSession, path: str, levels: int = 3, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """JSON files under ``path`` as small documents ``document``, each with the keys of
    ``levels`` nested objects around a run of members.

    Together they hold every member found below ``levels`` keys, once and as it stands,
    so ``nested_entries`` gives the same rows for them as for whole files, but a file of
    any size is read by many tasks. Members are cut where depth and quotation say so,
    both carried from one byte range to the next; a member that a range cuts is put
    together again. What lies less deep, or inside an array, is left out. A file whose
    braces do not balance gives nothing; a fault inside a member costs the piece that
    holds it. Documents that follow each other in one file are all read, and a key that
    an object repeats counts as often as it stands. No file gives no row.

    The text is written once and read twice: for what each chunk does to the state (a
    short row a chunk, chained file by file), and to cut it.
    """
    chunks = read_chunks(spark, path, chunk_chars)
    before = Window.partitionBy("file").orderBy("block", "no").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select(*_ORDER, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("quoted"))
    starts = broadcast_if_small(stage(starts, "json-quotes"))
    texts = chunks.drop("quotes").join(starts, list(_ORDER))
    changes = stage(texts.mapInPandas(_changes, _CHANGE), "json-changes")
    chained = changes.repartition("file").sortWithinPartitions(*_ORDER).mapInPandas(_states(levels), _STATE)
    states = stage(chained, "json-states")
    unsound = states.filter("block IS NULL AND NOT balanced").select("file")
    known = states.filter("block IS NOT NULL").drop("balanced")
    cut = texts.join(broadcast_if_small(known), list(_ORDER)).mapInPandas(_pieces(levels), _PIECE)
    cut = stage(cut.join(broadcast_if_small(unsound), "file", "left_anti"), "json-pieces")
    whole = cut.filter("member IS NULL").select(F.concat("head", "body", "foot").alias("document"))
    parts = cut.filter("member IS NOT NULL").groupBy("file", "member").agg(
        F.sort_array(F.collect_list(F.struct("block", "no", "body"))).alias("parts"),
        F.first("head").alias("head"),
        F.first("foot").alias("foot"),
    )
    body = F.array_join(F.transform("parts", lambda x: x["body"]), "")
    return whole.unionByName(parts.select(F.concat("head", body, "foot").alias("document")))
