"""Substring dedup: Rabin-Karp hashes of every window of tokens, counted over the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANK, NULL_ID, id_key
from .textvec import BLANK_TABLE, U, buffers, mix, pieces, windows, words

WIDTH = 50
BYTES_PER_PART = 16_000_000
FAN, REGION = 4096, 1 << 16
CODEC = pa.Codec("zstd", compression_level=1)


def squeeze(ids: np.ndarray, at: np.ndarray) -> bytes:
    """Ids and places, sorted by them, as compressed differences."""
    id_step, at_step = np.diff(ids, prepend=np.int64(0)), np.diff(at, prepend=np.int64(0))
    # one byte a place is enough for most; the rest follow in full
    small = np.where((at_step >= 0) & (at_step < 255), at_step, 255).astype(np.uint8)
    moved = np.flatnonzero(id_step)
    body = np.array([len(ids), len(moved)], np.int64).tobytes() + moved.astype(np.int64).tobytes() + id_step[moved].tobytes()
    body += small.tobytes() + at_step[small == 255].astype(np.int64).tobytes()
    return np.int64(len(body)).tobytes() + CODEC.compress(body, asbytes=True)


def unsqueeze(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = CODEC.decompress(blob[8:], decompressed_size=int(np.frombuffer(blob[:8], np.int64)[0]), asbytes=True)
    n, m = np.frombuffer(body, np.int64, 2)
    moved, steps = np.frombuffer(body, np.int64, m, 16), np.frombuffer(body, np.int64, m, 16 + 8 * m)
    id_step = np.zeros(n, np.int64)
    id_step[moved] = steps
    at_step = np.frombuffer(body, np.uint8, n, 16 + 16 * m).astype(np.int64)
    at_step[at_step == 255] = np.frombuffer(body, np.int64, -1, 16 + 16 * m + n)
    return np.cumsum(id_step), np.cumsum(at_step)


def spread(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part's members, in their order."""
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    cut = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cut)):
        yield int(p), order[cut[p] : cut[p + 1]]


ROW = "part long, hashes binary, reps binary, places binary"
Places = tuple[np.ndarray, np.ndarray]


def packed(singles: list[tuple[int, np.ndarray, Places]], reps: list[tuple[int, np.ndarray]], known: list[tuple[int, Places]]) -> pa.RecordBatch:
    """Rows of three kinds: hashes with their places; hashes alone; places alone."""
    rows = [(p, h.tobytes(), b"", squeeze(*x)) for p, h, x in singles] + [(p, b"", h.tobytes(), b"") for p, h in reps] + [(p, b"", b"", squeeze(*x)) for p, x in known]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["part", "hashes", "reps", "places"])


def region(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the document and the stretch of it in which a place lies."""
    return mix(ids.view(U) ^ mix((at // REGION).astype(U)))


def arranged(ids: np.ndarray, at: np.ndarray, bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, Places]]:
    """Each bucket's distinct places, sorted."""
    for b, i in spread(bucket, buckets):
        i = i[np.lexsort((at[i], ids[i]))]
        x, y = ids[i], at[i]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        yield b, (x[new], y[new])


def window_blobs(width: int, parts: int):
    """Batches of (__id, text) to rows of ROW by part of the windows' hash.

    What repeats within some two million windows is settled there: the places go on alone, and one hash
    without a place stands for all of them. So a window that half of all documents hold is sent once in two million.
    """
    enough = min(2_000_000, 4000 * parts)

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, g, ids, at = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(h)
        same = (h[order[1:]] == h[order[:-1]]) & (g[order[1:]] == g[order[:-1]])
        often, rep = np.zeros(len(h), bool), np.zeros(len(h), bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        rep[order[:-1][same & ~np.concatenate([[False], same[:-1]])]] = True
        part = (g % U(parts)).astype(np.int64)
        one, rep = np.flatnonzero(~often), np.flatnonzero(rep)
        singles = [(p, h[one[i]], (ids[one[i]], at[one[i]])) for p, i in spread(part[one], parts)]
        x, y = ids[often], at[often]
        return packed(singles, [(p, h[rep[i]]) for p, i in spread(part[rep], parts)], list(arranged(x, y, (region(x, y) % U(parts)).astype(np.int64), parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            ids = batch.column("__id").to_numpy(zero_copy_only=False)
            for i, j in pieces(offsets):
                hashes, _, _, first = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], BLANK_TABLE)
                for h, g, text, at in windows(hashes, first, width):
                    held.append((h, g, ids[i:j][text], at))
                    n += len(h)
                    if n >= enough:
                        yield flush(held)
                        held, n = [], 0
        if n:
            yield flush(held)

    return run


def finer(subs: int):
    """Rows of ROW sorted by part to rows by `subs` times as many parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            sub = lambda x: (x >> U(32)) % U(subs)
            singles, reps, known = [], [], []
            if held["hashes"]:
                h, ids, at = (np.concatenate(x) for x in zip(*held["hashes"]))
                singles = [(now * subs + p, h[i], (ids[i], at[i])) for p, i in spread(sub(h).astype(np.int64), subs)]
            if held["reps"]:
                h = np.unique(np.concatenate(held["reps"]))
                reps = [(now * subs + p, h[i]) for p, i in spread(sub(h).astype(np.int64), subs)]
            if held["places"]:
                ids, at = (np.concatenate(x) for x in zip(*held["places"]))
                known = [(now * subs + p, x) for p, x in arranged(ids, at, sub(region(ids, at)).astype(np.int64), subs)]
            for kind in held.values():
                kind.clear()
            return packed(singles, reps, known)

        held: dict[str, list] = {"hashes": [], "reps": [], "places": []}
        now, n = None, 0
        for batch in batches:
            for k, p in enumerate(batch.column("part").to_pylist()):
                if n and (p != now or n >= 2_000_000):
                    yield flush()
                    n = 0
                now = p
                hashes, reps, places = (batch.column(c)[k].as_py() for c in ("hashes", "reps", "places"))
                if hashes:
                    h = np.frombuffer(hashes, U)
                    held["hashes"].append((h, *unsqueeze(places)))
                    n += len(h)
                elif reps:
                    held["reps"].append(np.frombuffer(reps, U))
                    n += len(reps) // 8
                else:
                    held["places"].append(unsqueeze(places))
                    n += len(held["places"][-1][0])
        if n:
            yield flush()

    return run


def repeated(parts: int):
    """A part's places whose window occurs twice or more, as rows of ROW by region of the document."""

    def run(group: pa.Table) -> pa.Table:
        blobs = {c: group[c].to_pylist() for c in ("hashes", "reps", "places")}
        h = np.frombuffer(b"".join(blobs["hashes"]), U)
        every = np.concatenate([h, np.frombuffer(b"".join(blobs["reps"]), U)])
        order = np.argsort(every)
        ordered = every[order]
        same = ordered[1:] == ordered[:-1]
        flag = np.zeros(len(every), bool)
        flag[order[1:][same]] = True
        flag[order[:-1][same]] = True
        ids, at, done = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for own, blob in zip(blobs["hashes"], blobs["places"]):
            if own:
                i, a = unsqueeze(blob)
                keep = flag[done : done + len(i)]
                ids.append(i[keep])
                at.append(a[keep])
                done += len(i)
            elif blob:
                i, a = unsqueeze(blob)
                ids.append(i)
                at.append(a)
        ids, at = np.concatenate(ids), np.concatenate(at)
        return pa.Table.from_batches([packed([], [], list(arranged(ids, at, (region(ids, at) % U(parts)).astype(np.int64), parts)))])

    return run


def intervals(width: int):
    """The windows of a part of the documents' regions, merged where they touch."""

    def run(group: pa.Table) -> pa.Table:
        both = [unsqueeze(b) for b in group["places"].to_pylist()]
        ids, at = np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both])
        order = np.lexsort((at, ids))
        ids, at = ids[order], at[order]
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (at[1:] > at[:-1] + width)])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(ids)) - 1
        return pa.table({"doc_id": ids[begin], "start_token": at[begin], "end_token": at[end] + width})

    return run


def joined(rows: DataFrame) -> DataFrame:
    """Intervals of one document that touch, merged; there are few of them, as windows were merged before."""
    order = W.partitionBy("doc_id").orderBy("start_token", "end_token")
    reach = F.max("end_token").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("__new", F.when(F.col("start_token") <= reach, 0).otherwise(1))
    rows = rows.withColumn("__run", F.sum("__new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy("doc_id", "__run").agg(F.min("start_token").alias("start_token"), F.max("end_token").alias("end_token")).drop("__run")


def substring_dedup(docs: DataFrame, width: int = WIDTH, bytes_per_part: int = BYTES_PER_PART, fan: int = FAN) -> DataFrame:
    """(doc_id, start_token, end_token): maximal runs of tokens covered by windows that occur twice or more.

    Every window of `width` tokens of every text is hashed and counted over the corpus, also where it repeats
    within one text. Every occurrence is listed, the first one too. Windows that overlap or touch
    merge. Tokens are runs without blanks and count from 0; end_token is exclusive.

    Windows travel by part of a second hash, 8 bytes and a compressed place each; of what repeats only the place
    returns, by stretch of the document. The number of parts follows the bytes of text; beyond `fan` of them windows go
    to fan parts first and from there on to finer ones, so that packets stay large. A window counts as repeated if 64
    bits of one hash and the part by another are equal: of n windows, about n**2 / 2**65 / min(parts, fan) by mistake.

    Null, empty and shorter texts have no window. Repeated rows repeat all of their windows. Rows of the same
    doc_id share one list. A row with a null doc_id counts as an occurrence but isn't listed. A long text is worked
    through in blocks; it needs some 60 bytes of memory a word. Other columns don't matter. An empty table gives no rows.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, math.ceil(total / bytes_per_part))
    subs = math.ceil(parts / fan)
    parts = math.ceil(parts / subs)

    def split(rows: DataFrame) -> DataFrame:
        if subs == 1:
            return rows
        return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(finer(subs), ROW)

    rows = split(docs.select(id_key().alias("__id"), "text").mapInArrow(window_blobs(width, parts), ROW))
    # by number, so that tasks aren't merged beyond a few parts as the input grows
    found = split(rows.repartition(parts * subs, "part").groupBy("part").applyInArrow(repeated(parts), ROW))
    merged = found.groupBy("part").applyInArrow(intervals(width), "doc_id long, start_token long, end_token long")
    return joined(merged.filter(F.col("doc_id") != NULL_ID))


def without_repeats(docs: DataFrame, intervals: DataFrame) -> DataFrame:
    """docs with the tokens of `intervals` taken out of their texts; what remains is joined by single blanks.

    A text without an interval stays as it is, byte for byte; a null one stays null. Rows of one doc_id, null
    excepted, lose the same intervals. All columns of docs are returned.
    """
    own = [f"__c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)], F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    cuts = intervals.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("start_token", "end_token")).alias("__cuts"))
    rows = rows.join(cuts, "__id", "left")
    tokens = F.split(F.btrim("__text", F.lit(BLANK)), "[ \t\n\r]+")
    left = F.filter(tokens, lambda t, i: ~F.exists("__cuts", lambda c: (i >= c["start_token"]) & (i < c["end_token"])))
    text = F.when(F.col("__cuts").isNull(), F.col("__text")).otherwise(F.array_join(left, " "))
    return rows.select(*[text.alias(c) if c == "text" else F.col(o).alias(c) for c, o in zip(docs.columns, own)])
