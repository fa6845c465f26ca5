"""Line dedup with a tree of log templates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_key, materialise
from .textvec import U, buffers, mix, pieces, words

LEADING, ALIKE, MIN_DOCS = 3, 0.8, 10
FIELD = "<*>"
STRIP = " \t\r"
NOTHING, BLANKS = np.zeros(256, bool), np.zeros(256, bool)
BLANKS[[9, 13, 32]] = True


def tokens_of(line: str) -> list[str]:
    return [t for t in line.replace("\t", " ").replace("\r", " ").split(" ") if t]


def leaves_of(lines: pa.Array, leading: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line, none of them blank: its hash, its leaf (a hash of the leading tokens) and its number of tokens."""
    data, offsets = buffers(lines)
    h, leaf, n = np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int64)
    for i, j in pieces(offsets):
        raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        h[i:j] = words(raw, at, NOTHING)[0].view(np.int64)
        token, _, _, first = words(raw, at, BLANKS)
        n[i:j] = np.diff(first)
        own = np.zeros(j - i, U)
        for k in range(leading):
            has = n[i:j] > k
            own[has] = mix(own[has] ^ token[first[:-1][has] + k])
        leaf[i:j] = own.view(np.int64)
    return h, leaf, n


def lines_of(leading: int):
    """Batches of (__id, text) to rows (__id, line_no, h, leaf, n, line); `line` only where a batch has it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = pc.split_pattern(pc.fill_null(batch.column("text"), ""), "\n").cast(pa.large_list(pa.large_string()))
            offsets = split.offsets.to_numpy()
            flat = pc.replace_substring_regex(pc.utf8_trim(split.flatten(), STRIP), "[0-9]+", FIELD)
            count = np.diff(offsets)
            no = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], count)
            ids = np.repeat(batch.column("__id").to_numpy(), count)
            filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
            coded = flat.filter(pa.array(filled)).dictionary_encode()
            code = coded.indices.to_numpy()
            h, leaf, n = leaves_of(coded.dictionary, leading)
            first = np.ones(len(code), bool)
            first[np.unique(code, return_index=True)[1]] = False
            lines = pc.if_else(pa.array(first), pa.scalar(None, pa.large_string()), coded.dictionary.take(coded.indices))
            yield pa.RecordBatch.from_pydict({"__id": ids[filled], "line_no": no[filled], "h": h[code], "leaf": leaf[code], "n": n[code], "line": lines.cast(pa.string())})

    return run


class Leaf:
    """The templates of one leaf, whose lines all have `width` tokens.

    A line joins the template with the largest share of equal tokens if that is at least `alike` (the first of
    equal ones), whose other tokens become variable fields; else it starts a template.

    Of a line and a template that are alike, at most `spare` tokens differ, none of them a leading one. So if the other
    tokens are dealt to spare + 1 hands, one hand is the same in both: only templates that share a hand are compared.
    """

    def __init__(self, width: int, leading: int, alike: float):
        self.least = alike * width
        spare = width - int(np.ceil(self.least - 1e-9))
        tail = range(min(leading, width), width)
        self.hands = [list(tail[k :: spare + 1]) for k in range(min(spare + 1, max(1, len(tail))))] if spare < len(tail) else None
        self.known: list[dict] = [{} for _ in self.hands or ()]
        self.made: list[list[str]] = []
        self.heads: list[int] = []

    def near(self, row: list[str]) -> Iterator[int] | set[int]:
        if self.hands is None:
            return range(len(self.made))
        return {t for hand, known in zip(self.hands, self.known) for t in known.get(tuple(row[i] for i in hand), ())}

    def learn(self, t: int) -> None:
        row = self.made[t]
        for hand, known in zip(self.hands or (), self.known):
            at = known.setdefault(tuple(row[i] for i in hand), [])
            if t not in at[-1:]:
                at.append(t)

    def head(self, line: str, h: int) -> int:
        """The hash of the first line of the template that this one joins."""
        row = tokens_of(line)
        best, most = -1, -1
        for t in self.near(row):
            same = sum(map(str.__eq__, self.made[t], row))
            if same > most or same == most and t < best:
                best, most = t, same
        if best >= 0 and most >= self.least:
            if most < len(row):
                self.made[best] = [a if a == b else FIELD for a, b in zip(self.made[best], row)]
                self.learn(best)
            return self.heads[best]
        self.made.append(row)
        self.heads.append(h)
        self.learn(len(self.made) - 1)
        return h


def generalised(leading: int, alike: float):
    """Lines sorted by leaf, number of tokens and text to rows (h, template) where the template began with another line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaf, last, first = None, None, None, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for key, n, h, line in zip(*(batch.column(c).to_pylist() for c in ("leaf", "n", "h", "line"))):
                if (key, n) != now:
                    now, leaf, last, first = (key, n), None, line, (line, h)
                elif line != last:
                    if leaf is None:  # most leaves have one line and need no templates
                        leaf = Leaf(n, leading, alike)
                        leaf.head(*first)
                    head, last = leaf.head(line, h), line
                    if head != h:
                        out.append((h, head))
            yield pa.RecordBatch.from_pydict({"h": pa.array([x[0] for x in out], pa.int64()), "template": pa.array([x[1] for x in out], pa.int64())})

    return run


def line_dedup(docs: DataFrame, leading: int = LEADING, alike: float = ALIKE, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, line_no, template_docs): the lines to drop, whose template occurs in min_docs documents or more.

    Digits become fields first. The tree parses a line by its number of tokens and its `leading` first tokens; in
    a leaf, distinct lines in order of their text join templates as in Leaf. A template's documents
    are counted exactly over the corpus, each id once.

    Only distinct lines travel as text, by leaf; counting and dropping use hashes. A leaf's lines stream through one task,
    which holds its templates and not its lines.

    line_no counts the text's lines, split at newlines, from 0. Blank lines are never dropped; null and empty
    texts have none. Rows of the same doc_id (null is one, too) count as one document, and a line of repeated
    rows is listed once. Other columns don't matter. An empty table gives no rows.
    """
    rows = docs.select(id_key().alias("__id"), "text")
    lines = materialise(rows.mapInArrow(lines_of(leading), "__id long, line_no long, h long, leaf long, n long, line string"))
    distinct = lines.filter("line is not null").select("leaf", "n", "h", "line").repartition("leaf").sortWithinPartitions("leaf", "n", "line")
    merged = distinct.mapInArrow(generalised(leading, alike), "h long, template long").withColumnRenamed("h", "__h")
    places = lines.select("__id", "line_no", "h").join(merged, F.col("h") == F.col("__h"), "left")
    places = materialise(places.select("__id", "line_no", F.coalesce("template", "h").alias("template")).distinct())
    counts = places.select("template", "__id").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("template_docs"))
    recurring = counts.filter(F.col("template_docs") >= min_docs)
    found = places.join(recurring, "template")
    return found.select(F.nullif("__id", F.lit(-(2**63))).alias("doc_id"), "line_no", "template_docs")


def without_lines(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the lines `dropped` (doc_id, line_no) of their texts.

    A text that loses nothing stays as it is; a null one stays null. Rows of one doc_id lose the same line numbers, as
    line_dedup lists them for the id; null is an id like any. All columns of docs are returned.
    """
    own = [f"__c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)], id_key().alias("__id"), F.col("text").alias("__text"))
    cuts = dropped.groupBy(id_key().alias("__id")).agg(F.collect_set("line_no").alias("__cuts"))
    rows = rows.join(cuts, "__id", "left")
    left = F.filter(F.split("__text", "\n"), lambda t, i: ~F.array_contains("__cuts", i.cast("long")))
    text = F.when(F.col("__cuts").isNull(), F.col("__text")).otherwise(F.array_join(left, "\n"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(o).alias(c) for c, o in zip(docs.columns, own)])
