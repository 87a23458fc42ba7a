"""Splitting oversized items at natural boundaries (problem 5).

Method: byte-range processing.  Texts and files are read in ranges with a halo; each
range lists the boundaries it owns; the lists are stitched into one boundary table,
lengths come from prefix sums, and pieces are emitted by offset.  Where to cut is
decided per window of the running offset, so no item is ever walked as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketlake.session import cut

#: Characters that one range owns, and characters it sees beyond.
RANGE_CHARS = 1 << 16
HALO = 64
#: A line that holds only a form feed parts two pages.
PAGE_MARK = r"(?:(?<=\n)|^)\f(?=\n|$)"
#: Strengths of boundaries.
HEADING, PARAGRAPH, SENTENCE, WORD = 4, 3, 2, 1
#: Of the character starts within so many bytes of a file only the last is listed.
CELL = 24

_MARKS = (
    (HEADING, re.compile(r"\n[^\S\n]*\n(?=[^\S\n]*(?:#{1,6} |(?:ARTICLE|CHAPTER|PART|Section|SECTION|Sec\.|§|Title|Appendix)\b|[A-Z][^\n.!?]{2,60}\n[^\S\n]*\n))")),
    (PARAGRAPH, re.compile(r"\n[^\S\n]*\n(?=\S)")),
    (SENTENCE, re.compile(r"[.!?…][\"'”’»)\]]*\s+(?=[\"“«(\[]?[A-Z0-9À-Þ¿¡])|\n(?=\S)")),
    (WORD, re.compile(r"\s+(?=\S)")),
)


def byte_offsets(data: bytes, every: int, halo: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Characters of a UTF-8 text, and ``(from, to, before)`` in bytes of each range of ``every`` characters.

    A range has ``halo`` characters more on either side, ``before`` of them on
    the left.  The text is walked once, whatever the number of ranges.
    """
    if data.isascii():
        n = len(data)
        at = lambda c: c
    else:
        heads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        n = len(heads)
        at = lambda c: int(heads[c]) if c < n else len(data)
    out = []
    for lo in range(0, max(n, 1), every):
        before = min(lo, halo)
        out.append((at(lo - before), at(min(lo + every + halo, n)), before))
    return n, out


def ranges_of(texts: DataFrame, range_chars: int = RANGE_CHARS, halo: int = HALO) -> DataFrame:
    """``(source_id, range_no, chars, before, chunk)``: each text in ranges; ``before`` characters of the chunk are halo
    on the left and ``chars`` are those of the whole text.  Slices are taken from the UTF-8 bytes by offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = batch.column(1).cast(pa.large_binary())
            for i, source in enumerate(batch.column(0).to_pylist()):
                data = texts_[i].as_buffer()
                n, ranges = byte_offsets(bytes(data), range_chars, halo)
                for k in range(0, len(ranges), 64):
                    part = ranges[k : k + 64]
                    columns = [pa.array([source] * len(part), pa.int64()), pa.array(range(k, k + len(part)), pa.int32()), pa.array([n] * len(part), pa.int64()), pa.array([b for _, _, b in part], pa.int32()), pa.array([data.slice(lo, hi - lo).to_pybytes().decode() for lo, hi, _ in part], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names=["source_id", "range_no", "chars", "before", "chunk"])

    t = texts.where("source_id is not null and text is not null").select("source_id", "text")
    return t.mapInArrow(run, "source_id bigint, range_no int, chars bigint, before int, chunk string")


def page_marks(texts: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``(source_id, total, marks)``: characters of each text and the offsets of its form-feed lines, from byte ranges.

    Each range lists the marks that begin in it; a text has one row for each of its batches of ranges.
    """
    feed = re.compile(PAGE_MARK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = batch.column(1).cast(pa.large_binary())
            totals, marks = [], []
            for i in range(batch.num_rows):
                data = bytes(texts_[i].as_buffer())
                n, ranges = byte_offsets(data, range_chars, 1)
                found = []
                if b"\f" in data:
                    for k, (lo, hi, before) in enumerate(ranges):
                        chunk = data[lo:hi]
                        if b"\f" in chunk:
                            own = (m.start() - before for m in feed.finditer(chunk.decode()))
                            found += [k * range_chars + o for o in own if 0 <= o < range_chars]
                totals.append(n)
                marks.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(totals, pa.int64()), pa.array(marks, pa.list_(pa.int64()))], names=["source_id", "total", "marks"])

    t = texts.where("source_id is not null and text is not null").select("source_id", "text")
    return t.mapInArrow(run, "source_id bigint, total bigint, marks array<bigint>")


def page_table(texts: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``(source_id, page, start, chars)``: pages of every text with their first offset and length in characters.

    Each range owns the form-feed lines that begin in it; the stitched marks
    give the pages.  A null text has no page, an empty text one page of length 0.
    """
    each = page_marks(texts, range_chars).select("source_id", "total", F.explode(F.concat(F.array(F.lit(-2).cast("long")), "marks")).alias("mark"))
    edges = each.select("source_id", "mark", F.when(F.col("mark") == -2, F.col("total")).alias("total"))
    w = Window.partitionBy("source_id").orderBy("mark")
    return (
        edges.distinct()
        .select("source_id", F.row_number().over(w).alias("page"), (F.col("mark") + 2).alias("start"), (F.lead("mark").over(w) - 1).alias("stop"), F.max("total").over(w).alias("total"))
        .select("source_id", "page", "start", F.greatest(F.coalesce("stop", "total") - F.col("start"), F.lit(0)).alias("chars"))
    )


def selected_pages(selections: DataFrame, pages: DataFrame) -> DataFrame:
    """``(selection_id, max_chars, overlap_chars, source_id, page, start, chars, at)``: each selected page once.

    ``at`` is the page's place in the selected text (prefix sum).  Null ranges
    select all pages; ranges beyond the last page, reversed or null select nothing.
    """
    s = selections.where("selection_id is not null").select("selection_id", "source_id", "ranges", "max_chars", "overlap_chars").dropDuplicates(["selection_id"])
    chosen = s.join(pages, "source_id").where(F.col("ranges").isNull() | F.exists("ranges", lambda r: (F.col("page") >= r["start"]) & (F.col("page") <= r["end"])))
    w = Window.partitionBy("selection_id").orderBy("page")
    return chosen.select("selection_id", "max_chars", "overlap_chars", "source_id", "page", "start", "chars", (F.sum("chars").over(w) - F.col("chars")).alias("at"))


def boundaries(ranges: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``(source_id, offset, strength)``: offsets where a new piece may begin, by the range that owns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets, strengths = [], [], []
            for source, number, chunk, before in zip(*(batch.column(i).to_pylist() for i in range(4))):
                best: dict[int, int] = {}
                for strength, pattern in _MARKS:
                    for m in pattern.finditer(chunk):
                        if before <= m.end() < before + range_chars:
                            best.setdefault(m.end(), strength)
                ids += [source] * len(best)
                offsets += [number * range_chars + o - before for o in best]
                strengths += best.values()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()), pa.array(strengths, pa.int32())], names=["source_id", "offset", "strength"])

    return ranges.select("source_id", "range_no", "chunk", "before").mapInArrow(run, "source_id bigint, offset bigint, strength int")


def cut_points(marks: DataFrame, items: DataFrame) -> DataFrame:
    """``(item, piece_no, start, stop)``: pieces of every item, from its marks.

    ``marks``: (item, at, strength).  ``items``: (item, total, max_chars,
    overlap_chars).  With room = max_chars - overlap, each window of half the room
    gives its strongest and then latest mark, or its end if it has none, so that
    two cuts never lie more than ``room`` apart.  A cut weaker than both beside it
    is dropped if these lie within the room; no two of such are neighbours.  A
    piece starts overlap_chars before its cut.
    """
    i = items.where("max_chars > 0 and total > 0").select("item", "total", F.col("max_chars").cast("long").alias("most"), F.least(F.greatest(F.coalesce("overlap_chars", F.lit(0)), F.lit(0)), F.col("max_chars") - 1).cast("long").alias("overlap"))
    i = i.withColumn("room", F.col("most") - F.col("overlap")).withColumn("step", F.floor((F.col("room") + 1) / 2))
    over = i.where("total > most")
    inside = marks.join(over, "item").withColumn("k", F.ceil(F.col("at") / F.col("step")).cast("long")).where((F.col("at") > 0) & (F.col("at") < F.col("total")))
    best = inside.groupBy("item", "k").agg(F.max(F.struct("strength", "at")).alias("best")).select("item", "k", "best.at", "best.strength")
    windows = over.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("total") / F.col("step")).cast("long"))).alias("k"))
    cuts = windows.join(best, ["item", "k"], "left").select("item", "k", F.coalesce("at", F.col("k") * F.col("step")).alias("cut"), "overlap", "total", "room", F.struct(F.coalesce("strength", F.lit(-1)).alias("strength"), (F.col("k") % 2).alias("odd"), "k").alias("rank")).where("cut < total")
    w = Window.partitionBy("item").orderBy("k")
    weak = (F.coalesce(F.lag("rank").over(w) > F.col("rank"), F.lit(True))) & (F.coalesce(F.lead("rank").over(w) > F.col("rank"), F.lit(True)))
    near = F.coalesce(F.lead("cut").over(w), F.col("total")) - F.coalesce(F.lag("cut").over(w), F.lit(0)) <= F.col("room")
    cuts = cuts.withColumn("spare", weak & near).where("not spare").withColumn("no", F.row_number().over(w).cast("long"))
    pieces = cuts.select("item", (F.col("no") + 1).alias("no"), (F.col("cut") - F.col("overlap")).alias("start"), F.coalesce(F.lead("cut").over(w), "total").alias("stop"))
    head = cuts.where("no = 1").select("item", "no", F.lit(0).cast("long").alias("start"), F.col("cut").alias("stop"))
    whole = i.where("total <= most").select("item", F.lit(1).cast("long").alias("no"), F.lit(0).cast("long").alias("start"), F.col("total").alias("stop"))
    return pieces.unionByName(head).unionByName(whole).select("item", F.col("no").alias("piece_no"), F.greatest("start", F.lit(0)).alias("start"), "stop")


def planned(chosen: DataFrame, ranges: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``(item, piece_no, start, stop)``: where the selected pages of every selection are cut, by the boundaries of their ranges."""
    filled = chosen.where("chars > 0")
    items = filled.groupBy(F.col("selection_id").alias("item")).agg(F.sum("chars").alias("total"), F.first("max_chars").alias("max_chars"), F.first("overlap_chars").alias("overlap_chars"))
    inside = filled.join(boundaries(ranges, range_chars), "source_id").where("offset >= start and offset < start + chars")
    marks = inside.select(F.col("selection_id").alias("item"), (F.col("at") + F.col("offset") - F.col("start")).alias("at"), F.when(F.col("offset") == F.col("start"), F.lit(HEADING)).otherwise(F.col("strength")).alias("strength"))
    marks = marks.unionByName(filled.select(F.col("selection_id").alias("item"), "at", F.lit(HEADING).alias("strength")))
    return cut_points(marks, items)


def oversized(selections: DataFrame, texts: DataFrame, range_chars: int = RANGE_CHARS, halo: int = HALO) -> DataFrame:
    """``(selection_id)`` of the selections whose selected text is longer than max_chars (null: never).

    These are the selections that are cut into more than one piece, and those that
    a max_chars of zero or less leaves no piece for.
    """
    chosen = selected_pages(selections, page_table(texts, range_chars))
    parted = planned(chosen, ranges_of(texts, range_chars, halo), range_chars).where("piece_no = 2").select(F.col("item").alias("selection_id"))
    no_room = chosen.where("max_chars <= 0").groupBy("selection_id").agg(F.sum("chars").alias("total"), F.first("max_chars").alias("limit")).where("total > limit")
    return parted.unionByName(no_room.select("selection_id"))


def split_selections(selections: DataFrame, texts: DataFrame, range_chars: int = RANGE_CHARS, halo: int = HALO) -> DataFrame:
    """``(selection_id, piece_no, start_char, end_char, piece)``: the selected text of every selection in order.

    Pieces are at most max_chars long and share overlap_chars (capped below
    max_chars) with the piece before; the selected text is its pages joined without
    separators.  A selection that fits is one piece; an empty one, or one whose
    max_chars is null or not positive, has none.
    """
    ranges = ranges_of(texts, range_chars, halo)
    chosen = selected_pages(selections, page_table(texts, range_chars)).where("chars > 0")
    cuts = planned(chosen, ranges, range_chars)
    # slices of pages by offset, then the ranges that hold them
    slices = cuts.withColumnRenamed("item", "selection_id").withColumnsRenamed({"start": "from_char", "stop": "to_char"}).join(chosen, "selection_id").where("at < to_char and at + chars > from_char")
    slices = slices.select("selection_id", "piece_no", "from_char", "to_char", "source_id", (F.col("start") + F.greatest(F.col("from_char") - F.col("at"), F.lit(0))).alias("lo"), (F.col("start") + F.least(F.col("to_char") - F.col("at"), F.col("chars"))).alias("hi"))
    slices = slices.withColumn("range_no", F.explode(F.sequence(F.floor(F.col("lo") / range_chars), F.floor((F.col("hi") - 1) / range_chars)))).withColumn("range_no", F.col("range_no").cast("int"))
    first = F.greatest(F.col("lo"), F.col("range_no").cast("long") * range_chars)
    until = F.least(F.col("hi"), (F.col("range_no").cast("long") + 1) * range_chars)
    parts = slices.join(ranges, ["source_id", "range_no"]).select("selection_id", "piece_no", "from_char", "to_char", F.struct(first.alias("at"), F.substring(F.col("chunk"), (first - F.col("range_no").cast("long") * range_chars + F.col("before") + 1).cast("int"), (until - first).cast("int")).alias("text")).alias("part"))
    return parts.groupBy("selection_id", "piece_no", F.col("from_char").alias("start_char"), F.col("to_char").alias("end_char")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["text"]), "").alias("piece"))


def written_files(texts: DataFrame, folder: str) -> DataFrame:
    """``(path, size)``: each text as a UTF-8 file ``<source_id>.txt`` below ``folder``, which all workers mount.

    Writing again gives the same file, so a lost task may be repeated.  Null ids and texts give no file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            texts_ = batch.column(1).cast(pa.large_binary())
            paths, sizes = [], []
            for i, source in enumerate(batch.column(0).to_pylist()):
                path = os.path.join(folder, f"{source}.txt")
                data = texts_[i].as_buffer()
                with open(f"{path}.{uuid4().hex}", "wb") as f:
                    f.write(data)
                os.replace(f.name, path)
                paths.append(path)
                sizes.append(data.size)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])

    return cut(texts.where("source_id is not null and text is not null").select("source_id", "text").mapInArrow(run, "path string, size bigint"))


def split_files(files: DataFrame, max_bytes: int, overlap_bytes: int = 0, range_bytes: int = 8 << 20, halo: int = 4096, opener: Callable | None = None) -> DataFrame:
    """``(path, piece_no, start, stop, piece)``: giant UTF-8 files cut by byte offsets.

    ``files``: (path string, size bigint) on storage that all workers mount.  A
    worker opens a file (by ``opener`` where it is not a plain one), seeks to its
    range and reads only the range and its halo.  Marks lie at starts of characters, so that no character is cut unless a
    window has no mark at all.
    """

    open_file = opener or (lambda path: open(path, "rb"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, number in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lo = number * range_bytes
                with open_file(path) as f:
                    f.seek(max(0, lo - halo))
                    data = f.read(min(lo, halo) + range_bytes + halo)
                before = min(lo, halo)
                best: dict[int, int] = {}
                for strength, pattern in ((PARAGRAPH, rb"\n[ \t\r]*\n(?=\S)"), (SENTENCE, rb"[.!?]\s+(?=\S)|\n(?=\S)"), (WORD, rb"\s+(?=\S)"), (0, rb"(?=[\x00-\x7f\xc0-\xff])")):
                    cells: dict[int, int] = {}
                    for m in re.finditer(pattern, data):
                        if before <= m.end() < before + range_bytes:
                            cells[m.end() // (1 if strength or max_bytes - overlap_bytes < 4 * CELL else CELL)] = m.end()
                    for end in cells.values():
                        best.setdefault(end, strength)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(best)), pa.array([lo + o - before for o in best], pa.int64()), pa.array(list(best.values()), pa.int32())], names=["item", "at", "strength"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for path, start, stop in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                with open_file(path) as f:
                    f.seek(start)
                    texts.append(f.read(stop - start).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(texts, pa.string())], names=["path", "piece_no", "start", "stop", "piece"])

    f = files.where("path is not null and size > 0").select("path", "size").distinct()
    ranges = f.select("path", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / range_bytes).cast("int"))).alias("range_no"))
    marks = ranges.repartition("path", "range_no").mapInArrow(find, "item string, at bigint, strength int")
    items = f.select(F.col("path").alias("item"), F.col("size").alias("total"), F.lit(max_bytes).alias("max_chars"), F.lit(overlap_bytes).alias("overlap_chars"))
    return cut_points(marks, items).select(F.col("item").alias("path"), "piece_no", "start", "stop").mapInArrow(emit, "path string, piece_no bigint, start bigint, stop bigint, piece string")
