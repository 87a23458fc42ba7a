"""Held-out passages inside a training corpus (problem 9).

Method: one Aho-Corasick automaton over all word windows of the normalised held-out
items.  Each text is read once; offsets of the normalised text map back to the
words of the original.  A hit is a seed only: the words around it are aligned with
the item's words, and the passage counts if enough successive words agree.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Successive words of an item that make a leak; a shorter item must be there whole.
MIN_WORDS = 14
#: Of MIN_WORDS successive words at most so many may be replaced, no two side by side.
MAX_REPLACED = 2
#: Words of a seed: MIN_WORDS - MAX_REPLACED unchanged words lie in MAX_REPLACED + 1
#: stretches, so that one stretch has at least this many.
SEED_WORDS = (MIN_WORDS - MAX_REPLACED) // (MAX_REPLACED + 1)
#: Words looked at on either side of a seed, and places by which a word may stand aside (compounds written apart).
LOOK, ASIDE = MIN_WORDS + 8, 2
#: Letters of the longest word that may stand for another.
WORD_CHARS = 40
#: Characters by which the places of two seeds may drift apart within one passage.
DRIFT = 24
#: Items of one automaton; a larger set makes several, all run in the same pass over the corpus.
ITEMS_PER_AUTOMATON = 20_000
#: Characters of items that a worker holds at most; more are scanned in further passes.
PASS_CHARS = 64 << 20

#: Marks of notes that may stand inside a passage.
NOTE_MARK = re.compile(
    r"\[(?:\d{1,3}|[a-z*†‡]|note \d+|fn\.? ?\d+|citation needed)\]|\((?:\d{1,2}|\*+)\)(?=\W|$)|\{\d{1,3}\}|\^\d{1,3}|[¹²³⁰⁴-⁹]+|(?<=\w)[*†‡§¶]+", re.I
)
_MARKED = re.compile(r"[\[({^*†‡§¶¹²³⁰⁴-⁹]")
_LINE_HYPHEN = re.compile(r"(?<=\w)[-\u00ad\u2010¬][ \t]*\n\s*(?=\w)")
_WORD = re.compile(r"\S+")
_OTHER = re.compile(r"[\W_]+")
_PUNCTUATION = re.compile(r"[^\w\s]+|_+")
_ASCII_PUNCTUATION = {i: None for i in range(128) if not chr(i).isalnum() and not chr(i).isspace()}
_ASCII_OTHER = {i: None for i in range(128) if not chr(i).isalnum()}


def fold(text: str) -> str:
    """Letters and digits of ``text`` without case, accents, ligatures or width forms."""
    if text.isascii():
        return text.lower().translate(_ASCII_OTHER)
    return _OTHER.sub("", unicodedata.normalize("NFKD", text.casefold()))


def fold_words(text: str) -> list[str]:
    """``text`` without note marks as folded words, cut at white space only."""
    text = without_notes(text)
    if text.isascii():
        return text.lower().translate(_ASCII_PUNCTUATION).split()
    return _PUNCTUATION.sub("", unicodedata.normalize("NFKD", text.casefold())).split()


def without_notes(text: str) -> str:
    """``text`` with note marks blanked out, at the same offsets."""
    return NOTE_MARK.sub(lambda m: " " * len(m.group()), text) if _MARKED.search(text) else text


def words_of(text: str) -> tuple[list[str], list[int], list[int], list[bool]]:
    """Folded words of ``text``, where each starts and ends, and whether it is written as a name.

    Note marks and bare punctuation are no words.  A word broken by a hyphen at a line end is one word.
    """
    text = without_notes(text)
    if "\n" in text:
        text = _LINE_HYPHEN.sub(lambda m: "\x00" * len(m.group()), text)
    found, starts, ends, named = [], [], [], []
    for m in _WORD.finditer(text):
        if word := fold(raw := m.group()):
            found.append(word)
            starts.append(m.start())
            ends.append(m.end())
            named.append(raw[:1].isupper() and raw[1:2].islower())
    return found, starts, ends, named


class LeakFinder:
    """The automaton of a set of items, and the check of texts against it."""

    def __init__(self, items: list[tuple[int, str]], min_words: int = MIN_WORDS):
        import ahocorasick

        self.min_words = min_words
        self.items = [(key, w[0], w[3]) for key, text in items if (w := words_of(text or ""))[0]]
        places: dict[str, list[tuple[int, int, int]]] = {}
        for n, (_, words, _) in enumerate(self.items):
            size, at = min(SEED_WORDS, len(words)), 0
            for k in range(len(words) - size + 1):
                seed = "".join(words[k : k + size])
                places.setdefault(seed, []).append((n, k, at, self._open(words, k + size, 1), self._open(words, k - 1, -1)))
                at += len(words[k])
        self.automaton = ahocorasick.Automaton()
        for number, seed in enumerate(places):
            self.automaton.add_word(seed, number)
        if places:
            self.automaton.make_automaton()
        flat = [x for of in places.values() for x in of]
        self.first = np.concatenate([[0], np.cumsum([len(of) for of in places.values()])]).astype(np.int64)
        self.place = np.array(flat, np.int64).reshape(-1, 5)
        self.size = np.array([*map(len, places)], np.int64)
        # the items' words as one line of codes, with a gap between items wider than any look beside a seed
        self.code = {w: c for c, w in enumerate(sorted({w for _, words, _ in self.items for w in words}))}
        self.base = np.cumsum([LOOK, *(len(words) + LOOK for _, words, _ in self.items)])
        self.line = np.full(self.base[-1] + LOOK, -1, np.int64)
        for n, (_, words, _) in enumerate(self.items):
            self.line[self.base[n] : self.base[n] + len(words)] = [self.code[w] for w in words]
        self.need = np.array([min(min_words, len(w)) for _, w, _ in self.items], np.int64)

    @staticmethod
    def _open(words: list[str], k: int, step: int) -> bool:
        """Whether a run of agreeing words can go on past word ``k`` if that word was replaced."""
        return 0 <= k + step < len(words) and words[k].isalpha()

    def scan(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """``(row, item key, start, end)`` for each text of the list that gives an item away."""
        if not self.items:
            return []
        folded, rows, ends, seeds, sizes, codes, counts = [], [], [], [], [], [], []
        code = self.code.get
        for number, text in enumerate(texts):
            words = fold_words(text) if text else []
            folded.append("".join(words))
            counts.append(len(words))
            sizes += map(len, words)
            codes += map(code, words)
            if hits := list(self.automaton.iter(folded[-1])):
                e, s = zip(*hits)
                ends += e
                seeds += s
                rows.append((number, len(e)))
        if not rows:
            return []
        row = np.repeat(*np.array(rows, np.int64).T)
        seed = np.array(seeds, np.int64)
        start = np.array(ends, np.int64) + 1 - self.size[seed]
        many = self.first[seed + 1] - self.first[seed]
        at = np.repeat(self.first[seed] - np.cumsum(many) + many, many) + np.arange(many.sum())
        row, start = np.repeat(row, many), np.repeat(start, many)
        item, word, offset, onward, back = self.place[at].T
        diagonal = start - offset
        order = np.lexsort((start, diagonal, item, row))
        row, item, word, start, diagonal, onward, back = (x[order] for x in (row, item, word, start, diagonal, onward, back))
        new = np.ones(row.size, bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > DRIFT)
        heads = np.flatnonzero(new)
        # the longest of MAX_REPLACED + 1 unchanged stretches counts alone if the others are too short for a seed
        fresh = new | (np.append(-1, word[:-1]) != word)
        distinct = np.add.reduceat(fresh, heads) + SEED_WORDS - 1
        enough = distinct >= np.minimum(self.need[item[heads]], self.min_words - MAX_REPLACED - MAX_REPLACED * (SEED_WORDS - 1))
        tails = np.append(heads[1:], row.size)
        # one unbroken run that is too short must be able to go on past a replaced word
        unbroken = (word[tails - 1] - word[heads] + SEED_WORDS == distinct) & (diagonal[heads] == diagonal[tails - 1])
        enough &= ~unbroken | (distinct >= self.need[item[heads]]) | (onward[tails - 1] + back[heads] > 0)
        enough[enough] = self._similar(row, item, word, start, heads[enough], tails[enough], distinct[enough], sizes, codes, counts)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        parsed: tuple[int, tuple] = (-1, ())
        for h, t in zip(heads[enough].tolist(), tails[enough].tolist()):
            r, n = int(row[h]), int(item[h])
            if (r, n) in found:
                continue
            words, need = self.items[n][1], int(self.need[n])
            starts = [*dict.fromkeys(zip(start[h:t].tolist(), word[h:t].tolist()))]
            if self._may_agree(words, need, starts, folded[r]):
                if parsed[0] != r:
                    parsed = r, (folded[r], *words_of(texts[r]))
                if span := self._agrees(words, need, starts, *parsed[1], self.items[n][2]):
                    found[r, n] = span
        return [(r, self.items[n][0], a, b) for (r, n), (a, b) in found.items()]

    def _similar(self, row, item, word, start, heads, tails, distinct, sizes, codes, counts) -> np.ndarray:
        """Which clusters of seeds have a stretch of words around them that mostly agrees, by word codes.

        A word counts as equal if it stands up to ASIDE places beside its own, since
        the text may write compounds apart; so many more words may differ for that.
        """
        upto = np.cumsum([0, *sizes])  # characters before each word of the batch
        first_word = np.cumsum([0, *counts])
        line = np.full(len(codes) + 2 * LOOK, -2, np.int64)
        line[LOOK:-LOOK] = [-2 if c is None else c for c in codes]
        good = np.zeros(heads.size, bool)
        for anchor in (heads, tails - 1):
            chars = upto[first_word[row[anchor]]] + start[anchor]
            place = np.searchsorted(upto, chars, side="right") - 1
            place = np.clip(place, first_word[row[anchor]], np.maximum(first_word[row[anchor] + 1] - 1, 0))
            look = np.arange(-LOOK + ASIDE, LOOK - ASIDE)
            there = line[np.clip(LOOK + place[:, None] + look, 0, line.size - 1)]
            mine = self.base[item[anchor]][:, None] + word[anchor][:, None] + look
            equal = np.zeros(there.shape, bool)
            for shift in range(-ASIDE, ASIDE + 1):
                equal |= there == self.line[mine + shift]
            ran = np.cumsum(np.pad(equal, ((0, 0), (1, 0))), axis=1)
            width = np.minimum(self.need[item[anchor]], self.min_words)
            best = np.zeros(heads.size, np.int64)
            for w in np.unique(width):
                wide = w + ASIDE  # words written apart take more room
                best = np.where(width == w, (ran[:, wide:] - ran[:, :-wide]).max(axis=1), best)
            good |= best >= width - MAX_REPLACED - ASIDE
        return good | (distinct >= self.need[item[heads]])

    @staticmethod
    def _run(item: list[str], k: int, at: set[tuple[int, int]], step: int, most: int, joined: str) -> int:
        """Most item words from ``k`` on (back with step -1) that can agree, from the (place, replacements left) in ``at``.

        A replaced word may be anything of up to WORD_CHARS letters: every place of the next item word within reach is tried.
        """
        run = 0
        while at and run < most and 0 <= k < len(item):
            w, after = item[k], item[k + step] if 0 <= k + step < len(item) else None
            new: set[tuple[int, int]] = set()
            for pos, left in at:
                if joined.startswith(w, pos if step > 0 else pos - len(w)) and (step > 0 or pos >= len(w)):
                    new.add((pos + step * len(w), left))
                if left and after is not None and w.isalpha():
                    lo, hi = (pos + 1, pos + WORD_CHARS + len(after)) if step > 0 else (max(0, pos - WORD_CHARS - len(after)), pos - 1)
                    to = joined.find(after, lo, hi)
                    while to >= 0:
                        new.add((to if step > 0 else to + len(after), left - 1))
                        to = joined.find(after, to + 1, hi)
            at, k, run = new, k + step, run + bool(new)
        return run

    @classmethod
    def _may_agree(cls, item: list[str], need: int, seeds: list[tuple[int, int]], joined: str) -> bool:
        """A quick test that no agreeing place fails: like ``_agrees`` without word limits in the text."""
        for place, k in seeds:
            onward = cls._run(item, k, {(place, MAX_REPLACED)}, 1, need, joined)
            if onward >= need or onward + cls._run(item, k - 1, {(place, MAX_REPLACED)}, -1, need - onward, joined) >= need:
                return True
        return False

    @staticmethod
    def _agrees(item, need, seeds, joined, words, starts, ends, named, item_named):
        """Offsets in the original text of a place where ``need`` successive item words agree, or None.

        A number or name put for another tells of another case, so only other words count as replaced.
        """
        bounds = [0]
        for w in words:
            bounds.append(bounds[-1] + len(w))
        at_word = {b: i for i, b in enumerate(bounds[:-1])}
        at_end = {b: i for i, b in enumerate(bounds[1:])}
        done: set[tuple[int, int]] = set()
        for place, k in seeds:
            if (place, k) in done:
                continue
            same: list[bool] = []
            pos, j = place, k
            while j < len(item):  # onward from the seed
                if joined.startswith(item[j], pos):
                    done.add((pos, j))
                    pos += len(item[j])
                    same.append(True)
                elif same and same[-1] and (i := at_word.get(pos)) is not None and item[j].isalpha() and words[i].isalpha() and not (named[i] and item_named[j]) and j + 1 < len(item) and joined.startswith(item[j + 1], pos + len(words[i])):
                    pos += len(words[i])
                    same.append(False)
                else:
                    break
                j += 1
            last = pos
            back: list[bool] = []
            pos, j = place, k
            while j > 0:  # and backward
                w = item[j - 1]
                if pos >= len(w) and joined.startswith(w, pos - len(w)):
                    pos -= len(w)
                    back.append(True)
                elif (not back or back[-1]) and (i := at_end.get(pos)) is not None and w.isalpha() and words[i].isalpha() and not (named[i] and item_named[j - 1]) and j > 1 and pos - len(words[i]) >= len(item[j - 2]) and joined.startswith(item[j - 2], pos - len(words[i]) - len(item[j - 2])):
                    pos -= len(words[i])
                    back.append(False)
                else:
                    break
                j -= 1
            same = back[::-1] + same
            replaced = 0
            for i, x in enumerate(same):
                replaced += not x
                if i >= need:
                    replaced -= not same[i - need]
                if i + 1 >= need and replaced <= MAX_REPLACED:
                    a, b = bisect_right(bounds, pos) - 1, bisect_right(bounds, last - 1) - 1
                    return starts[min(a, len(starts) - 1)], ends[min(b, len(ends) - 1)]
        return None


#: The automata that a worker made last, by the number of the query.
_WORKER: dict[str, list[LeakFinder]] = {}


def leaked_items(
    corpus: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    spans: bool = False,
) -> DataFrame:
    """``(id_col, item_col)`` of each text that holds an item whole or ``min_words`` successive words of it.

    With ``spans`` also ``start`` and ``end`` of the longest place in the original
    text.  Case, spacing, punctuation, line breaks, note marks and single replaced
    words do not matter.  Null and empty texts and items give no rows, repeated
    items count once; an empty side gives an empty table.  The corpus is read once
    for each PASS_CHARS of items (the held-out set comes through the driver in such
    parts) and not shuffled; a worker makes its automata once.
    """
    spark = corpus.sparkSession
    wanted = items.select(item_col, item_text).where(f"`{item_text}` is not null and `{item_col}` is not null").dropDuplicates()
    out_type = f"`{id_col}` {corpus.schema[id_col].dataType.simpleString()}, `{item_col}` {items.schema[item_col].dataType.simpleString()}, start int, end int"
    passes: list[list[list[tuple[int, str]]]] = [[[]]]
    held = 0
    for row in wanted.toLocalIterator():
        if held + len(row[1]) > PASS_CHARS and held:
            passes.append([[]])
            held = 0
        elif len(passes[-1][-1]) >= ITEMS_PER_AUTOMATON:
            passes[-1].append([])
        passes[-1][-1].append((row[0], row[1]))
        held += len(row[1])
    kinds = pa.schema([(id_col, _arrow(corpus, id_col)), (item_col, _arrow(items, item_col)), ("start", pa.int32()), ("end", pa.int32())])
    result = None
    for slices in passes:
        shared, number = spark.sparkContext.broadcast(slices), uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            if (finders := _WORKER.get(number)) is None:
                _WORKER.clear()
                finders = _WORKER[number] = [LeakFinder(part, min_words) for part in shared.value]
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                hits = [(keys[row], item, start, end) for finder in finders for row, item, start, end in finder.scan(texts)]
                columns = [list(c) for c in zip(*hits)] or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

        piece = corpus.select(id_col, text_col).mapInArrow(run, out_type)
        result = piece if result is None else result.unionByName(piece)
    return result if spans else result.select(id_col, item_col)


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)
