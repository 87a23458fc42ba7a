"""Repair of text from scanned pages (problem 2).

Method: unknown tokens meet dictionary words in an inverted join on positional q-grams;
gradient-boosted ranking chooses the replacement.  Line-pair classifiers decide
whether a broken word goes on with the next body line and whether a line at a page's
edge is a running header, footer or page number.  Dictionary and counts come from all
natively read pages; only the classifiers are fitted, on bounded samples.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import md5
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.boost import Boost
from docketlake.session import BROADCAST_ROWS, broadcast_if_small, cut

#: Words, and lines, that the classifiers are fitted to at most.
TRAINING_WORDS = 5000
TRAINING_LINES = 20000
#: Lines from a page's edge that may be furniture.
EDGE = 3
#: Occurrences beyond which more of them say nothing new, so that the classifier sees the same counts at every scale.
ENOUGH = 31
#: Tokens over this length find their candidates by segments instead of grams.
LONG = 40
#: A dictionary word occurs at least so often on native pages.
LEAST_COUNT = 2
THRESHOLD = 0.5

#: What scanning commonly takes for what (read, meant).
CONFUSIONS = (
    ("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"), ("li", "h"), ("lc", "k"), ("in", "m"), ("nn", "m"), ("m", "rn"), ("d", "cl"), ("w", "vv"), ("n", "ri"), ("u", "ii"), ("h", "li"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("i", "l"), ("l", "i"), ("5", "s"), ("$", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("@", "a"), ("3", "e"), ("4", "a"), ("7", "t"), ("2", "z"), ("€", "e"), ("£", "e"), ("¢", "c"),
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("b", "h"), ("h", "b"), ("v", "y"), ("y", "v"), ("g", "q"), ("q", "g"), ("u", "v"), ("v", "u"), ("n", "u"), ("u", "n"), ("a", "o"), ("o", "a"), ("o", "c"), ("c", "o"), ("e", "o"), ("j", "i"), ("i", "j"), ("l", "t"), ("t", "l"), ("s", "5"), ("k", "lc"), ("f", "e"), ("e", "f"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"),
)
_MEANT: dict[str, list[str]] = {}
for _read, _true in CONFUSIONS:
    _MEANT.setdefault(_read, []).append(_true)
_LOOKALIKE = {ord(r): t for r, t in reversed(CONFUSIONS) if len(r) == len(t) == 1 and not r.isalpha()}

_TRIM = ".,;:()[]{}\"'“”‘’«»?…—–*"
_HYPHENS = "-¬­‐"
_PAGE_NUMBER = re.compile(r"^[\[(<{—–\-~.\s]*(?:(?:page|pg|p|seite|página|pag)\.?\s*)?(?:\d{1,4}|[ivxlc]{1,7}|[a-z]?-?\d{1,3}-\d{1,4})(?:\s*(?:of|/|de|von)\s*\d{1,4})?[\])>}—–\-~.\s]*$", re.I)


_PARTS: dict[str, tuple[str, ...]] = {}


def parts_of(raw: str) -> tuple[str, ...]:
    """Dictionary tokens of one word as written: trimmed, in lower case, cut at inner hyphens, slashes and dashes."""
    known = _PARTS.get(raw)
    if known is None:
        out = []
        for part in re.split(r"[-¬\u00ad\u2010/–—]", raw.replace("’", "'")):
            token = part.strip(_TRIM)
            if part.endswith("!") and part[:-1].isalpha():
                token = part[:-1]
            if len(token) > 1 and sum(map(str.isalpha, token)) >= max(1 if len(token) == 2 else 2, (len(token) + 1) // 2):
                out.append(token.lower())
        if len(_PARTS) > 300_000:
            _PARTS.clear()
        known = _PARTS[raw] = tuple(out)
    return known


def words_in(line: str) -> list[str]:
    return [t for raw in line.split() for t in parts_of(raw)]


def compounds_in(line: str) -> list[str]:
    return [t for raw in line.split() if "-" in raw[1:-1] and (t := raw.strip(_TRIM).lower()).replace("-", "").isalpha()]


def unnumbered(line: str) -> str:
    """A line without spacing, case and the page number that is set apart or at its end; other numbers stay."""
    parts = re.split(r"\s{3,}", line.strip()) if "   " in line else ()
    if len(parts) > 1 and (rest := [p for p in parts if not _PAGE_NUMBER.match(p)]):
        line = " ".join(rest)
    line = " ".join(line.lower().split())
    if len(line) <= 40:
        line = re.sub(r"\b[ivxlc]{1,7}\b(?=\W*$)", "#", line)
    return "#" if _PAGE_NUMBER.match(line) else line


def mask(form: str) -> str:
    """An ``unnumbered`` line without any number, for counting what recurs over sources."""
    return re.sub(r"\d+", "#", form)


# ---------------------------------------------------------------- lines


def listed_pages(sources: DataFrame) -> DataFrame:
    """``(source_id, pages)``: page numbers read by OCR, for sources that have such pages."""
    return sources.where("source_id is not null and size(ocr_pages) > 0").select("source_id", F.map_keys("ocr_pages").alias("pages")).groupBy("source_id").agg(F.array_distinct(F.flatten(F.collect_list("pages"))).alias("pages"))


def scanned_texts(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """``(source_id, text, pages)`` of the texts with pages read by OCR."""
    return texts.where("source_id is not null and text is not null").select("source_id", "text").join(listed, "source_id").select("source_id", "text", "pages")


def page_blocks(text: str) -> Iterator[tuple[int, list[tuple[int, str]]]]:
    """``(page, [(line_no, line)])``; a form-feed line belongs to no page."""
    page, block = 1, []
    for number, line in enumerate(text.split("\n"), 1):
        if line == "\f":
            yield page, block
            page, block = page + 1, []
        else:
            block.append((number, line))
    yield page, block


def edge_lines(scanned: DataFrame) -> DataFrame:
    """``(source_id, line_no, edge, features, key, here, n)``: lines near the edges of OCR pages with their looks, the
    digest of their mask and how often their exact form stands at the same edge in the source; the same of inside lines
    on every fourth page, whole and ended early, for training; and how often each mask stands inside a page, all lines of all pages counted,
    as one row a batch (without a source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            inner: Counter[bytes] = Counter()
            for source, text, pages in zip(*(batch.column(i).to_pylist() for i in range(3))):
                listed, rows = set(pages), []
                here: Counter[tuple[str, bool]] = Counter()
                for page, block in page_blocks(text):
                    if page not in listed:
                        continue
                    full = [i for i, (_, x) in enumerate(block) if x and not x.isspace()]
                    width = max((len(block[i][1].rstrip()) for i in full), default=1)
                    shown = crc32(f"{source}:{page}".encode()) % 4 == 0
                    for top, i in enumerate(full):
                        number, x = block[i]
                        bottom = len(full) - 1 - top
                        edge = top < EDGE or bottom < EDGE
                        form = unnumbered(x)
                        key = md5(mask(form).encode()).digest()
                        if edge:
                            here[form, top < EDGE] += 1
                        else:
                            inner[key] += 1
                            if not shown:
                                continue
                        before = i == 0 or not block[i - 1][1].strip()
                        after = i + 1 == len(block) or not block[i + 1][1].strip()
                        looks = line_features(x, width, top, bottom, before, after, block[full[top + 1]][1] if bottom else "")
                        rows.append((number, edge, looks, key, form, top < EDGE))
                        if not edge and len(words := x.split()) > 1:
                            # a paragraph may end anywhere, also where the text at hand has only full lines
                            ended = " ".join(words[: 1 + crc32(x.encode()) % (len(words) - 1)]).rstrip(_TRIM + _HYPHENS) + "."
                            rows.append((number, False, line_features(ended, width, top, bottom, before, True, ""), None, "", False))
                for number, edge, looks, key, form, high in rows:
                    # an inside line counts as if it stood at an edge
                    times = here[form, high] if edge else 1 + max(here[form, True], here[form, False])
                    for to, v in zip(out, (source, number, edge, looks, key, times, 1)):
                        to.append(v)
            for key, n in inner.items():
                for to, v in zip(out, (None, None, False, None, key, 0, n)):
                    to.append(v)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.float32()), pa.binary(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["source_id", "line_no", "edge", "features", "key", "here", "n"])

    return scanned.mapInArrow(run, "source_id bigint, line_no bigint, edge boolean, features array<float>, key binary, here int, n bigint")


def line_features(x: str, width: int, top: int, bottom: int, before: bool, after: bool, near: str) -> list[float]:
    """What a line looks like, and how it and the next line go together."""
    words = x.split()
    if not words:
        return []
    letters = [w.strip(_TRIM) for w in words]
    named = [w for w in letters if w[:1].isalpha()]
    small = sum(1 for w in named if w[:1].islower())
    last = x.rstrip()[-1:]
    return [
        float(bool(_PAGE_NUMBER.match(x))),
        min(top, EDGE),
        min(bottom, EDGE),
        len(x.strip()) / max(width, 1),
        len(words),
        small / max(len(named), 1) if named else 0.0,
        sum(map(str.isupper, x)) / len(x.strip()),
        sum(map(str.isdigit, x)) / len(x.strip()),
        float(last in ".;:,?!"),
        float(last in _HYPHENS and x.rstrip()[-2:-1].isalpha()),
        float(x.strip()[:1].islower()),
        float(before),
        float(after),
        float("   " in x.strip()) + float(any(_PAGE_NUMBER.match(p) for p in re.split(r"\s{3,}", x.strip())[1:])),
        float(any(s in x for s in (" / ", " | ", " — ", " · "))),
        float(near.strip()[:1].islower()),
        float(bool(words) and words[0].rstrip(".").lower() in ("rev", "ord", "page", "pg", "draft", "copy", "chapter", "title", "supplement", "adopted", "printed", "revised", "effective", "no")),
    ]


def key_counts(lines: DataFrame) -> DataFrame:
    """``(key, edge_n, inner)``: how often each mask stands at edges and inside pages."""
    at_edge = F.col("edge") & F.col("source_id").isNotNull()
    return lines.where("edge or source_id is null").groupBy("key").agg(F.count_if(at_edge).alias("edge_n"), F.coalesce(F.sum(F.when(~at_edge, F.col("n"))), F.lit(0)).alias("inner"))


def with_recurrence(lines: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """``lines`` with the features of recurrence appended to their looks.

    ``others`` are the other lines of the same mask.  How much more often they
    stand at edges than lines at large do (``share``) is a rate and says the same
    at every scale; how many they are counts up to ENOUGH.
    """
    joined = lines.join(counts, "key", "left")
    e = F.coalesce(F.col("edge_n"), F.lit(0)) - F.col("edge").cast("int")
    i = F.coalesce(F.col("inner"), F.lit(0)) - (~F.col("edge")).cast("int")
    lift = F.log2((F.greatest(e, F.lit(0)) + F.lit(share)) / (F.greatest(i, F.lit(0)) + F.lit(1 - share))) - F.log2(F.lit(share / (1 - share)))
    extra = F.array(F.least("here", F.lit(4)).cast("float"), F.log2(1 + F.least(F.greatest(e + i, F.lit(0)), F.lit(ENOUGH))).cast("float"), F.least(F.greatest(lift, F.lit(-8.0)), F.lit(8.0)).cast("float"))
    return joined.select("source_id", "line_no", "edge", F.concat("features", extra).alias("features"), "here", e.alias("others_at_edges"), i.alias("others_inside"))


def fit_furniture(edges: DataFrame, inside: DataFrame, most: int = TRAINING_LINES) -> Boost | None:
    """A classifier of edge lines, from lines that recur at edges and hardly inside pages against lines inside pages.

    Both carry the counts of their own mask, so that a body line that recurs, at
    edges too, is known as such.  Those of half of the sample are blanked, so that
    a header which stands only once is told by its looks.  A recurring line with a
    sentence's end proves nothing: paragraphs end alike.
    """
    rare_inside = "others_inside * 20 <= others_at_edges + 1"
    sure = f"({rare_inside}) and ((features[0] > 0 and (here > 1 or others_at_edges > 2)) or (features[8] = 0 and (here >= 3 or others_at_edges >= 4) and not (features[10] > 0 and features[15] > 0 and here < 3)))"
    pick = lambda df: df.orderBy(F.xxhash64("source_id", "line_no"), "source_id", "line_no").limit(most // 2).select("features").collect()
    good, bad = pick(edges.where(sure)), pick(inside)
    if len(good) < 20 or len(bad) < 20:
        return None
    rng = np.random.default_rng(3)
    x = np.array([r[0] for r in good] + [r[0] for r in bad], float)
    y = np.array([1] * len(good) + [0] * len(bad))
    inner = y == 0
    # lines inside pages take part as if they stood at an edge
    x[inner, 1] = rng.choice([0, 0, 1, 2, EDGE], inner.sum())
    x[inner, 2] = np.where(x[inner, 1] < EDGE, EDGE, rng.choice([0, 1, 2], inner.sum()))
    # the first and last lines of a page have no line beside them and look set apart
    x[inner & (x[:, 1] == 0), 11] = 1
    x[inner & (x[:, 2] == 0), 12] = 1
    x[inner & (x[:, 2] == 0), 15] = 0
    blank = rng.random(len(x)) < 0.5
    x[blank, -3:] = 1, 0, 0
    return Boost(trees=40, depth=4).fit(x, y)


# ---------------------------------------------------------------- dictionary


def clean_counts(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """``(kind, key, n)``: words (w) and compounds (c) of all pages that were not read by OCR.

    Workers count words as written and take the different ones apart, so that
    the shuffle carries each word once per batch.  Words that end in a hyphen are
    broken ones and not counted.
    """
    t = texts.where("text is not null").select("source_id", "text").join(listed, "source_id", "left").select("text", "pages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw: Counter[str] = Counter()
            for text, pages in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not pages:
                    raw.update(text.split())
                    continue
                skip = set(pages)
                for page, block in page_blocks(text):
                    if page not in skip:
                        for _, line in block:
                            raw.update(line.split())
            words: Counter[str] = Counter()
            compounds: Counter[str] = Counter()
            for token, n in raw.items():
                if token[-1] in _HYPHENS and len(token) > 1:
                    continue
                for part in parts_of(token):
                    words[part] += n
                for c in compounds_in(token):
                    compounds[c] += n
            yield pa.RecordBatch.from_arrays([pa.array(["w"] * len(words) + ["c"] * len(compounds)), pa.array([*words, *compounds], pa.string()), pa.array([*words.values(), *compounds.values()], pa.int64())], names=["kind", "key", "n"])

    return t.mapInArrow(run, "kind string, key string, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- replacements


def ocr_distance(token: str, word: str) -> float:
    """Edit distance from a read token to a meant word where a common confusion costs 0.2 and any other edit 1."""
    n, m = len(token), len(word)
    far = 99.0
    # a path below 3 changes the length by 15 confusions at most
    band = 16 if max(n, m) > LONG else max(n, m)
    d = [[far] * (m + 1) for _ in range(n + 1)]
    d[0][0] = 0.0
    for i in range(n + 1):
        for j in range(max(0, i - band), min(m, i + band) + 1):
            here = d[i][j]
            if here >= 3:
                continue
            if i < n and j < m and token[i] == word[j] and here < d[i + 1][j + 1]:
                d[i + 1][j + 1] = here
            if i < n and j < m and here + 1 < d[i + 1][j + 1]:
                d[i + 1][j + 1] = here + 1
            if i < n and here + 1 < d[i + 1][j]:
                d[i + 1][j] = here + 1
            if j < m and here + 1 < d[i][j + 1]:
                d[i][j + 1] = here + 1
            for size in (1, 2):
                for meant in _MEANT.get(token[i : i + size], ()) if i + size <= n else ():
                    if word.startswith(meant, j) and here + 0.2 < d[i + size][j + len(meant)]:
                        d[i + size][j + len(meant)] = here + 0.2
    return d[n][m]


def pair_features(token: str, word: str, count: int, shared: float) -> list[float]:
    odd = sum(1 for c in token if not c.isalpha() and c != "'")
    distance = ocr_distance(token, word)
    return [distance, len(token), len(word) - len(token), float(np.log1p(count)), odd, shared, float(token[:1] == word[:1]), float(token[-1:] == word[-1:]), distance / max(len(token), 1)]


def grams(word: str) -> list[tuple[str, int]]:
    w = f"^{word}$"
    return [(w[i : i + 2], i) for i in range(len(w) - 1)]


def shared_grams(token: str, word: str) -> int:
    """Different grams of ``token`` that ``word`` has at the same place or one beside it."""
    if abs(len(token) - len(word)) > 1:
        return 0
    at = [word_gram for word_gram, _ in grams(word)]
    return len({g for g, i in grams(token) if g in at[max(0, i - 1) : i + 2]})


def least_shared(length: int) -> int:
    """Grams that a pair must share: one misread place leaves all grams of a token but those around it."""
    return max(1, length - 3)


def _gram_rows(words: DataFrame, key: str) -> DataFrame:
    """``words`` once for each positional 2-gram of ``key``, with its ``gram``, ``place`` and ``size``."""
    padded = F.concat(F.lit("^"), F.col(key), F.lit("$"))
    n = F.length(key)
    rows = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(F.substring(padded, i + 1, F.lit(2)).alias("gram"), i.alias("place"), n.alias("size")))
    return words.select("*", F.explode(rows).alias("g")).select("*", "g.gram", "g.place", "g.size").drop("g")


def _beside(rows: DataFrame) -> DataFrame:
    """``rows`` also at the neighbouring places and sizes."""
    steps = F.explode(F.array(*(F.struct(F.lit(s).alias("s"), F.lit(e).alias("e")) for s in (-1, 0, 1) for e in (-1, 0, 1)))).alias("step")
    return rows.select("*", steps).withColumns({"place": F.col("place") + F.col("step.s"), "size": F.col("size") + F.col("step.e")}).drop("step")


def _segment_rows(words: DataFrame, key: str, shifts: tuple[int, ...]) -> DataFrame:
    """``words`` once for each of the five segments of ``key``, cut as for lengths up to one beside where shifts are asked."""
    n = F.length(key)
    sizes = [n + e for e in ((-1, 0, 1) if len(shifts) > 1 else (0,))]
    at = lambda size, k: F.floor(size * k / 5).cast("int")
    rows = F.array(*(F.struct(size.alias("size"), F.lit(k).alias("k"), F.substring(F.col(key), at(size, k) + 1 + s, at(size, k + 1) - at(size, k)).alias("segment")) for size in sizes for k in range(5) for s in shifts))
    return words.select("*", F.explode(rows).alias("g")).select("*", "g.size", "g.k", "g.segment").drop("g")


def candidates(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(token, word, n)``: dictionary words that may share ``least_shared`` grams in place with an unknown token.

    A token of N grams that must share T of them shares one of any N - T + 1;
    so it joins by its rarest that many, and common grams meet nobody.  What the
    grams of a pair really share is counted by the caller.  Tokens and words
    over LONG letters meet by segments, of which a misread place leaves three whole.
    """
    words = dictionary.select(F.col("key").alias("word"), "n")
    short = F.length("token") <= LONG
    b = _gram_rows(words.where(F.length("word") <= LONG + 1), "word")
    often = _beside(b.groupBy("gram", "place", "size").agg(F.count("*").alias("often"))).groupBy("gram", "place", "size").agg(F.sum("often").alias("often"))
    a = _gram_rows(tokens.select("token").where(short), "token").join(often, ["gram", "place", "size"], "left")
    chosen = a.groupBy("token").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram", "place", "size"))).alias("all"))
    needed = F.length("token") + 2 - F.greatest(F.lit(1), F.length("token") - 3)
    chosen = chosen.select("token", F.explode(F.slice("all", F.lit(1), needed)).alias("g")).where("g.often > 0").select("token", "g.gram", "g.place", "g.size")
    near = _beside(chosen).join(b, ["gram", "place", "size"]).select("token", "word", "n")
    long = _segment_rows(tokens.select("token").where(~short), "token", (-1, 0, 1)).join(_segment_rows(words.where(F.length("word") >= LONG), "word", (0,)), ["size", "k", "segment"]).select("token", "word", "n")
    return near.union(long).distinct()


def fit_ranker(sample: list[tuple[str, int]]) -> Boost | None:
    """A ranker from dictionary words misread on purpose.

    A quarter of the words is withheld: their candidates among the others are
    wrong, as for a name that no dictionary has.
    """
    rng = np.random.default_rng(11)
    words = [(w, n) for w, n in sample if len(w) >= 3 and w.isalpha()]
    if len(words) < 30:
        return None
    withheld = {w for w, _ in words if rng.random() < 0.25}
    known = {w: n for w, n in words if w not in withheld}
    index: dict[tuple, set[str]] = {}
    for w in known:
        for g, i in grams(w):
            index.setdefault((g, i, len(w)), set()).add(w)
    true_of: dict[str, list[str]] = {}
    for read, meant in CONFUSIONS:
        true_of.setdefault(meant, []).append(read)
    x, y = [], []

    def look(token: str, meant: str | None) -> None:
        near = {w for g, i in grams(token) for s in (-1, 0, 1) for e in (-1, 0, 1) for w in index.get((g, i + s, len(token) + e), ())}
        for word in sorted(near - {token}):
            if (k := shared_grams(token, word)) >= least_shared(len(token)):
                x.append(pair_features(token, word, known[word], k / (len(token) + 1)))
                y.append(float(word == meant))
        plain = token.translate(_LOOKALIKE)
        if plain != token and meant not in known:
            x.append(pair_features(token, plain, 0, 1.0))
            y.append(1.0)

    for w, _ in words:
        if w in withheld:
            look(w, None)
        places = [(i, m) for i in range(len(w)) for m in (w[i : i + 1], w[i : i + 2]) if m in true_of]
        for i, m in (places[k] for k in rng.permutation(len(places))[:2]):
            read = true_of[m][rng.integers(len(true_of[m]))]
            token = w[:i] + read + w[i + len(m) :]
            if token not in known:
                look(token, w)
    return Boost(trees=40, depth=4).fit(np.array(x), np.array(y)) if sum(y) > 20 else None


def replacements(tokens: DataFrame, dictionary: DataFrame, ranker: Boost | None) -> DataFrame:
    """``(token, word, score)``: the best replacement of each unknown token that has a likely one.

    A token with digits or signs among its letters also meets its own plain
    reading, which need not be in the dictionary.
    """
    if ranker is None:
        return tokens.select("token", F.lit(None).cast("string").alias("word"), F.lit(0.0).alias("score")).limit(0)
    plain = F.translate("token", *(("".join(chr(k) for k in _LOOKALIKE), "".join(_LOOKALIKE.values()))))
    for one, two in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff")):
        plain = F.replace(plain, F.lit(one), F.lit(two))
    own = tokens.where("length(token) > 2").select("token", plain.alias("word"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("own")).where("word != token")
    pairs = candidates(tokens, dictionary).select("*", F.lit(False).alias("own")).unionByName(own)
    shared = tokens.sparkSession.sparkContext.broadcast(ranker)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for token, word, n, own in zip(*(batch.column(i).to_pylist() for i in range(4))):
                k = len(token) + 1 if own else shared_grams(token, word)
                if own or k >= least_shared(len(token)):
                    kept.append((token, word, pair_features(token, word, n, k / (len(token) + 1))))
            score = shared.value.predict(np.array([f for _, _, f in kept]).reshape(-1, 9))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _, _ in kept], pa.string()), pa.array([w for _, w, _ in kept], pa.string()), pa.array(score)], names=["token", "word", "score"])

    scored = pairs.mapInArrow(run, "token string, word string, score double").where(F.col("score") >= THRESHOLD)
    return scored.groupBy("token").agg(F.max(F.struct("score", "word")).alias("best")).select("token", "best.word", "best.score")


# ---------------------------------------------------------------- broken words


def break_features(tail: str, head: str, joined: int, compound: int, left: int, right: int, soft: bool, lower: bool) -> list[float]:
    log = lambda n: float(np.log1p(n or 0))
    return [log(joined), log(compound), log(left), log(right), float(soft), float(lower), len(tail), len(head), log(joined) - log(compound), min(log(left), log(right))]


def fit_breaks(words: list[tuple[str, int]], compounds: list[tuple[str, int]]) -> Boost | None:
    """A classifier of line pairs, from words broken at random places and compounds parted at their own hyphen."""
    rng = np.random.default_rng(5)
    known = dict(words)
    pairs = dict(compounds)
    x, y = [], []
    for w, n in words:
        if len(w) < 5 or not w.isalpha():
            continue
        for _ in range(2):
            k = int(rng.integers(2, len(w) - 1))
            a, b = w[:k], w[k:]
            seen = n if rng.random() < 0.8 else 0
            x.append(break_features(a, b, seen, pairs.get(f"{a}-{b}", 0), known.get(a, 0), known.get(b, 0), rng.random() < 0.3, rng.random() < 0.97))
            y.append(1.0)
    for c, n in compounds:
        parts = c.split("-")
        for k in range(1, len(parts)):
            a, b = parts[k - 1], parts[k]
            for _ in range(max(1, min(12, 600 // max(len(compounds), 1)))):
                seen = n if rng.random() < 0.8 else 0
                x.append(break_features(a, b, known.get(a + b, 0), seen, known.get(a, 0), known.get(b, 0), False, True))
                y.append(0.0)
    y_ = np.array(y)
    if y_.sum() < 20 or len(y) - y_.sum() < 5:
        return None
    return Boost(trees=30, depth=3, least=4).fit(np.array(x), y_, np.where(y_ > 0, 0.5 / y_.mean(), 0.5 / (1 - y_.mean())))


def judged_breaks(pairs: DataFrame, counts: DataFrame, model: Boost | None) -> DataFrame:
    """``(tail, head, soft, lower, is_break, joined_n)`` for each different pair."""
    d = pairs.select("tail", "head", "soft", "lower").distinct()
    asked = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(k).alias("kind"), v.alias("key")) for r, k, v in (("joined", "w", F.concat("tail", "head")), ("compound", "c", F.concat("tail", F.lit("-"), "head")), ("left", "w", F.col("tail")), ("right", "w", F.col("head")))))
    looked = d.select("*", F.explode(asked).alias("q")).select("tail", "head", "soft", "lower", "q.role", "q.kind", "q.key").join(counts, ["kind", "key"], "left")
    by = looked.groupBy("tail", "head", "soft", "lower").agg(*(F.coalesce(F.max(F.when(F.col("role") == r, F.col("n"))), F.lit(0)).alias(f"{r}_n") for r in ("joined", "compound", "left", "right")))
    shared = pairs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            tail, head, soft, lower, joined, compound, left, right = (batch.column(i).to_pylist() for i in range(8))
            x = np.array([break_features(*v) for v in zip(tail, head, joined, compound, left, right, soft, lower)]).reshape(-1, 10)
            is_break = own.predict(x) >= THRESHOLD if own is not None else np.array([j > c or (c == 0 and (l == 0 or r == 0)) for j, c, l, r in zip(joined, compound, left, right)], bool)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(is_break, pa.bool_()), batch.column(4)], names=["tail", "head", "soft", "lower", "is_break", "joined_n"])

    return by.mapInArrow(run, "tail string, head string, soft boolean, lower boolean, is_break boolean, joined_n bigint")


# ---------------------------------------------------------------- all together

_TAIL = re.compile(r"([^\W_][\w'’@!$]*|[@!$]\w[\w'’@!$]*)[-¬\u00ad\u2010]$")
_HEAD = re.compile(r"^[\"“(\[]?([\w'’@!$]+)")


def furniture_lines(scanned: DataFrame) -> DataFrame:
    """``(source_id, gone)``: numbers of the furniture lines of each text."""
    lines = cut(edge_lines(scanned))
    counts = key_counts(lines)
    total = lines.select(F.count_if("edge").alias("e"), F.sum(F.when(F.col("source_id").isNull(), F.col("n"))).alias("i")).first()
    share = min(max((total[0] or 0) / max((total[0] or 0) + (total[1] or 0), 1), 0.01), 0.99)
    edges = cut(with_recurrence(lines.where("edge"), counts, share))
    # a bounded sample of inside lines before the join with the counts
    sample = lines.where("not edge and size(features) > 0").orderBy(F.xxhash64("line_no", "source_id"), "source_id", "line_no").limit(TRAINING_LINES // 2)
    model = fit_furniture(edges, with_recurrence(sample, counts, share))
    shared = edges.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), float).reshape(batch.num_rows, -1)
            # too little to learn from: a page number at the edge, or a line that recurs at edges alone
            found = shared.value.predict(x) >= THRESHOLD if shared.value is not None else (x[:, 0] > 0) | (((x[:, -3] > 1) | (x[:, -2] > 1)) & (x[:, -1] > 0))
            keep = pa.array(found, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["source_id", "line_no"])

    found = edges.select("source_id", "line_no", "features").mapInArrow(run, "source_id bigint, line_no bigint")
    return found.groupBy("source_id").agg(F.collect_list("line_no").alias("gone"))


def body_of(text: str, pages: list[int], gone: list[int] | None) -> list[tuple[int, bool, str]]:
    """``(line_no, ocr, line)`` of the non-blank lines that are no furniture."""
    listed, out = set(pages), set(gone or ())
    return [(n, page in listed, x) for page, block in page_blocks(text) for n, x in block if x and not x.isspace() and n not in out]


def pairs_in(body: list[tuple[int, bool, str]]) -> Iterator[tuple[int, int, str, str, bool, bool]]:
    """OCR lines that end in a hyphen with the next body line: ``(index, next_no, tail, head, soft, lower)``."""
    for k in range(len(body) - 1):
        _, ocr, line = body[k]
        if not ocr:
            continue
        line = line.rstrip()
        if line[-1] not in _HYPHENS or not (m := _TAIL.search(line)):
            continue
        after = body[k + 1][2].lstrip()
        if not (h := _HEAD.match(after)):
            continue
        tail, head = m.group(1).lower(), h.group(1).lower()
        if any(map(str.isalpha, tail)) and any(map(str.isalpha, head)):
            first = after.lstrip("\"“([")[:1]
            yield k, body[k + 1][0], tail, head, line[-1] in "¬\u00ad", not first.isupper()


def tokens_by_line(body: list[tuple[int, bool, str]], paired: set[int]) -> Iterator[tuple[int, str]]:
    """Tokens of the OCR body lines; the words that a pair of lines shares are left to the pair."""
    for k, (number, ocr, line) in enumerate(body):
        if not ocr:
            continue
        words = line.split()
        if k in paired and words:
            # what stands before the last inner hyphen of a broken compound is whole
            words[-1:] = [re.split(r"[-¬\u00ad\u2010]", words[-1][:-1])[:-1]][0]
        if k and (k - 1) in paired and words:
            words[:1] = re.split(r"[-/]", words[0])[1:]
        for raw in words:
            for token in parts_of(raw):
                yield number, token


def _with_gone(scanned: DataFrame, furniture: DataFrame) -> DataFrame:
    return scanned.join(broadcast_if_small(furniture), "source_id", "left").select("source_id", "text", "pages", "gone")


def _pairs_and_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: a pair of lines with its source, or a different token of the batch."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [], [], [])
        tokens: set[str] = set()
        for source, text, pages, gone in zip(*(batch.column(i).to_pylist() for i in range(4))):
            body = body_of(text, pages, gone)
            pairs = list(pairs_in(body))
            for k, next_no, tail, head, soft, lower in pairs:
                for to, v in zip(out, (source, body[k][0], next_no, tail, head, soft, lower)):
                    to.append(v)
            tokens.update(t for _, t in tokens_by_line(body, {p[0] for p in pairs}))
        n, m = len(out[0]), len(tokens)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
        columns = [pa.array(c + [None] * m, k) for c, k in zip(out, kinds)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([None] * n + sorted(tokens), pa.string())], names=["source_id", "line_no", "next_no", "tail", "head", "soft", "lower", "token"])


def _hits(texts: DataFrame, best: DataFrame) -> DataFrame:
    """``(source_id, line_no, token, word)``: where replaced tokens stand outside pairs.

    The replacements go to the workers behind a check of their number; a larger
    table is joined with all tokens instead.
    """
    rows = best.select("token", "word").limit(BROADCAST_ROWS + 1).collect()
    small = len(rows) <= BROADCAST_ROWS
    shared = texts.sparkSession.sparkContext.broadcast(dict(map(tuple, rows)) if small else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for source, text, pages, gone in zip(*(batch.column(i).to_pylist() for i in range(4))):
                body = body_of(text, pages, gone)
                found = {(n, t) for n, t in tokens_by_line(body, {p[0] for p in pairs_in(body)}) if words is None or t in words}
                for n, t in found:
                    for to, v in zip(out, (source, n, t)):
                        to.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=["source_id", "line_no", "token"])

    found = texts.mapInArrow(run, "source_id bigint, line_no bigint, token string")
    return found.join(broadcast_if_small(best.select("token", "word")), "token")


def scan_noise(texts: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """What is wrong with the scanned texts.

    ``texts`` (source_id, text, pages, gone), ``furniture`` (source_id, line_no),
    ``breaks`` (source_id, line_no, next_no, tail, head), ``glyphs`` (source_id,
    line_no, token, word).  Null and empty texts, sources without OCR pages and
    pages that the text does not have give nothing.
    """
    listed = broadcast_if_small(listed_pages(sources))
    scanned = scanned_texts(texts, listed)
    counts = cut(clean_counts(texts, listed))
    furniture = cut(furniture_lines(scanned))
    whole = _with_gone(scanned, furniture)
    dictionary = counts.where((F.col("kind") == "w") & (F.col("n") >= LEAST_COUNT)).select("key", "n")
    sample = [(r[0], r[1]) for r in dictionary.orderBy(F.xxhash64("key"), "key").limit(TRAINING_WORDS).collect()]
    compounds = [(r[0], r[1]) for r in counts.where("kind = 'c'").orderBy(F.xxhash64("key"), "key").limit(TRAINING_WORDS).select("key", "n").collect()]

    both = cut(whole.mapInArrow(_pairs_and_tokens, "source_id bigint, line_no bigint, next_no bigint, tail string, head string, soft boolean, lower boolean, token string"))
    pairs = both.where("token is null").drop("token")
    judged = judged_breaks(pairs, counts, fit_breaks(sample, compounds))
    found = cut(pairs.join(judged, ["tail", "head", "soft", "lower"]))
    breaks = found.where("is_break").select("source_id", "line_no", "next_no", "tail", "head")

    # a broken word is one token of both lines; a parted compound two tokens
    parts = F.posexplode(F.when(F.col("is_break"), F.array(F.concat("tail", "head"))).otherwise(F.array("tail", "head"))).alias("part", "token")
    of_pairs = found.select("source_id", "line_no", "next_no", "is_break", F.length("tail").alias("cut_at"), parts)
    every = both.where("token is not null").select("token").union(of_pairs.select("token")).distinct()
    unknown = every.where("length(token) > 2 or (length(token) = 2 and token rlike '[^a-z]')").join(dictionary.withColumnRenamed("key", "token"), "token", "left_anti")
    best = cut(replacements(unknown, dictionary, fit_ranker(sample)))
    glyphs = _hits(whole, best)
    # of a broken word, the line that holds the first letter that differs
    same = F.aggregate(F.sequence(F.lit(1), F.least(F.length("token"), F.length("word"))), F.lit(0), lambda s, i: F.when((s == i - 1) & (F.substring(F.col("token"), i, F.lit(1)) == F.substring(F.col("word"), i, F.lit(1))), i).otherwise(s))
    second = F.when(F.col("is_break"), same >= F.col("cut_at")).otherwise(F.col("part") == 1)
    in_pairs = of_pairs.join(best, "token").select("source_id", F.when(second, F.col("next_no")).otherwise(F.col("line_no")).alias("line_no"), "token", "word")
    return {"texts": whole, "furniture": furniture.select("source_id", F.explode("gone").alias("line_no")), "breaks": breaks, "glyphs": glyphs.unionByName(in_pairs)}


def noisy_lines(texts: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source_id, line_no, kind)`` with kind furniture, hyphen or glyph, on pages read by OCR."""
    found = scan_noise(texts, sources)
    out = None
    for kind, name in (("furniture", "furniture"), ("hyphen", "breaks"), ("glyph", "glyphs")):
        one = found[name].select("source_id", "line_no", F.lit(kind).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def repaired_paragraphs(texts: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source_id, paragraph_no, text)`` of texts with scanned pages: furniture gone, broken words joined,
    misread words replaced; lines of a paragraph are joined, also over a page end."""
    found = scan_noise(texts, sources)
    fixes = found["glyphs"].groupBy("source_id").agg(F.collect_set(F.struct("line_no", "token", "word")).alias("fixes"))
    joins = found["breaks"].groupBy("source_id").agg(F.collect_set("line_no").alias("joins"))
    per_text = found["texts"].join(joins, "source_id", "left").join(fixes, "source_id", "left").select("source_id", "text", "pages", "gone", "joins", "fixes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, text, _, gone, joins, fixes in zip(*(batch.column(i).to_pylist() for i in range(6))):
                out, joined, wrong = set(gone or ()), set(joins or ()), {}
                for f in fixes or ():
                    wrong.setdefault(f["line_no"], []).append((f["token"], f["word"]))
                paragraphs, now, glue, blank = [], "", False, False
                for _, block in page_blocks(text):
                    full = [i for i, (n, x) in enumerate(block) if x.strip() and n not in out]
                    for k, i in enumerate(full):
                        number, line = block[i]
                        line = line.strip()
                        blank = (k > 0 and full[k - 1] != i - 1) or (k == 0 and now[-1:] in ".!?:")
                        if now and blank and not glue:
                            paragraphs.append(now)
                            now = ""
                        for token, word in wrong.get(number, ()):
                            line = re.sub(rf"(?<!\w){re.escape(token)}(?!\w)", lambda m, w=word: w.capitalize() if m.group()[:1].isupper() else w, line, flags=re.I)
                        now = now + line if glue or now[-1:] == "-" else f"{now} {line}".strip()
                        glue = number in joined
                        if glue:
                            now = now[:-1]
                if now:
                    paragraphs.append(now)
                yield pa.RecordBatch.from_arrays([pa.array([source] * len(paragraphs), pa.int64()), pa.array(range(1, len(paragraphs) + 1), pa.int32()), pa.array(paragraphs, pa.string())], names=["source_id", "paragraph_no", "text"])

    return per_text.mapInArrow(run, "source_id bigint, paragraph_no int, text string")
