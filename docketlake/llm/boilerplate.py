"""Main body of web pages (problem 4).

Method: a linear-chain conditional random field over the leaf blocks of a page, with
text features and features of the enclosing tags (of their traces, where only the
text of a page was kept: list marks, table tabs, link bars, headings between blank
lines).  It is trained on labelled pages and decoded by Viterbi.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that are labelled and fitted at most; they are those of smallest hashed id among pages of up to TRAINING_CHARS.
TRAINING_PAGES, TRAINING_CHARS = 1200, 40_000
EPOCHS = 6
#: Feature weights share this many places.
WIDTH = 1 << 14
L2 = 1e-5
BODY, FURNITURE = 0, 1

#: Phrases of site furniture, as they are commonly written.
_CONTROL = re.compile(
    r"^(?:☰|menu|main menu|navigation|toggle navigation|open menu|close|skip to (?:main )?content|skip navigation|search(?: this site)?|site search|accept(?: all| cookies)?|reject(?: all)?|decline|got it|ok|okay|i agree|manage preferences|cookie settings|learn more"
    r"|print(?: this page)?|listen|e-?mail this page|share(?: this(?: page)?)?|tweet|advertisement|sponsored|download our app|back to top|return to top|translate(?: this page)?|select language|text size.*|font size.*|rate this.*|was this (?:page|article) helpful.*|feedback|leave a comment|sign up.*|subscribe.*|newsletter|follow us.*|connect with us|log ?in\b.*|sign in\b.*|register|employee login|my account|read more\W*|view (?:all|more)\W*|more\W*|see all\W*"
    r"|accept(?: all)? \| .*|(?:facebook|x|twitter|instagram|youtube|linkedin)(?:\W+(?:facebook|x|twitter|instagram|youtube|linkedin))*)$",
    re.I,
)
_SIDE = re.compile(r"^(?:related(?: (?:links|pages|articles|content))?|quick links|popular(?: pages)?|most (?:requested|viewed|read|popular)|you may also like|see also|in this (?:department|section)|upcoming (?:events|meetings)|latest news|recent (?:news|posts)|news|trending|follow us|categories|archives|tags|more from .*|recommended.*|helpful links|resources)$", re.I)
_FOOTER = re.compile(
    r"©|\(c\) ?\d{4}|copyright|all rights reserved|privacy (?:policy|notice|statement)|^your privacy|^privacy\b|terms of (?:use|service)|site ?map|non-?discrimination|accessibility|website by|powered by|designed by|last (?:updated|modified|reviewed)|^phone\b.*\d|^fax\b|^\d+ [A-Z]\w+ (?:street|st|road|rd|way|avenue|ave|drive|lane|blvd|boulevard)\b|suite \d+|monday to friday|^alert\b",
    re.I,
)
#: Marks that no sentence of a body carries.
_MARK = re.compile(r"©|\(c\) ?\d{4}|all rights reserved", re.I)
_NOTICE = re.compile(r"\b(?:we|our site|this (?:web)?site|cookies?|your privacy choices)\b.{0,60}\b(?:cookies?|similar tools|your (?:visit|experience)|statistics only|measure traffic|remember settings|pages load)\b|^cookies? (?:help|allow|let|are)|^your privacy (?:choices )?matter|^(?:usamos|utilizamos|nous utilisons|wir verwenden) .*cookies", re.I)
_BULLET = re.compile(r"^\s*(?:[-–•*·▪◦]|\d{1,2}[.)])\s+")
_BAR = re.compile(r"\s[|•·›»>/»]\s")
_DATED = re.compile(r"\s[–—-]\s+(?:january|february|march|april|may|june|july|august|september|october|november|december)\b.*$|\s[–—-]\s+\d[\d/.-]+$", re.I)
_WORD = re.compile(r"[^\W_]+")


def shape(line: str) -> str:
    """The trace of the tag that held a line: blank, li, td, bar, p, note (a short sentence) or short."""
    if not line or line.isspace():
        return "blank"
    if "\t" in line:
        return "td"
    if _BULLET.match(line):
        return "li"
    words = len(_DATED.sub("", line).split())
    ended = line.rstrip()[-1:] in ".?!:;”\""
    if len(_BAR.findall(line)) >= 2 and words <= 40 and not ended:
        return "bar"
    if words >= 9 or (ended and words >= 6):
        return "p"
    return "note" if ended and words >= 3 else "short"


class _Blocks(HTMLParser):
    """Leaf blocks of an HTML page with the tags around them."""

    #: Elements without an end tag, and elements whose text is no text.
    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    SILENT = frozenset(("script", "style", "noscript", "template"))
    INLINE = frozenset("a abbr b cite code em i kbd mark q s small span strong sub sup u var font label time".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.blocks: list[tuple[str, str]] = []
        self.text: list[str] = []

    def _flush(self) -> None:
        if text := " ".join("".join(self.text).split()):
            self.blocks.append((text, " ".join(self.open)))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag not in self.INLINE:
            self._flush()
        if tag not in self.VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self._flush()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.SILENT.intersection(self.open):
            self.text.append(data)

    def close(self):
        super().close()
        self._flush()


def html_blocks(html: str | None) -> list[tuple[str, str]]:
    """``(text, ancestor tags)`` of the leaf blocks of an HTML page."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    return parser.blocks


def _hash(text: str) -> int:
    return crc32(text.encode()) % WIDTH


def features(lines: list[str], tags: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all lines, flat, and where each line's begin."""
    shapes = [shape(x) for x in lines]
    full = [i for i, s in enumerate(shapes) if s != "blank"]
    # blocks between blank lines
    block, blocks = 0, []
    for s in shapes:
        if s == "blank":
            block += 1
        blocks.append(block)
    flat: list[int] = []
    starts: list[int] = []
    n = len(full)
    for order, i in enumerate(full):
        line, s = lines[i], shapes[i]
        before = shapes[i - 1] if i else "edge"
        after = shapes[i + 1] if i + 1 < len(lines) else "edge"
        words = _WORD.findall(line.lower())
        first_block, last_block = blocks[i] == blocks[full[0]], blocks[i] == blocks[full[-1]]
        name = [
            f"s={s}", f"b={before},s={s}", f"a={after},s={s}", f"ba={before},{s},{after}", f"n={min(len(words), 12)},s={s}",
            f"first={first_block},s={s}", f"last={last_block},s={s}", f"top={min(order, 4)}", f"end={min(n - 1 - order, 6)}", f"tenth={10 * order // n}",
            f"dated={bool(_DATED.search(line))}", f"end={line.rstrip()[-1:]}" if not line.rstrip()[-1:].isalnum() else "end=alnum", f"title={line.istitle()}",
            f"line={' '.join(words)}" if len(words) <= 8 else "line=long",
        ]
        name += [f"w={w}" if s in ("short", "bar", "note", "li", "td") else f"p={w}" for w in dict.fromkeys(words)]
        if tags is not None:
            name += [f"t={t}" for t in tags[i].split()]
        starts.append(len(flat))
        flat += map(_hash, name)
    return np.array(flat, np.int64), np.array(starts, np.int64)


class Field:
    """Weights of the field: one per feature and label, and one per pair of neighbouring labels."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((WIDTH, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def scores(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[flat], starts, axis=0)

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Field:
        """Maximum likelihood by AdaGrad; the gradient of a page comes from forward-backward."""
        seen, seen_moves = np.full((WIDTH, 2), 1e-6), np.full((2, 2), 1e-6)
        order = np.random.default_rng(1)
        for _ in range(epochs):
            for k in order.permutation(len(pages)):
                flat, starts, gold = pages[k]
                n = len(gold)
                emit = self.scores(flat, starts)
                gold_hot = np.eye(2)[gold]
                forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
                forward[0] = emit[0]
                for t in range(1, n):
                    forward[t] = emit[t] + np.logaddexp(forward[t - 1, 0] + self.moves[0], forward[t - 1, 1] + self.moves[1])
                for t in range(n - 2, -1, -1):
                    x = emit[t + 1] + backward[t + 1]
                    backward[t] = np.logaddexp(self.moves[:, 0] + x[0], self.moves[:, 1] + x[1])
                whole = np.logaddexp(*forward[-1])
                chance = np.exp(forward + backward - whole)
                pull = gold_hot - chance
                sizes = np.diff(np.append(starts, len(flat)))
                gradient = np.repeat(pull, sizes, axis=0)
                places, back = np.unique(flat, return_inverse=True)
                g = np.zeros((len(places), 2))
                np.add.at(g, back, gradient)
                g -= L2 * self.weights[places]
                seen[places] += g * g
                self.weights[places] += 0.3 * g / np.sqrt(seen[places])
                if n > 1:
                    pair = np.exp(forward[:-1, :, None] + self.moves + (emit[1:] + backward[1:])[:, None, :] - whole).sum(0)
                    gm = gold_hot[:-1].T @ gold_hot[1:] - pair
                    seen_moves += gm * gm
                    self.moves += 0.3 * gm / np.sqrt(seen_moves)
        return self

    def decode(self, flat: np.ndarray, starts: np.ndarray) -> list[int]:
        """The most likely labels, by Viterbi."""
        if len(starts) == 0:
            return []
        emit = self.scores(flat, starts).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = emit[0]
        back = []
        for ea, eb in emit[1:]:
            fa, fb = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if fa else 1, 0 if fb else 1))
            a, b = (a + m00 if fa else b + m10) + ea, (a + m01 if fb else b + m11) + eb
        at = 0 if a >= b else 1
        path = [at]
        for step in reversed(back):
            at = step[at]
            path.append(at)
        return path[::-1]


def label_pages(pages: list[list[str]]) -> list[list[int]]:
    """Labels for training pages, by layout and by whether a phrase lives in the pages' own prose.

    The first block is furniture if it is a bar, has several lines or a known
    control; a heading stands between blank lines; a sidebar starts at a known
    heading and takes short lines that no prose of the pages uses; what prose
    uses (a fee, a document, a system) is body.
    """
    prose = " " + " ".join(" ".join(_WORD.findall(x.lower())) for page in pages for x in page if shape(x) == "p" and not _NOTICE.search(x)) + " "
    lives: dict[str, bool] = {}
    phrase_of = lambda line: " ".join(_WORD.findall(_DATED.sub("", line).lower()))
    #: how often a phrase opens a sidebar, less how often it stands in a marked list or a table
    opens: Counter[str] = Counter()
    for page in pages:
        for a, b in zip(page, page[1:]):
            if _SIDE.match(a.strip()) and shape(b) == "short":
                opens[phrase_of(b)] += 1
            if shape(b) in ("li", "td"):
                opens[phrase_of(b)] -= 1

    def in_prose(line: str) -> bool:
        phrase = phrase_of(line)
        if opens[phrase] > 0:
            return False
        if phrase not in lives:
            lives[phrase] = bool(phrase) and f" {phrase} " in prose
        return lives[phrase]

    labels = []
    for page in pages:
        shapes = [shape(x) for x in page]
        full = [i for i, s in enumerate(shapes) if s != "blank"]
        out: dict[int, int] = {}
        if full:
            stop = next((i for i in range(full[0], len(page)) if shapes[i] == "blank"), len(page))
            top = range(full[0], stop)
            known = any(shapes[i] == "bar" or _CONTROL.match(page[i].strip()) or _NOTICE.search(page[i]) or _FOOTER.search(page[i]) for i in top)
            if stop < len(page) and (known or (len(top) > 2 and all(shapes[i] == "short" for i in top))):
                out |= dict.fromkeys(top, FURNITURE)
        side = False
        for i in full:
            line, s = page[i].strip(), shapes[i]
            lone = (i == 0 or shapes[i - 1] == "blank") and i + 1 < len(page)
            if i and shapes[i - 1] == "blank":
                side = False
            if i in out:
                continue
            if _CONTROL.match(line) or _MARK.search(line) or (_FOOTER.search(line) and s != "p") or (_NOTICE.search(line) and not lone):
                out[i] = FURNITURE
                side = bool(_SIDE.match(line))
            elif _SIDE.match(line) and not (lone and shapes[i + 1] == "blank"):
                out[i], side = FURNITURE, True
            elif s == "bar":
                out[i], side = FURNITURE, False
            elif side and s == "short" and not in_prose(line):
                out[i] = FURNITURE
            else:
                out[i] = BODY
                side = False
        labels.append([out[i] for i in full])
    return labels


#: Elements whose blocks are furniture, and elements that hold a page's own body.
SITE_TAGS = frozenset("nav footer aside header form button menu".split())
BODY_TAGS = frozenset(("main", "article"))


def label_blocks(blocks: list[tuple[str, str]]) -> list[int] | None:
    """Labels of an HTML page's blocks by their ancestor tags, or None for a page whose tags do not tell."""
    tags = [set(t.split()) for _, t in blocks]
    if not any(t & BODY_TAGS for t in tags) or not any(t & SITE_TAGS for t in tags):
        return None
    return [FURNITURE if t & SITE_TAGS or not t & BODY_TAGS else BODY for t in tags]


def html_features(blocks: list[tuple[str, str]], tagged: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Features of an HTML page's blocks, with those of their ancestor tags."""
    return features([x for x, _ in blocks], [t for _, t in blocks] if tagged else None)


def train_html(pages: DataFrame, most: int = TRAINING_PAGES, id_col: str = "source_id", html_col: str = "html") -> Field:
    """A field fitted to a bounded sample of HTML pages whose own tags label them.

    Each page takes part with its tags and without, so that pages which mark
    nothing are told by the words and places learnt from those that do.
    """
    sample = pages.where(F.col(html_col).rlike("(?i)<(main|article)") & (F.length(html_col) <= 4 * TRAINING_CHARS)).orderBy(F.xxhash64(id_col), id_col).limit(most).select(html_col).collect()
    examples = []
    for r in sample:
        blocks = html_blocks(r[0])
        if labels := label_blocks(blocks):
            examples += [(*html_features(blocks, tagged), np.array(labels)) for tagged in (True, False)]
    return Field().fit(examples)


def html_body(pages: DataFrame, field: Field, id_col: str = "source_id", html_col: str = "html") -> DataFrame:
    """``(id, block_no, text, body)`` of every leaf block of HTML pages; blocks are numbered from 1.

    Null and empty pages have no block; repeated rows repeat theirs.
    """
    shared = pages.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.moves))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            for i, html in enumerate(batch.column(1).to_pylist()):
                if blocks := html_blocks(html):
                    labels = own.decode(*html_features(blocks))
                    n = len(blocks)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([i] * n)), pa.array(range(1, n + 1), pa.int32()), pa.array([x for x, _ in blocks], pa.string()), pa.array([y == BODY for y in labels], pa.bool_())], names=[id_col, "block_no", "text", "body"])

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, block_no int, text string, body boolean")


def web_pages(texts: DataFrame, sources: DataFrame | None = None, artifacts: DataFrame | None = None) -> DataFrame:
    """``(source_id, text)`` of the texts captured from web pages.

    The method says so (html, however written); where it is missing, the mime type
    or extension of the artifact behind the source decides.
    """
    t = texts.where("source_id is not null and text is not null").select("source_id", "text", F.lower(F.trim("method")).alias("method"))
    web = t.where("method like '%html%' or method in ('web', 'webpage', 'web page')").select("source_id", "text")
    if sources is None or artifacts is None:
        return web
    silent = t.where("coalesce(method, '') = ''").select("source_id", "text")
    kind = sources.select("source_id", "artifact_id").join(artifacts.where("lower(mime_type) like '%html%' or (mime_type is null and lower(extension) rlike '^[.]?(html?|aspx?|php)$')").select("artifact_id"), "artifact_id")
    return web.unionByName(silent.join(kind.select("source_id").distinct(), "source_id", "left_semi"))


def train(pages: DataFrame, most: int = TRAINING_PAGES, id_col: str = "source_id") -> Field:
    """A field fitted to a bounded sample of the pages, labelled by label_pages.

    At most TRAINING_PAGES texts of TRAINING_CHARS come to the driver.  The phrases
    that label_pages knows are no features of the field, which has to tell them by
    their words, their neighbours and their place.
    """
    sample = pages.where(F.length("text") <= TRAINING_CHARS).orderBy(F.xxhash64(id_col), id_col).limit(most).select("text").collect()
    texts = [r[0].split("\n") for r in sample if r[0] and r[0].strip()]
    examples = [(*features(p), np.array(y)) for p, y in zip(texts, label_pages(texts)) if y]
    return Field().fit(examples)


def label_lines(pages: DataFrame, field: Field) -> DataFrame:
    """``(source_id, line_no, body)`` of every non-blank line; lines are numbered from 1.

    A null, empty or blank page has no line; repeated rows repeat their lines.
    """
    shared = pages.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            ids, numbers, body = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = text.split("\n")
                flat, starts = features(lines)
                full = [i for i, x in enumerate(lines) if x and not x.isspace()]
                ids += [key] * len(full)
                numbers += [i + 1 for i in full]
                body += [y == BODY for y in own.decode(flat, starts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(body, pa.bool_())], names=["source_id", "line_no", "body"])

    return pages.select("source_id", "text").mapInArrow(run, "source_id bigint, line_no bigint, body boolean")


def main_text(pages: DataFrame, field: Field) -> DataFrame:
    """``(source_id, body)``: each page's body lines, joined in order; blank lines between kept lines stay."""
    shared = pages.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.moves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            kept = []
            for text in batch.column(1).to_pylist():
                lines = text.split("\n")
                flat, starts = features(lines)
                full = [i for i, x in enumerate(lines) if x and not x.isspace()]
                drop = {i for i, y in zip(full, own.decode(flat, starts)) if y == FURNITURE}
                kept.append(re.sub(r"\n{3,}", "\n\n", "\n".join(x for i, x in enumerate(lines) if i not in drop)).strip("\n"))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(kept, pa.string())], names=["source_id", "body"])

    return pages.select("source_id", "text").mapInArrow(run, "source_id bigint, body string")
