"""Per-document text statistics and the kind of text they tell of (problem 10).

Method: word, symbol, line-ending and common-word statistics plus repetition
statistics (duplicate lines and paragraphs, cover of the dominant word n-gram),
and combined rules that part prose from lists, tables and junk.  One pass over
whole texts, no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Prose must fill this share of the characters of a text, else it is mainly something else.
PROSE_SHARE = 0.5
#: A few passages among at least six other lines do not make prose if they are fewer than this share of the lines.
PROSE_LINES = 0.15
#: A sentence has on average at least this many words, and at most that many.
SENTENCE_WORDS = (5.5, 80)
#: A list entry has at most this many words on average.
ENTRY_WORDS = 9
#: Words of the windows over which different words are counted: texts of every length are measured alike.
WINDOW = 200
#: Text of fewer different words than this share of a window is repetition.
FEW_DIFFERENT = 0.22
#: Sizes of the word n-grams whose cover of the text is measured.
NGRAMS = (2, 3, 4, 5, 6)
#: Text with more than this share of repeated paragraphs, of at least FEW_PARAGRAPHS, is boilerplate.
REPEATED_PARAGRAPHS, FEW_PARAGRAPHS = 0.6, 5
#: Sentences of which one n-gram covers this share, and few of whose words differ, are no prose.
DOMINANT, SOME_DIFFERENT = 0.4, 0.5

#: Frequent function words of languages written in Latin letters.
FUNCTION_WORDS = frozenset(
    """a an and are as at be been but by can for from has have he her his if in into is it its may more must no not of on
    or our shall she so than that the their them then there these they this to under until was we were when where which
    who will with within without would you your
    al como con cuando de del desde donde el ella en entre es esta este fue ha hasta la las le lo los más mientras no o
    para pero por que qui se según ser si sin sobre son su sus un una y
    au aux avec ce cette ces dans des du elle en est et il ils je leur les lors mais ne nous ont ou où par pas pour que
    qui sa sauf selon ses si sont sous sur un une vous
    aber als am an auf aus bei bis das dass dem den der des die durch ein eine einem einen einer eines er es für gegen
    hat ich im in ist mit muss nach nicht nur ob oder sich sie sind sofern über um und unter vom von vor wenn werden
    wie wird zu zum zur
    ao com da das do dos e em essa esse foi mais na nas não nos o os ou pela pelo seu sua um uma
    che chi con dal dalla degli dei del della delle di è gli il nel nella per più sono una uno
    aan dat de een en het in is met niet of op te van voor zijn""".split()
)

_BULLET = re.compile(r"^\s*(?:[-–—•·▪◦*+□☐☑✓✔>]|\[[ xX]?\]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.)])\s+")
_STAMP = re.compile(r"^\s*[\[(]?\d{1,2}:\d{2}(?::\d{2})?[\])]?\s*")
_END = re.compile(r"""[\w%)\]"'”’»€$][.!?…。！？]["'”’»]*(?=\s|$)""")
_LAST = re.compile(r"""[.!?…:;。！？]["'”’»)\]]*\s*$""")
_GAP = re.compile(r"\S(?:\t+| {2,})(?=\S)")
_NUMBER = re.compile(r"^[-+($€£]*\d[\d.,:/%]*[)%]?$")
_CODE = re.compile(r"[{}<>=\\]|;(?!\s)|;$|\(\)|\b0x[0-9a-f]+|(?:^|\s)(?:var|function|return|null|GET|POST|ERR\w*|https?:)\b|[\[\]]\s*[,;]|&&|\|\||::")
_VOWEL = re.compile(r"[aeiouyàáâäãåæèéêëìíîïòóôöõøùúûüýœ]", re.I)
_BLANK_LINE = re.compile(r"\n[^\S\n]*\n")
_SYMBOL = re.compile(r"[^\w\s]|_")
_ODD = re.compile(r"[^\w\s\x00-\x7f]")
_ASCII_ALNUM = {i: None for i in range(128) if chr(i).isalnum() or chr(i).isspace()}

FIELDS = [
    ("n_words", pa.int64()),
    ("mean_word_length", pa.float64()),
    ("symbol_ratio", pa.float64()),
    ("digit_ratio", pa.float64()),
    ("n_lines", pa.int64()),
    ("ended_line_share", pa.float64()),
    ("bullet_line_share", pa.float64()),
    ("common_word_share", pa.float64()),
    ("distinct_word_share", pa.float64()),
    ("duplicate_line_share", pa.float64()),
    ("duplicate_paragraph_share", pa.float64()),
    ("top_ngram_share", pa.float64()),
    ("prose_share", pa.float64()),
    ("kind", pa.string()),
]


def _units(lines: list[str]) -> Iterator[tuple[str, list[str]]]:
    """Runs of lines between blank lines; a bulleted line starts a run of its own with its unmarked followers."""
    run: list[str] = []
    bulleted = False
    for line in lines:
        if not line or line.isspace():
            if run:
                yield "item" if bulleted else "block", run
            run, bulleted = [], False
            continue
        m = stamped = None
        if not (line[0].isalpha() and line[1:2].isalpha()):
            m = _BULLET.match(line)
            stamped = m or _STAMP.match(line)
        if stamped:
            if run:
                yield "item" if bulleted else "block", run
            run, bulleted = [line[stamped.end() :]], m is not None
        elif bulleted and _LAST.search(run[-1]):
            yield "item", run
            run, bulleted = [line], False
        else:
            run.append(line)
    if run:
        yield "item" if bulleted else "block", run


def _is_prose(kind: str, run: list[str]) -> bool:
    """Whether the joined lines of a run read as sentences."""
    joined = " ".join(run)
    words = joined.split()
    n = len(words)
    if n < 4:
        return False
    ends = len(_END.findall(joined))
    if len(run) > 1 and ends <= len(run) // 12 and n <= len(run) * ENTRY_WORDS:
        return False
    if ends:
        per = n / ends
        if not SENTENCE_WORDS[0] <= per <= SENTENCE_WORDS[1]:
            return False
        if len(run) > 2 and sum(1 for x in run if _LAST.search(x)) == len(run) and n <= len(run) * 6:
            return False
        return True
    # no sentence ends: an unfinished sentence, or speech written down without marks
    common = sum(w.lower().strip(",") in FUNCTION_WORDS for w in words) / n
    return n >= 10 and common >= 0.25 and n >= len(run) * (ENTRY_WORDS - 3) and len(set(words)) > 0.3 * n


def _columns(line: str) -> int:
    """Cells beyond the first that the line is divided into by bars, tabs, wide gaps or commas."""
    bars = line.count("|")
    if bars >= 2 or (bars and ":" in line):
        return bars
    if gaps := len(_GAP.findall(line.strip())):
        return gaps
    commas = line.count(",") + line.count(";")
    return commas if commas >= 3 and len(line.split()) <= 4 * commas else 0


def distinct_share(words: list[str]) -> float:
    """Different words per word, the mean of windows of WINDOW words that cover the text (the last one reaches back)."""
    n = len(words)
    if n <= WINDOW:
        return len(set(words)) / n
    starts = [*range(0, n - WINDOW, WINDOW), n - WINDOW]
    return sum(len(set(words[k : k + WINDOW])) for k in starts) / (WINDOW * len(starts))


def top_cover(words: list[str]) -> int:
    """Most characters that occurrences of one word n-gram, none overlapping another, cover; 0 if none occurs twice.

    An n-gram that occurs twice goes on from shorter ones that do, so only such places are looked at again.
    """
    best = 0
    alive = range(len(words) - NGRAMS[0] + 1)
    for size in NGRAMS:
        places: dict[tuple, list[int]] = {}
        for i in alive:
            if i + size <= len(words):
                places.setdefault(tuple(words[i : i + size]), []).append(i)
        alive = []
        for gram, at in places.items():
            if len(at) > 1:
                alive += at
                chars = sum(map(len, gram))
                if len(at) * chars > best:
                    times, free = 0, -1
                    for i in at:
                        if i >= free:
                            times, free = times + 1, i + size
                    if times > 1:
                        best = max(best, times * chars)
    return best


def statistics(text: str | None) -> tuple:
    """The values of FIELDS for one text.

    A null, empty or blank text has counts of 0, null ratios and a null kind;
    kind is ``prose`` for prose and for fragments too short to tell.
    """
    if not text or text.isspace():
        return (0, None, None, None, 0, None, None, None, None, None, None, None, None, None)
    words = text.split()
    n, size = len(words), sum(map(len, words))
    if text.isascii():
        symbols = len(text.translate(_ASCII_ALNUM))
    else:
        symbols = len(_SYMBOL.findall(text))
    digits = sum(map(text.count, "0123456789"))
    lines = text.split("\n")
    full = [x for x in lines if x and not x.isspace()]
    ended = sum(1 for x in full if _LAST.search(x)) / len(full)
    bullets = sum(1 for x in full if not (x[0].isalpha() and x[1:2].isalpha()) and _BULLET.match(x))
    lower = text.lower().split()
    common = sum(w in FUNCTION_WORDS for w in lower) / n
    different = distinct_share(lower)
    twice = 1 - len({x.strip() for x in full}) / len(full)
    paragraphs = [p for p in _BLANK_LINE.split(text) if p.strip()]
    twice_p = 1 - len({p.strip() for p in paragraphs}) / len(paragraphs)
    top = top_cover(lower) / size
    prose = total = prose_lines = 0
    for kind, run in _units(lines):
        own = sum(map(len, run))
        total += own
        if _is_prose(kind, run):
            prose += own
            prose_lines += len(run)
    share = prose / total
    kind = _kind(text, full, lower, n, size, symbols, bullets, common, different, twice, twice_p if len(paragraphs) >= FEW_PARAGRAPHS else 0.0, top, share, prose_lines)
    return (n, size / n, symbols / size, digits / size, len(full), ended, bullets / len(full), common, different, twice, twice_p, top, share, kind)


def _kind(text, full, words, n, size, symbols, bullets, common, different, twice, twice_p, top, share, prose_lines) -> str:
    other_lines = len(full) - prose_lines
    repeated = n >= 40 and different < FEW_DIFFERENT
    if not text.isascii():
        odd = len(_ODD.findall(text))
        mixed = sum(1 for w in words if not w.isascii() and any(not c.isalnum() for c in w[1:-1]) and not w.replace("’", "").replace("–", "").replace("-", "").isalnum())
        if odd > 0.15 * size or (mixed > 0.5 * n and symbols > 0.2 * size):
            return "junk"
    if share >= PROSE_SHARE and not (other_lines >= 6 and prose_lines < PROSE_LINES * len(full)):
        # what says the same again and again is boilerplate, however well written
        return "junk" if (twice > 0.8 and len(full) >= 8) or (top > DOMINANT and different < SOME_DIFFERENT and n >= 40) or twice_p > REPEATED_PARAGRAPHS or repeated else "prose"
    letters = [w for w in words if w.isalpha() and len(w) > 1]
    dumb = sum(1 for w in letters if not _VOWEL.search(w))
    long_runs = sum(len(w) for w in words if len(w) >= 40 and not w.startswith(("http", "www")))
    code = sum(len(x) for x in full if _CODE.search(x))
    chars = sum(map(len, full))
    if long_runs > 0.5 * size or code > 0.5 * chars or symbols > 0.45 * size and _plain_grid(full) < 0.5:
        return "junk"
    if len(letters) >= 10 and dumb > 0.4 * len(letters):
        return "junk"
    columns = [_columns(x) for x in full]
    rows = sum(c >= 1 for c in columns)
    usual, often = Counter(c for c in columns if c).most_common(1)[0] if rows else (0, 0)
    numbers = sum(1 for w in words if _NUMBER.match(w))
    tabular = often >= 2 and (often >= 0.5 * len(full) and (usual >= 2 or numbers > 0.3 * n)) or rows >= 0.7 * len(full) and rows >= 2 and usual >= 2 or numbers > 0.6 * n and n >= 12
    per_line = n / len(full)
    if tabular and not (bullets > 0.6 * len(full) and usual < 2):
        return "table"
    if repeated and (top > DOMINANT or per_line > 6 and common < 0.2):
        return "junk"
    if len(full) >= 3 and (bullets >= 0.4 * len(full) or per_line <= ENTRY_WORDS):
        return "list"
    if n >= 30 and common < 0.12:
        return "junk" if different < 0.5 or per_line > 2 * ENTRY_WORDS else "list"
    return "prose"


def _plain_grid(full: list[str]) -> float:
    return sum(1 for x in full if _columns(x) >= 2) / len(full)


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of statistics and ``kind`` (prose, list, table, junk or null) per text, in one pass.

    Null, empty and blank texts give counts of 0 with null ratios and kind;
    repeated rows stay repeated; other columns are dropped.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([(id_col, to_arrow_type(df.schema[id_col].dataType)), *FIELDS])
    kinds = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'string' if t == pa.string() else 'double'}" for n, t in FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [[] for _ in FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema.field(0).type), *(pa.array(c, t) for c, (_, t) in zip(columns, FIELDS))], schema=schema)

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {kinds}")


def not_prose(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, kind)`` of the texts that are mainly a list, a table or junk."""
    return text_statistics(df, id_col, text_col).where("kind in ('list', 'table', 'junk')").select(id_col, "kind")
