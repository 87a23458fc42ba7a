"""Mapping freely typed entries to a canonical list (problem 7).

Method: symmetric-delete dictionary.  The names of the list are stored under every form
that up to MAX_EDITS deletions make of them, very long ones under their segments, and
sent to the workers behind a check of their number, or joined as a table beyond it; a typed
name is looked up under its own deletion forms and the segments near names share,
candidates are ranked by weighted Damerau-Levenshtein distance and reference frequency, and
what stays open is reported.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import combinations
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketlake.functions.text import STATE_CODES
from docketlake.session import broadcast_if_small, cut

MAX_EDITS = 2
#: A longer list than this is not broadcast: its deletion forms are a table and joined instead.
DICTIONARY_ENTRIES = 20_000
#: Entries whose weighted distance is less than this above the nearest count as equally near.
MARGIN = 0.15
#: Letters of the longest proper name stored under its deletion forms (they grow with the square of its length); longer
#: ones are stored under their segments. Two edits, letters changed in place over a border too, leave one of five whole.
LONGEST = 64
SEGMENTS = 2 * MAX_EDITS + 1
UNMATCHED = "unmatched"

_BY_NAME = {re.sub(r"[^a-z]", "", name): code for name, code in STATE_CODES.items()} | {code.lower(): code for code in STATE_CODES.values()} | {"puertorico": "PR", "pr": "PR"}

#: What kind of body a name is, by the words people write for it.
KINDS = (
    ("power and light", r"(?:power|pwr)\s*(?:and|&|\+|n)?\s*(?:light|lt|lgt)|p\s*(?:&|and|\+)\s*l"),
    ("energy authority", r"en(?:e?r?)gy\s+(?:authority|auth|agency)|energy\s+auth\w*"),
    ("electric cooperative", r"el(?:ec?(?:tric(?:al)?|t?r?)?)?\s*(?:co-?\s?op(?:erative)?|cooperative)|e\s?m\s?c|rural electric\w*"),
    ("municipal utility district", r"mun(?:i|ic(?:ipal)?)?\s+ut(?:il(?:ity|ities)?)?\s+dist(?:rict)?|m\s?\.?\s?u\s?\.?\s?d"),
    ("public power", r"pub(?:lic)?\s+(?:power|pwr)(?:\s+(?:agency|district|authority))?"),
    ("county", r"county|cnty|cty|co"),
    ("township", r"township|twp|twnshp|tnshp"),
    ("village", r"village|vlg|vill?"),
    ("parish", r"parish|par|psh"),
    ("city", r"city|municipality"),
    ("town", r"town"),
    ("borough", r"borough|boro"),
)
_KIND = [(kind, re.compile(rf"(?<!\w)(?:{words})(?!\w)")) for kind, words in KINDS]
#: Words of an office or a note that name no body.
_FILLER = re.compile(r"(?<!\w)(?:gov'?t|govt|government|planning|building|permit(?:s|ting)?|zoning|inspection|dept|department|office|hall|division|counter|desk|unincorporated|incorporated|inc|company|the|of|charter|usa|u\s?s\s?a?|united states|america|corp(?:oration)?|services?)(?!\w)")
_STATE_AT_END = re.compile(r"(?:[,(–—-]|\s-)\s*([a-z][a-z. ]*?)\s*\)?\s*$")


def plain(text: str | None) -> str:
    """``text`` without accents, case and spare white space."""
    if not text:
        return ""
    text = unicodedata.normalize("NFKD", text)
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).casefold().replace("’", "'").split())


def state_of(text: str | None) -> str | None:
    """The postal code that a typed state means, or None (a country or nonsense tells no state)."""
    return _BY_NAME.get(re.sub(r"[^a-z]", "", plain(text)))


def parse(name: str | None) -> tuple[str, str | None, str | None]:
    """The proper name, the kind of body and the state within a typed name."""
    t = plain(name)
    t = re.sub(r"#\s*\d+|\*+|\((?:unincorporated|unincorp\.?)\)", " ", t).strip()
    t = re.sub(r"[,(\s]+u\.?s\.?(?:a\.?)?\)?\s*\.?$", "", t)
    state = None
    if (m := _STATE_AT_END.search(t)) and (state := state_of(m.group(1))):
        t = t[: m.start()]
    t = re.sub(r"[.,;:()\[\]\"/_–—]+", " ", t)
    t = re.sub(r"\s+-\s+|\s-|-\s", " ", f" {t} ")
    t = " ".join(t.split())
    kind = None
    for this, pattern in _KIND:
        if m := (pattern.search(t) if kind is None else None):
            rest = t[: m.start()] + " " + t[m.end() :]
            if re.search(r"[a-z]", _FILLER.sub(" ", rest)):
                kind, t = this, rest
    if kind in ("power and light", "public power"):
        t = re.sub(r"(?<!\w)co(?!\w)", " ", t)
    t = _FILLER.sub(" ", t)
    if kind is None and len(words := t.split()) > 1:
        # a kind that is itself mistyped
        for w in words[1:] + words[:1]:
            near = [k for k, _ in KINDS if " " not in k and len(k) > 3 and distance(w, k, 1) <= 1]
            if near:
                kind = near[0]
                words.remove(w)
                t = " ".join(words)
                break
    return re.sub(r"[^a-z0-9]", "", t), kind, state


def distance(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance (adjacent letters may change places), or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def weighted_distance(a: str, b: str) -> float:
    """Damerau-Levenshtein distance where a doubled or dropped double letter, two letters
    changed in place and a vowel for a vowel weigh less, and a change of the first letter more."""
    vowels = "aeiouy"
    row2: list[float] = []
    row = [0.0]
    for j, y in enumerate(b, 1):
        row.append(row[-1] + (1.2 if j == 1 else 1.0))
    for i, x in enumerate(a, 1):
        new = [row[0] + (1.2 if i == 1 else 1.0)]
        for j, y in enumerate(b, 1):
            drop = 0.7 if i > 1 and a[i - 2] == x else 1.0
            add = 0.7 if j > 1 and b[j - 2] == y else 1.0
            swap = 0.0 if x == y else (0.8 if x in vowels and y in vowels else 1.0) + (0.2 if i == 1 and j == 1 else 0.0)
            d = min(row[j] + drop, new[j - 1] + add, row[j - 1] + swap)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, row2[j - 2] + 0.8)
            new.append(d)
        row2, row = row, new
    return row[-1]


def edits_for(word: str) -> int:
    """Edits that a word of this length may have; very short ones match exactly or not at all."""
    return 0 if len(word) < 4 else 1 if len(word) < 7 else MAX_EDITS


def deletions(word: str, most: int) -> set[str]:
    """``word`` and what up to ``most`` deletions make of it."""
    forms = {word}
    for n in range(1, min(most, len(word) - 1) + 1):
        forms.update("".join(word[i] for i in range(len(word)) if i not in gone) for gone in map(set, combinations(range(len(word)), n)))
    return forms


def segments(length: int) -> list[tuple[int, int]]:
    """Where the SEGMENTS parts of a word of this length begin and end."""
    bounds = [length * k // SEGMENTS for k in range(SEGMENTS + 1)]
    return list(zip(bounds, bounds[1:]))


def index_keys(base: str) -> set[str]:
    """Under what an entry's proper name is stored: its deletion forms, or its segments if it is long."""
    if len(base) > LONGEST:
        return {f"{len(base)}:{k}:{base[a:b]}" for k, (a, b) in enumerate(segments(len(base)))}
    return deletions(base, edits_for(base))


def probe_keys(base: str, lengths: Iterable[int] | None = None) -> set[str]:
    """Under what a typed name is looked up; ``lengths`` are those of long entries, if known."""
    out = deletions(base, edits_for(base)) if len(base) <= LONGEST + MAX_EDITS else set()
    for length in range(max(len(base) - MAX_EDITS, LONGEST + 1), len(base) + MAX_EDITS + 1):
        if lengths is None or length in lengths:
            for k, (a, b) in enumerate(segments(length)):
                out.update(f"{length}:{k}:{base[at : at + b - a]}" for at in range(max(0, a - MAX_EDITS), a + MAX_EDITS + 1))
    return out


def fits(kind: str | None, said: list[str], others: list, own_kind: str | None, own_state: str | None, own_others: list) -> bool:
    """Whether kind, told states and further fields of an item leave an entry open; what either side lacks decides nothing."""
    return (kind is None or own_kind is None or kind == own_kind) and (own_state is None or all(s == own_state for s in said)) and all(a is None or b is None or a == b for a, b in zip(others, own_others))


def said_states(state: str | None, within: str | None, fields: list[str] | None) -> list[str]:
    """The states that an item tells, if its roster goes by state (also a roster without known fields does)."""
    return sorted({x for x in (state_of(state), within) if x}) if "state" in (fields if fields is not None else ["state"]) else []


class Dictionary:
    """Entries ``(target_id, roster, state, name, others)`` under the deletion forms, or the segments, of their proper names."""

    def __init__(self, entries: list[tuple]):
        self.entries: dict[tuple[str, str], list[tuple]] = {}
        for target, roster, state, name, *others in entries:
            base, kind, within = parse(name)
            if target is not None and base:
                entry = (target, kind, state_of(state) or within, [plain(o) or None for o in (others[0] if others else [])])
                if entry not in (bucket := self.entries.setdefault((roster, base), [])):
                    bucket.append(entry)
        self.forms: dict[tuple[str, str], list[str]] = {}
        self.lengths: dict[str, set[int]] = {}
        for roster, base in self.entries:
            if len(base) > LONGEST:
                self.lengths.setdefault(roster, set()).add(len(base))
            for key in index_keys(base):
                self.forms.setdefault((roster, key), []).append(base)

    def look_up(self, roster: str | None, state: str | None, name: str | None, fields: list[str] | None = None, others: list | None = None, nearest: bool = False) -> list[tuple[int, float, str]]:
        """``(edits, weight, target)`` of the entries left for a typed item, the nearest first.

        With ``nearest``, farther ones are not looked for where entries of the very name are left.
        """
        base, kind, within = parse(name)
        if not base:
            return []
        said = said_states(state, within, fields)
        others = [plain(o) or None for o in others or []]
        left = lambda found: [(edits, weighted_distance(base, other), t) for other, edits in found.items() for t, k, s, o in self.entries[roster, other] if fits(kind, said, others, k, s, o)]
        near = {base: 0} if (roster, base) in self.entries else {}
        if nearest and near and (exact := left(near)):
            return sorted(exact)
        most = edits_for(base)
        for key in probe_keys(base, self.lengths.get(roster, ())):
            for other in self.forms.get((roster, key), ()):
                if other not in near and (d := distance(base, other, most)) <= most:
                    near[other] = d
        return sorted(left(near))

    def match(self, *key) -> tuple[str | None, int, int | None]:
        """The one target that is nearest, how many stand equally near, and their edits."""
        left = self.look_up(*key, nearest=True)
        if not left:
            return None, 0, None
        best = left[0]
        equal = {t for e, w, t in left if e == best[0] and w < best[1] + MARGIN}
        return (best[2] if len(equal) == 1 else None), len(equal), best[0]


#: The dictionary that a worker made last, by the number of the query.
_WORKER: dict[str, Dictionary] = {}


def _asked(items: DataFrame, targets: DataFrame, rosters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items as ``(item_id, roster, state, name, fields, others)`` and entries as ``(target_id, roster, state, name, others)``.

    ``others`` are the identity fields beside name and state that both tables have.
    """
    names = {r[0] for r in rosters.select(F.explode("fields")).distinct().collect()}
    further = sorted(n for n in names - {"state", "name"} if n in items.columns and n in targets.columns)
    of = lambda df: F.array(*(F.col(f"`{n}`").cast("string") for n in further)).cast("array<string>").alias("others")
    fields = rosters.where("roster is not null").groupBy("roster").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("fields", F.array().cast("array<string>")))))).alias("fields"))
    i = items.select("item_id", "roster", "state", "name", of(items)).join(broadcast_if_small(fields), "roster", "left")
    return i.select("item_id", "roster", "state", "name", "fields", "others"), targets.select("target_id", "roster", "state", "name", of(targets)).distinct()


def match_items(items: DataFrame, targets: DataFrame, rosters: DataFrame, largest: int = DICTIONARY_ENTRIES) -> DataFrame:
    """``(item_id, target_id, candidates, edits)``: every item with its one target, or ``unmatched``.

    An item is unmatched if no target is near enough or several are equally near;
    a null or blank name, an unknown roster and an empty list leave it unmatched.
    Which of state, name and further common columns decide is told by the roster's
    fields.  A repeated item is repeated; a null id stays null; other columns are
    not read.  The list is broadcast behind a check of its number; beyond
    ``largest`` its deletion forms are a table, with the same result.
    """
    i, entries = _asked(items, targets, rosters)
    listed = entries.limit(largest + 1).collect()
    if len(listed) > largest:
        return _match_by_table(i, entries)
    shared, number = items.sparkSession.sparkContext.broadcast([tuple(r) for r in listed]), uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (dictionary := _WORKER.get(number)) is None:
            _WORKER.clear()
            dictionary = _WORKER[number] = Dictionary(shared.value)
        seen: dict[tuple, tuple] = {}
        for batch in batches:
            rows = []
            for roster, state, name, fields, others in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                key = (roster, state, name, *others)
                if key not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen[key] = dictionary.match(roster, state, name, fields, others)
                rows.append(seen[key])
            found = [r[0] or UNMATCHED for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found, pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())], names=["item_id", "target_id", "candidates", "edits"])

    return i.mapInArrow(run, "item_id bigint, target_id string, candidates int, edits int")


def _parsed(rows: DataFrame) -> DataFrame:
    """``rows`` (roster, state, name, fields, others, kept) with base, kind and the states said; ``kept`` is carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roster, state, name, fields, others, kept = (batch.column(i).to_pylist() for i in range(6))
            parts = [parse(n) for n in name]
            said = [said_states(s, p[2], f) for s, p, f in zip(state, parts, fields)]
            own = [state_of(s) or p[2] for s, p in zip(state, parts)]
            plains = [[plain(o) or None for o in os] for os in others]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), batch.column(0), pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts], pa.string()), pa.array(own, pa.string()), pa.array(said, pa.list_(pa.string())), pa.array(plains, pa.list_(pa.string()))], names=["kept", "roster", "base", "kind", "own", "said", "others"])

    return rows.select("roster", "state", "name", "fields", "others", "kept").mapInArrow(run, "kept string, roster string, base string, kind string, own string, said array<string>, others array<string>").where("base != ''")


def finds(typed: DataFrame, entries: DataFrame) -> DataFrame:
    """``(kept, target_id, edits, weight)``: entries left for each typed row, by joins on the deletion index."""
    t, e = _parsed(typed), _parsed(entries.select("roster", "state", "name", F.lit(None).cast("array<string>").alias("fields"), "others", F.col("target_id").alias("kept")).where("kept is not null"))
    e = e.select("roster", F.col("base").alias("other"), F.col("kept").alias("target_id"), F.col("kind").alias("own_kind"), F.col("own").alias("own_state"), F.col("others").alias("own_others"))

    def keyed(names: DataFrame, column: str, keys_of) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for roster, base in zip(*(batch.column(i).to_pylist() for i in range(2))):
                    keys = sorted(keys_of(base))
                    yield pa.RecordBatch.from_arrays([pa.array([roster] * len(keys), pa.string()), pa.array([base] * len(keys)), pa.array(keys)], names=["roster", column, "key"])

        return names.distinct().mapInArrow(run, f"roster string, {column} string, key string")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [distance(a, b, edits_for(a)) for a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2)))]
            weight = [weighted_distance(a, b) for a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(near, pa.int32()), pa.array(weight, pa.float64())], names=["roster", "base", "other", "edits", "weight"])

    pairs = keyed(t.select("roster", "base"), "base", probe_keys).join(keyed(e.select("roster", "other"), "other", index_keys), ["roster", "key"]).select("roster", "base", "other").distinct()
    edits_of = F.when(F.length("base") < 4, 0).when(F.length("base") < 7, 1).otherwise(MAX_EDITS)
    near = cut(pairs.mapInArrow(verified, "roster string, base string, other string, edits int, weight double").where(F.col("edits") <= edits_of))
    told = F.col("own_state").isNull() | F.forall("said", lambda s: s == F.col("own_state"))
    same_kind = F.col("kind").isNull() | F.col("own_kind").isNull() | (F.col("kind") == F.col("own_kind"))
    further = F.forall(F.arrays_zip("others", "own_others"), lambda p: p["others"].isNull() | p["own_others"].isNull() | (p["others"] == p["own_others"]))
    return t.join(near, ["roster", "base"]).join(e, ["roster", "other"]).where(told & same_kind & further).select("kept", "target_id", "edits", "weight").distinct()


def _typed(items: DataFrame) -> DataFrame:
    """Items with ``kept``, the text of what was typed, by which equal ones are looked up once."""
    return items.withColumn("kept", F.to_json(F.struct("roster", "state", "name", "fields", "others")))


def _match_by_table(items: DataFrame, entries: DataFrame) -> DataFrame:
    """What match_items gives, by joins alone."""
    asked = _typed(items)
    found = cut(finds(asked.drop("item_id").distinct(), entries))
    best = found.groupBy("kept").agg(F.min(F.struct("edits", "weight")).alias("best"))
    equal = found.join(best, "kept").where((F.col("edits") == F.col("best.edits")) & (F.col("weight") < F.col("best.weight") + MARGIN))
    told = equal.groupBy("kept").agg(F.count_distinct("target_id").cast("int").alias("candidates"), F.min("target_id").alias("one"), F.min("edits").alias("edits"))
    out = asked.select("item_id", "kept").join(told, "kept", "left")
    return out.select(F.col("item_id").cast("long").alias("item_id"), F.when(F.col("candidates") == 1, F.col("one")).otherwise(UNMATCHED).alias("target_id"), F.coalesce("candidates", F.lit(0)).alias("candidates"), "edits")


def ranked_candidates(items: DataFrame, targets: DataFrame, rosters: DataFrame, top: int = 5) -> DataFrame:
    """``(roster, state, name, items, rank, target_id, edits, weight, frequency)``: for each different typed value that
    meets no single target, its ``top`` nearest entries by edits, weighted distance and reference frequency.

    The frequency of an entry is the number of items matched to it.  It ranks what
    is equally near, for a person to decide; it decides nothing by itself.
    Values that nothing is near to have no row.
    """
    i, entries = _asked(items, targets, rosters)
    matched = cut(match_items(items, targets, rosters))
    frequency = matched.where(F.col("target_id") != UNMATCHED).groupBy("target_id").agg(F.count("*").alias("frequency"))
    open_ = matched.where((F.col("target_id") == UNMATCHED) & (F.col("candidates") > 0)).select("item_id").distinct()
    asked = _typed(i.join(open_, "item_id")).groupBy("roster", "state", "name", "fields", "others", "kept").agg(F.count("*").alias("items"))
    asked = cut(asked)
    left = finds(asked.drop("items"), entries).join(broadcast_if_small(frequency), "target_id", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    order = Window.partitionBy("kept").orderBy("edits", "weight", F.desc("frequency"), "target_id")
    return left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(asked, "kept").select("roster", "state", "name", "items", "rank", "target_id", "edits", "weight", "frequency")
