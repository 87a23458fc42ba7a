"""Consensus of several annotators' labels (problem 6).

Method: triplet moments.  Taken class by class, an annotator's votes for and against the
class agree with another's beyond chance by the product of what each knows of the truth,
so that for three annotators t_i^2 = C_ij C_ik / C_jk with C the agreement corrected for
chance; the median over all pairs (j, k) counts.  With the partners' accuracies known, how
an annotator's every answer goes with a partner's class gives what that answer says of
each class, and votes are combined by its log-odds.  One who turns two classes round so
weighs for the other one, and one who always says the same weighs nothing.  All is solved
from the pair rates in closed form; no likelihood is climbed.

Answers stay in long form, one row per item and annotator.  All annotators are partners
(j, k); a pair that shares few items counts for little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.session import broadcast_if_small, cut

#: The classes of an answer.
CLASSES = ("Yes", "No", "Sometimes", "Never", "NA")
#: Written forms without case, spaces and punctuation.
FORMS = {"yes": "Yes", "y": "Yes", "true": "Yes", "no": "No", "n": "No", "false": "No", "sometimes": "Sometimes", "never": "Never", "na": "NA", "notapplicable": "NA"}
#: Shared items from which on a pair of annotators counts in full; below, by the third power of its share of them.
PLENTY = 30
#: Pairs of answers that are counted at once.
PAIRS_AT_ONCE = 1 << 21
#: Rates are kept from 0 and 1 by this much.
FLOOR = 0.005


def answer_of(value: Column) -> Column:
    """The class of a loosely written value, or null for a blank or unknown one."""
    key = F.regexp_replace(F.lower(value), r"[^\p{L}]+", "")
    return F.create_map(*(F.lit(x) for kv in FORMS.items() for x in kv))[key]


def annotator_of(label: Column) -> Column:
    """A source's label without case, outer spaces and the choice of separator; null if blank."""
    return F.nullif(F.regexp_replace(F.trim(F.lower(label)), r"[\s_\-]+", "-"), F.lit(""))


def final_answers(cells: DataFrame) -> DataFrame:
    """``(cluster_id, field, annotator, answer)``: each source's last answer to each item.

    Cells that are blank, not assessed (or null in that) or of unknown value are no
    answers.  Of answers at the same time the first class in the order of CLASSES
    counts; an answer without a time is the oldest.  Repeated cells count once.
    """
    c = cells.select("cluster_id", "field", annotator_of(F.col("label")).alias("annotator"), answer_of(F.col("value")).alias("answer"), "assessed", "labelled_at")
    c = c.where("assessed and answer is not null and annotator is not null and cluster_id is not null and field is not null")
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(CLASSES) for x in (k, -i)))[F.col("answer")]
    return c.groupBy("cluster_id", "field", "annotator").agg(F.max_by("answer", F.struct(F.coalesce("labelled_at", F.lit("0001-01-01").cast("timestamp_ntz")), rank)).alias("answer"))


def code_of(answer: Column) -> Column:
    return F.create_map(*(F.lit(x) for i, k in enumerate(CLASSES) for x in (k, i)))[answer]


def partners_in(answers: DataFrame) -> list[str]:
    """All annotators, those with the most answers first, then by name; their number by their place here."""
    return [r[0] for r in answers.groupBy("annotator").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "annotator").collect()]


def pair_tables(answers: DataFrame, partners: list[str]) -> DataFrame:
    """``(who, at, n)``: how often annotator ``who`` answered a where partner j answered b; at numbers (j, a, b).

    An item's answers, one an annotator, make one short row; its pairs are counted
    in slices of PAIRS_AT_ONCE and combined before the shuffle, so that no
    annotator with a third of all answers is gathered anywhere.
    """
    k, m = len(CLASSES), len(partners)
    places = answers.sparkSession.createDataFrame([(a, i) for i, a in enumerate(partners)], "annotator string, who int")
    numbered = answers.join(broadcast_if_small(places), "annotator")
    items = numbered.groupBy("cluster_id", "field").agg(F.collect_list(F.col("who") * k + code_of(F.col("answer"))).alias("votes")).select("votes")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = np.asarray(batch.column(0).flatten()).astype(np.int64)
            size = np.asarray(pa.compute.list_value_length(batch.column(0))).astype(np.int64)
            first, met = np.repeat(size.cumsum() - size, size), np.repeat(size, size)
            upto = met.cumsum()
            lo = 0
            while lo < len(votes):
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
                n = met[lo:hi]
                one = np.repeat(votes[lo:hi], n)
                other = votes[np.repeat(first[lo:hi] - (n.cumsum() - n), n) + np.arange(n.sum())]
                at, times = np.unique(((one // k * m + other // k) * k + one % k) * k + other % k, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((at // (m * k * k)).astype(np.int32)), pa.array((at % (m * k * k)).astype(np.int32)), pa.array(times)], names=["who", "at", "n"])
                lo = hi

    return items.mapInArrow(count, "who int, at int, n bigint").groupBy("who", "at").agg(F.sum("n").alias("n"))


def moments(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pair tables ``[..., j, a, b]``: overlaps, agreement on each class and on all beyond chance."""
    seen = joint.sum((-2, -1))
    safe = np.maximum(seen, 1)[..., None]
    both, own, other = np.einsum("...jaa->...ja", joint) / safe, joint.sum(-1) / safe, joint.sum(-2) / safe
    per_class = both - own * other
    chance = (own * other).sum(-1)
    return seen, per_class, np.where(seen > 0, (both.sum(-1) - chance) / np.maximum(1 - chance, 1e-6), 0)


def founded(seen: np.ndarray) -> np.ndarray:
    """What pairs of annotators count for, by the items that they share."""
    return (np.minimum(seen, PLENTY) / PLENTY) ** 3


def middle(values: np.ndarray, weights: np.ndarray) -> float:
    """Weighted median; between two values that share the middle, their mean."""
    order = values.argsort(kind="stable")
    upto = weights[order].cumsum()
    half = upto[-1] / 2
    low, high = np.searchsorted(upto, half * (1 - 1e-9)), np.searchsorted(upto, half * (1 + 1e-9))
    return float(values[order[low]] + values[order[min(high, len(order) - 1)]]) / 2


def triplets(mine: np.ndarray, seen: np.ndarray, theirs: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], me: int) -> float:
    """Median over partners j, k of sqrt(C_ij C_ik / C_jk), signed as the agreements with partners at large; nan without any.

    ``pairs``: j, k and what the pair counts for.
    """
    worth = founded(seen)
    worth[me] = 0
    j, k, shared = pairs
    weights = worth[j] * worth[k] * shared
    ok = weights > 0
    if not ok.any():
        return float("nan")
    j, k = j[ok], k[ok]
    square = mine[j] * mine[k] / theirs[j, k]
    towards = (mine * worth * np.minimum(seen, 1e4) * np.sign(theirs.sum(1))).sum()
    return float(np.sqrt(max(middle(square, weights[ok]), 0.0)) * (1 if towards >= 0 else -1))


class Partners:
    """What all annotators' pair tables tell: agreements, class shares, and from them each annotator's rates."""

    def __init__(self, joint: np.ndarray):
        self.joint = joint
        self.seen, self.per_class, self.kappa = moments(joint)
        for x in (self.per_class, self.kappa):
            x[np.arange(len(joint)), np.arange(len(joint))] = 0
        np.fill_diagonal(self.seen, 0)
        self.pairs = {None: self._pairs(self.kappa, 0.1)} | {c: self._pairs(self.per_class[:, :, c], 0.002) for c in range(len(CLASSES))}
        self.share = np.full(len(CLASSES), 1 / len(CLASSES))
        accuracy = np.array([self.accuracy(joint[i], i) for i in range(len(joint))])
        own = np.einsum("iiaa->ia", joint)
        trusted = np.clip(accuracy, 0, None) ** 2 @ (own / np.maximum(own.sum(1, keepdims=True), 1))
        if trusted.sum() > 0:
            self.share = np.clip(trusted / trusted.sum(), FLOOR, 1)

    def _pairs(self, theirs: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs j < k that share items and agree by more than ``least``, either way, and what they count for."""
        j, k = np.nonzero(np.triu((self.seen > 0) & (np.abs(theirs) > least), 1))
        return j, k, founded(self.seen[j, k])

    def accuracy(self, joint: np.ndarray, me: int) -> float:
        """Accuracy beyond chance over all classes."""
        seen, _, kappa = moments(joint)
        a = triplets(kappa, seen, self.kappa, self.pairs[None], me)
        return 0.5 if np.isnan(a) else float(np.clip(a, -0.2, 0.99))

    def slope(self, joint: np.ndarray, me: int, c: int) -> float:
        """How much more often an annotator names class c where it is true than where it is not."""
        seen, per_class, _ = moments(joint)
        p = self.share[c]
        t = triplets(per_class[:, c], seen, self.per_class[:, :, c], self.pairs[c], me)
        # too rare a class to compare: as good as the annotator is at large
        return self.accuracy(joint, me) if np.isnan(t) else float(np.clip(t / np.sqrt(p * (1 - p)), -1, 1))

    def learn(self) -> Partners:
        """The annotators' own slopes ``[j, c]``, with which they measure others."""
        own = np.einsum("iiaa->ia", self.joint)
        trust = np.clip([self.accuracy(j, i) for i, j in enumerate(self.joint)], 0, None) ** 2 * own.sum(1)
        for last in (False, False, True):
            self.slopes = np.array([[self.slope(j, i, c) for c in range(len(CLASSES))] for i, j in enumerate(self.joint)]).reshape(len(self.joint), len(CLASSES))
            if last or trust.sum() == 0:
                break
            # the shares that the trusted annotators' answers have once their own tables are taken off
            solved = [np.linalg.lstsq(self.table(j, i).T, o / max(o.sum(), 1), rcond=None)[0] for i, (j, o) in enumerate(zip(self.joint, own))]
            share = np.clip(np.average(solved, axis=0, weights=trust), FLOOR, 1)
            self.share = share / share.sum()
        return self

    def table(self, joint: np.ndarray, me: int) -> np.ndarray:
        """``[c, a]``: how often an annotator answers a where c is true.

        That a goes with a partner's c beyond chance is the product of what a tells
        of c and the partner's own slope; the weighted median over partners counts.
        """
        k = len(CLASSES)
        seen = joint.sum((1, 2))
        named = joint.sum((0, 2)) / max(joint.sum(), 1)
        safe = np.maximum(seen, 1)[:, None, None]
        beyond = joint / safe - (joint.sum(2) / safe[:, :, 0])[:, :, None] * (joint.sum(1) / safe[:, :, 0])[:, None, :]
        out = np.empty((k, k))
        for c, p in enumerate(self.share):
            ok = (seen >= 1) & (self.slopes[:, c] > 0.25)
            ok[me] = False
            if ok.any():
                found = beyond[ok][:, :, c] / (self.slopes[ok, c] * p * (1 - p))[:, None]
                weight = seen[ok] * founded(seen[ok]) * self.slopes[ok, c] ** 2
                order = found.argsort(0)
                heavy = (weight[order].cumsum(0) >= weight.sum() / 2).argmax(0)
                extra = found[order[heavy, np.arange(k)], np.arange(k)]
            else:
                extra = self.slope(joint, me, c) * (np.eye(k)[c] - named) / max(1 - named[c], 0.1)
            out[c] = np.clip(named + extra * (1 - p), FLOOR, 1)
        return out / out.sum(1, keepdims=True)


def _tables(pairs: DataFrame, m: int) -> np.ndarray:
    """All pair tables ``[i, j, a, b]``; they come to the driver annotator by annotator, 25 counts for each two that share items."""
    k = len(CLASSES)
    joint = np.zeros((m, m * k * k))
    for who, cells in pairs.groupBy("who").agg(F.collect_list(F.struct("at", "n")).alias("cells")).toLocalIterator():
        joint[who, [c["at"] for c in cells]] = [c["n"] for c in cells]
    return joint.reshape(m, m, k, k)


def annotator_weights(answers: DataFrame) -> DataFrame:
    """``(annotator, accuracy, expected_correct, answers, weights)`` of every annotator.

    ``weights[a][c]`` is what answer a adds to the log-odds of class c.
    """
    names = partners_in(answers)
    pairs = cut(pair_tables(answers, names))
    joint = _tables(pairs, len(names))
    partners = Partners(joint).learn()
    partners.joint = None  # workers read their annotators' tables
    shared = answers.sparkSession.sparkContext.broadcast((partners, names))
    k, m = len(CLASSES), len(names)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = shared.value
        for batch in batches:
            accuracy, expected, weights = [], [], []
            for i, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                joint = np.zeros(m * k * k)
                for c in cells:
                    joint[c["at"]] = c["n"]
                joint = joint.reshape(m, k, k)
                table = known.table(joint, i)
                # against the annotator's answers at large, so that an answer which tells nothing adds nothing
                weights.append(np.log(table / (known.share @ table)).T.tolist())
                accuracy.append(known.accuracy(joint, i))
                expected.append(float((known.share * np.diag(table)).sum()))
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in batch.column(0).to_pylist()], pa.string()), pa.array(accuracy, pa.float64()), pa.array(expected, pa.float64()), pa.array(weights, pa.list_(pa.list_(pa.float64())))], names=["annotator", "accuracy", "expected_correct", "weights"])

    given = answers.groupBy("annotator").agg(F.count("*").alias("answers"))
    found = pairs.groupBy("who").agg(F.collect_list(F.struct("at", "n")).alias("cells")).mapInArrow(weigh, "annotator string, accuracy double, expected_correct double, weights array<array<double>>")
    prior = F.array(*(F.lit(float(x)) for x in np.log(partners.share)))
    return found.join(given, "annotator").withColumn("prior", prior)


def label_consensus(cells: DataFrame) -> DataFrame:
    """``(cluster_id, field, value, agreement, support, n_sources)`` of items answered by at least two sources.

    ``value`` has the highest log-odds; ties go to the first of CLASSES.
    ``agreement`` is the share of an item's sources that gave the value and
    ``support`` its chance under the model.  See final_answers for nulls, blanks,
    ties and repeats; an empty table gives an empty result.
    """
    answers = cut(final_answers(cells))
    weights = annotator_weights(answers).select("annotator", "weights", "prior")
    votes = answers.withColumn("code", code_of(F.col("answer"))).join(broadcast_if_small(cut(weights)), "annotator")
    odds = [F.sum(F.get(F.get("weights", F.col("code")), F.lit(c))).alias(f"odds{c}") for c in range(len(CLASSES))]
    times = [F.count_if(F.col("code") == c).alias(f"times{c}") for c in range(len(CLASSES))]
    items = votes.groupBy("cluster_id", "field").agg(*odds, *times, F.first("prior").alias("prior"), F.count("*").alias("n")).where("n >= 2")
    scored = items.select("cluster_id", "field", "n", F.array(*(F.round(F.col(f"odds{c}") + F.get("prior", F.lit(c)), 9) for c in range(len(CLASSES)))).alias("odds"), F.array(*(f"times{c}" for c in range(len(CLASSES)))).alias("times"))
    best = scored.withColumn("best", F.array_position("odds", F.array_max("odds")).cast("int"))
    chance = 1 / F.aggregate("odds", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("odds")))
    return best.select("cluster_id", "field", F.element_at(F.array(*map(F.lit, CLASSES)), F.col("best")).alias("value"), (F.element_at("times", F.col("best")) / F.col("n")).alias("agreement"), chance.alias("support"), F.col("n").cast("int").alias("n_sources"))


def annotator_reliability(cells: DataFrame) -> DataFrame:
    """``(annotator, accuracy, expected_correct, answers)``: triplet accuracy beyond chance, and the chance that an answer is right."""
    return annotator_weights(cut(final_answers(cells))).select("annotator", "accuracy", "expected_correct", "answers")
