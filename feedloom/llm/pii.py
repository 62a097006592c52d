"""Personal data: patterns, and a semi-Markov conditional random field that adds what they miss.

Base spans come from four patterns. The field works on the regions around digits and at-signs
(a text without either has no personal data and is not touched): a region is cut into atoms, any
run of at most ``MOST_ATOMS`` atoms is a candidate segment of any kind, features of whole spans
score it, and dynamic programming over boundaries and kinds jointly picks the best labelling.
Its weights maximise the conditional likelihood of base spans in a bounded sample of regions, and
of pairs of such spans set side by side: there the patterns run on from one into the next and drop
both, so regions of the sample where that may have happened are not taken for examples.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, strings

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training sample: distinct passages of each probe taken in the order of a hash,
#: regions used of them, and examples for each pair of neighbours.
SAMPLE_ROWS, SAMPLE_REGIONS, SAMPLE_JOINS = 60, 240, 6
#: What sampled passages are around: anything the field looks at, and the look of each kind.
PROBES = (
    "[0-9@]",
    r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
    r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "[0-9](?:[ -]?[0-9]){13}",
    r"\+[0-9][ ().0-9-]{8}",
)
#: Characters of a sampled passage before the place that a probe found, and from there on.
BEFORE, FROM = 100, 220
#: A candidate segment has at most this many atoms and characters.
MOST_ATOMS, MOST_CHARS = 16, 80
#: An added span must be this sure, as a probability of the field.
SURE = 0.9
EPOCHS, RATE, SHRINK = 100, 1.0, 1e-4

#: The patterns of the base spans.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

SIGNAL = re.compile("[0-9@]")
WORD = re.compile(
    r"(?<![A-Za-z0-9._%+@()-])[A-Za-z._%+()-]*+[0-9@][A-Za-z0-9._%+@()-]*+"
)
ATOM = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; found from the at-signs, so a long run of letters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; kinds by their place in ``KINDS``."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if not SIGNAL.search(text):
        return out
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if _octets(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring words of which each holds a digit or an at-sign."""
    start = end = -1
    for word in WORD.finditer(text):
        if start >= 0 and text[end : word.start()] == " ":
            end = word.end()
            continue
        if start >= 0:
            yield start, end
        start, end = word.span()
    if start >= 0:
        yield start, end


#: Of a whole span: what is in it and what stands beside it.
FEATURES = (
    "bias atoms_1 atoms_2_3 atoms_4_6 atoms_7_9 atoms_more digits_0 digits_1_6 digits_7_9 "
    "digits_10_13 digits_14_19 digits_more one_at local_ok domain_ok ends_letters plus_first "
    "bracket_pair dots_3 dots_other octets_ok digit_groups_4 groups_3_3_4 luhn_ok letters spaces "
    "hyphens starts_odd ends_odd cuts_left cuts_right"
).split()
PLACE = {name: k for k, name in enumerate(FEATURES)}


def features(text: str, start: int, end: int, atoms: int) -> list[int]:
    """Places of the features that the span has."""
    span = text[start:end]
    digits = _digits(span)
    n = len(digits)
    before, after = text[start - 1 : start], text[end : end + 1]
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    local, at, domain = span.partition("@")
    names = ["bias"]
    names.append(
        "atoms_1" if atoms == 1 else "atoms_2_3" if atoms < 4 else "atoms_4_6" if atoms < 7
        else "atoms_7_9" if atoms < 10 else "atoms_more"
    )
    names.append(
        "digits_0" if n == 0 else "digits_1_6" if n < 7 else "digits_7_9" if n < 10
        else "digits_10_13" if n < 14 else "digits_14_19" if n < 20 else "digits_more"
    )
    dots = span.count(".")
    for name, has in (
        ("one_at", at and "@" not in domain),
        ("local_ok", at and local and all(c in LOCAL for c in local)),
        ("domain_ok", at and DOMAIN.fullmatch(domain) is not None),
        ("ends_letters", at and span[-1:].isalpha()),
        ("plus_first", span[0] == "+"),
        ("bracket_pair", span.count("(") == span.count(")") == 1),
        ("dots_3", dots == 3),
        ("dots_other", dots not in (0, 3)),
        ("octets_ok", dots == 3 and len(groups) == 4 and IP.fullmatch(span) and _octets(span)),
        ("digit_groups_4", len(groups) > 1 and set(groups[:-1]) == {4}),
        ("groups_3_3_4", groups[-3:] == [3, 3, 4]),
        ("luhn_ok", n >= 14 and luhn(digits)),
        ("letters", not at and any(c.isalpha() for c in span)),
        ("spaces", " " in span),
        ("hyphens", "-" in span),
        ("starts_odd", not (span[0].isalnum() or span[0] in "+(")),
        ("ends_odd", not span[-1].isalnum()),
        ("cuts_left", before.isalnum() or (before != "" and before in "@+._%")),
        ("cuts_right", after.isalnum() or after == "@"),
    ):
        if has:
            names.append(name)
    return [PLACE[name] for name in names]


class Segments:
    """Candidate segments of a region, as atom boundaries and feature places."""

    def __init__(self, text: str, start: int, end: int, taken=lambda a, b: False):
        cuts = [start + m.start() for m in ATOM.finditer(text[start:end])] + [end]
        self.cuts, self.n = cuts, len(cuts) - 1
        self.spans: list[tuple[int, int]] = []
        self.places: list[list[int]] = []
        for i in range(self.n):
            for j in range(i + 1, min(self.n, i + MOST_ATOMS) + 1):
                if cuts[j] - cuts[i] > MOST_CHARS:
                    break
                span = text[cuts[i] : cuts[j]]
                # No kind begins or ends with a space, or lacks digits and at-sign alike.
                if span[0] == " " or span[-1] == " " or not SIGNAL.search(span):
                    continue
                if taken(cuts[i], cuts[j]):
                    continue
                self.spans.append((i, j))
                self.places.append(features(text, cuts[i], cuts[j], j - i))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """One row per candidate, one column per kind."""
        return np.array([weights[:, p].sum(axis=1) for p in self.places]).reshape(-1, len(KINDS))


def forward_backward(n: int, spans, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """Log partition and the probability of each candidate and kind; plain atoms score 0."""
    with np.errstate(divide="ignore"):
        all_kinds = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j) in enumerate(spans):
        by_end[j].append(k)
        by_start[i].append(k)

    def total(values: list[float]) -> float:
        top = max(values)
        return top + math.log(sum(math.exp(v - top) for v in values))

    alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        alpha[j] = total([alpha[j - 1], *(alpha[spans[k][0]] + all_kinds[k] for k in by_end[j])])
    for i in range(n - 1, -1, -1):
        beta[i] = total([beta[i + 1], *(beta[spans[k][1]] + all_kinds[k] for k in by_start[i])])
    around = np.array([alpha[i] + beta[j] for i, j in spans]) - alpha[n]
    return alpha[n], np.exp(scores + around[:, None]) if len(spans) else scores


def best_labels(n: int, spans, scores: np.ndarray) -> list[tuple[int, int]]:
    """(candidate, kind) of the best labelling, by dynamic programming over bounded segments."""
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    top = scores.argmax(axis=1) if len(spans) else []
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(spans):
        by_end[j].append(k)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for k in by_end[j]:
            value = best[spans[k][0]] + scores[k, top[k]]
            if value > best[j]:
                best[j], back[j] = value, k
    out, j = [], n
    while j:
        k = back[j]
        if k is None:
            j -= 1
        else:
            out.append((k, int(top[k])))
            j = spans[k][0]
    return out[::-1]


def overruns(text: str) -> list[tuple[int, int]]:
    """Matches that the patterns drop although they may hold personal data: joined neighbours."""
    out = []
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if len(digits) > 19 or (
            len(digits) >= 14
            and not luhn(digits)
            and any(len(g) >= 14 and luhn(g) for g in re.findall("[0-9]+", m.group()))
        ):
            out.append(m.span())
    out += [m.span() for m in PHONE.finditer(text) if len(_digits(m.group())) > 15]
    return out


def _spellings(text: str, kind: int) -> list[str]:
    """Other ways to write a true span that the patterns take for the same kind."""
    other = []
    if kind == 2:
        digits = _digits(text)
        groups = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        other = [" ".join(groups), "-".join(groups)]
    elif kind == 3:
        other = [re.sub("[()]", "", text), "+4" + re.sub("[()]", "", text[1:])]
    return [x for x in other if x != text and (0, kind, len(x)) in base_spans(x)]


def joins(found: dict[int, list[str]], plain: list[str]) -> Iterator[tuple[str, list]]:
    """Texts of true spans standing side by side, or beside a plain number, with their spans.

    ``found`` has texts of true spans by kind and ``plain`` words with digits that are none. A
    card with a digit changed is a number like others, alone and beside a true span.
    """
    pick = random.Random(7)
    none = len(KINDS)
    words, plain = {k: v + [x for text in v for x in _spellings(text, k)] for k, v in found.items()}, list(plain)
    for card in found.get(2, [])[:SAMPLE_JOINS]:
        plain.append(card[:-1] + str((int(card[-1]) + 1) % 10))
    if plain:
        words[none] = plain
    for first in words:
        for second in words:
            for _ in range(SAMPLE_JOINS):
                a, b = pick.choice(words[first]), pick.choice(words[second])
                spans = [(0, first, len(a)), (len(a) + 1, second, len(a) + 1 + len(b))]
                yield f"{a} {b}", [s for s in spans if s[1] != none]


def _case(text: str, start: int, end: int, gold):
    """Candidates of a region, their features, and which of them are true; None without any."""
    segments = Segments(text, start, end)
    if not segments.spans:
        return None
    where = {(segments.cuts[i], segments.cuts[j]): k for k, (i, j) in enumerate(segments.spans)}
    truth, done = [], -1
    for a, kind, b in gold:
        if (a, b) in where and a >= done:
            truth.append((where[a, b], kind))
            done = b
    matrix = np.zeros((len(segments.spans), len(FEATURES)))
    for row, places in zip(matrix, segments.places):
        row[places] = 1
    return segments, matrix, truth


def fit(sample: list[str]) -> np.ndarray:
    """Weights by kind and feature: gradient ascent on the conditional log-likelihood."""
    cases, plain = [], []
    found: dict[int, list[str]] = {}
    for text in sample:
        gold, dropped = base_spans(text), overruns(text)
        for a, kind, b in gold:
            if b - a <= MOST_CHARS and not any(a < y and x < b for x, y in dropped):
                found.setdefault(kind, []).append(text[a:b])
        for start, end in regions(text):
            if len(cases) == SAMPLE_REGIONS:
                break
            if end - start > 200 or any(start < b and a < end for a, b in dropped):
                continue
            case = _case(text, start, end, gold)
            if case:
                cases.append(case)
                if not case[2] and " " not in text[start:end]:
                    plain.append(text[start:end])
    for text, gold in joins({k: found[k] for k in sorted(found)}, plain):
        case = _case(text, 0, len(text), gold)
        if case and len(case[2]) == len(gold):
            cases.append(case)
    weights = np.zeros((len(KINDS), len(FEATURES)))
    weights[:, PLACE["bias"]] = -3.0
    seen = np.full_like(weights, 1e-6)
    for _ in range(EPOCHS if cases else 0):
        slope = -SHRINK * len(cases) * weights
        for segments, matrix, truth in cases:
            _, expected = forward_backward(segments.n, segments.spans, matrix @ weights.T)
            for k, kind in truth:
                slope[kind] += matrix[k]
            slope -= expected.T @ matrix
        seen += slope**2
        weights += RATE * slope / np.sqrt(seen)
    return weights


def added_spans(text: str, weights: np.ndarray, base) -> list[tuple[int, int, int]]:
    """What the field finds beside the base spans: sure segments that touch none of them."""
    out = []
    starts = [a for a, _, _ in base]
    # Base spans of several kinds may overlap; the farthest end so far bounds what is free.
    ends, far = [], 0
    for _, _, b in base:
        far = max(far, b)
        ends.append(far)

    def taken(a: int, b: int) -> bool:
        at = bisect_right(starts, b - 1)
        return bool(at) and ends[at - 1] > a

    for start, end in regions(text):
        k = bisect_right(starts, start)
        if k and ends[k - 1] >= end:
            continue  # All of it is a base span.
        for first, last in pieces_of(text, start, end):
            segments = Segments(text, first, last, taken)
            if not segments.spans:
                continue
            scores = segments.scores(weights)
            if scores.max() <= 0:
                continue
            _, sure = forward_backward(segments.n, segments.spans, scores)
            for k, kind in best_labels(segments.n, segments.spans, scores):
                i, j = segments.spans[k]
                a, b = segments.cuts[i], segments.cuts[j]
                if sure[k, kind] >= SURE:
                    out.append((a, kind, b))
    return out


def pieces_of(text: str, start: int, end: int, most: int = 4000) -> Iterator[tuple[int, int]]:
    """A very long region in parts; cut at a space where there is one, so the work is linear."""
    while end - start > most:
        cut = text.rfind(" ", start + most // 2, start + most)
        cut = cut if cut > 0 else start + most
        yield start, cut
        start = cut
    yield start, end


def _sample(docs: DataFrame, text_col: str) -> list[str]:
    """At most ``SAMPLE_ROWS`` distinct passages for each probe, dealt in turn.

    A passage is of whole words around the first place in a text that the probe finds; copies
    count once, so that common ones do not fill the sample.
    """
    text = F.col(text_col).cast("string")
    sample = []
    for probe in PROBES:
        at = F.regexp_instr(text, F.lit(probe))
        cut = docs.select(text.alias("text"), at.alias("at")).where("at > 0")
        passage = F.substring("text", F.greatest(F.col("at") - BEFORE, F.lit(1)), F.lit(BEFORE + FROM))
        passage = F.when(F.col("at") > BEFORE, F.regexp_replace(passage, r"^\S*", "")).otherwise(passage)
        goes_on = F.length("text") > F.greatest(F.col("at") - BEFORE, F.lit(1)) + BEFORE + FROM - 1
        passage = F.when(goes_on, F.regexp_replace(passage, r"\S*+$", "")).otherwise(passage)
        lines = cut.select(passage.alias("line")).distinct()
        found = lines.orderBy(F.xxhash64("line"), "line").limit(SAMPLE_ROWS)
        sample.append([row.line for row in found.collect()])
    return list(dict.fromkeys(x for own in zip_longest(*sample) for x in own if x))


def _find(weights: np.ndarray):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in strings(batch["text"]):
                base = base_spans(text)
                added = added_spans(text, weights, base) if SIGNAL.search(text) else []
                out.append(
                    [{"kind": KINDS[k], "start": a, "end": b, "base": True} for a, k, b in base]
                    + [{"kind": KINDS[k], "start": a, "end": b, "base": False} for a, k, b in added]
                )
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(out, SPANS)], ["row", "spans"]
            )

    return find


SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )
)
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find_spans(
    docs: DataFrame, keep: list[str] | None = None, text_col: str = "text"
) -> tuple[DataFrame, str]:
    """The columns ``keep`` (all) and an array of spans: kind, start, end in code points, base.

    Returns the frame and the array's name (``spans``, with underscores where that is taken).
    Texts are read whole; a null or empty text has no spans; repeated rows each have theirs;
    an empty table gives no rows. The field's training sample is bounded, all else covers every
    text. Nothing is shuffled but the sample.
    """
    keep = list(keep or docs.columns)
    name = free_name(docs, "spans")
    weights = fit(_sample(docs, text_col))
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep)
    found = docs.select(
        F.struct(*keep).alias("row"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_find(weights), f"row struct<{kinds}>, spans {SPANS_DDL}")
    return found.select("row.*", F.col("spans").alias(name)), name


def redact(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first one stands."""
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"]))):
        if span["start"] >= done:
            out += [text[done : span["start"]], f"[{span['kind'].upper()}]"]
            done = span["end"]
        elif span["end"] > done:
            done = span["end"]
    return "".join(out) + text[done:]


def _redact(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                if text and SIGNAL.search(text):
                    base = base_spans(text)
                    both = base + added_spans(text, weights, base)
                    spans = [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in both]
                    text = redact(text, spans) if spans else text
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(out, pa.string())], ["row", "text"]
            )

    return run


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, every span of its texts replaced by its kind; null stays null."""
    weights = fit(_sample(docs, text_col))
    rest = [c for c in docs.columns if c != text_col]
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in rest)
    found = docs.select(
        F.struct(*rest).alias("row"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_redact(weights), f"row struct<{kinds}>, text string")
    return found.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.{c}") for c in docs.columns))
