"""Personal data in texts: four kinds by rule, and more by a semi-Markov conditional random field.

Rules find the base spans. The field scores candidate segments of up to ``LONGEST`` words in the regions that hold
digits or @, by what holds for each as a whole (digits, groups, marks, checksums, shape). It is there for what the
rules cannot see, so it learns from spans written differently: besides a sample of regions as they stand, it is given
them with every span rewritten as people do (a phone without its plus sign, an address with blanks or brackets around
the @, a card number with points), so that no rule finds it. Numbers in the sample that are no spans, like card
numbers with a wrong checksum, teach it what to leave alone. A part of the sample is held out, and the probability
from which segments are added is the lowest that is nearly always right there.

Dynamic programming over boundaries and kinds sums all segmentations of a region, which gives each segment its
probability; the best segmentation's segments that are likely enough are added where no base span stands.
Regions are never cut: a long one is streamed, and a few numbers are kept for each of its words.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlab.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone")

LONGEST = 5  # words of a segment
REGION = 32  # words of a region that the field is fitted on; there, a longer one is several
SAMPLE_DOCS = 400  # documents that the field is fitted on
SAMPLE_REGIONS = 300
SURE = 0.99  # probability from which a segment is added, unless held-out regions allow a lower one
THRESHOLDS = (0.5, 0.7, 0.8, 0.9, 0.95)  # tried from the first
RIGHT = 0.97  # share of the segments added in held-out regions that must be right
HELD_OUT = 4  # of so many regions one is held out

Span = tuple[str, int, int]

# The rules' patterns. A start inside a run of digits can never be the leftmost one, so it is not tried.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]")
_BEFORE, _BEHIND = frozenset("\"'<[{#$%&*|="), frozenset(".,;:!?\"'>]}#$%&*|")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @ backwards, so that long words cost no more."""
    free = 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at) if at >= free else None
        if m:
            start = at
            while start > free and text[start - 1] in _LOCAL_SIGNS:
                start -= 1
            if start < at:
                yield start, m.end()
                free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """What the rules find, by start, then kind."""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(s, 0, e) for s, e in emails(text)]
    if _MARKED.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def regions(text: str, most: int | None = None) -> Iterator[list[tuple[int, int]]]:
    """Runs of words with a digit or @, two words apart at most, each with a word before and two behind it.

    Words are given as (start, end) without the quotes, brackets and stops around them; no word is in two regions.
    ``most`` cuts runs of so many words, as examples to fit on: regions then end behind the second unmarked word
    and may share a word with the next.
    """
    if not _MARKED.search(text):
        return
    run: list[tuple[int, int]] = []
    before: tuple[int, int] | None = None
    last = 99  # words since the last marked one
    for m in re.finditer(r"\S+", text):
        word = _trimmed(text, m.start(), m.end())
        if _MARKED.search(text, m.start(), m.end()):
            if not run and before:
                run.append(before)
            last = 0
        else:
            last += 1
        if run and last == 3:
            yield run
            run = []
        if run or last == 0:
            run.append(word)
            if most and (last >= 2 or len(run) >= most):
                yield run
                run = []
        before = word
    if run:
        yield run


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end - start > 1 and text[end - 1] in _BEHIND:
        end -= 1
    while end - start > 1 and text[start] in _BEFORE:
        start += 1
    return start, end


def features(text: str, words: int) -> list[str]:
    """Names of what holds for a candidate segment as a whole."""
    digits = _digits(text)
    letters = sum(c.isalpha() for c in text)
    parts = text.split(".")
    octets = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    head, at, tail = re.sub(r"[\s()\[\]]", "", text).replace(",", ".").partition("@")
    groups = re.findall(r"[0-9]+", text)
    sizes = "-".join(str(min(len(g), 9)) for g in groups[:6])
    marks = "".join(sorted({c for c in text if not c.isalnum()}))
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", text)))[:16]
    return [f"words {words}", f"digits {min(len(digits), 20)}", f"letters {min(letters, 4)}", f"dots {min(text.count('.'), 4)}",
            f"at {min(text.count('@'), 2)}", f"plus {text[:1] == '+'}", f"octets {octets}",
            f"checksum {14 <= len(digits) <= 19 and luhn(digits)}", f"shape {shape}", f"groups {sizes if letters == 0 else ''}",
            f"four small {len(groups) == 4 and letters == 0 and all(len(g) <= 3 and int(g) <= 255 for g in groups)}",
            f"marks {marks[:8]}", f"lengths {len(digits)} {len(groups)} {letters > 0}",
            f"mail {bool(at and head and '.' in tail.strip('.') and '@' not in tail)}",
            f"other {any(not (c.isalnum() or c in ' .+-()@%_') for c in text)}"]


def context(text: str, words: list[tuple[int, int]], i: int, j: int) -> list[str] | None:
    """Names of what holds for words i .. j-1 of a region as a segment; None if it is not a candidate."""
    own = text[words[i][0]:words[j - 1][1]]
    if not _MARKED.search(own):
        return None
    return [*features(own, j - i), f"behind a digit {i > 0 and text[words[i - 1][1] - 1].isdigit()}",
            f"before a digit {j < len(words) and text[words[j][0]].isdigit()}"]


class Region:
    """A region's candidate segments: for each (start, end) of words the places of its features."""

    def __init__(self, text: str, words: list[tuple[int, int]], names: dict[str, int], grow: bool):
        self.words = words
        self.segments: dict[tuple[int, int], np.ndarray] = {}
        for i in range(len(words)):
            for j in range(i + 1, min(i + LONGEST, len(words)) + 1):
                held = context(text, words, i, j)
                if held is None:
                    continue
                if grow:
                    for f in held:
                        names.setdefault(f, len(names))
                self.segments[i, j] = np.array([names[f] for f in held if f in names], np.int64)

    def gold(self, spans: list[Span]) -> dict[tuple[int, int], int] | None:
        """Segments of the base spans; None if one of them has other bounds than whole words."""
        starts, ends = {s: i for i, (s, _) in enumerate(self.words)}, {e: i + 1 for i, (_, e) in enumerate(self.words)}
        found = {}
        for kind, s, e in spans:
            if s < self.words[-1][1] and e > self.words[0][0]:
                if s not in starts or e not in ends or (starts[s], ends[e]) not in self.segments:
                    return None
                found[starts[s], ends[e]] = KINDS.index(kind)
        return found


class Field:
    """Weights of (kind, feature); a word outside all segments scores nothing."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, bias: np.ndarray, sure: float = SURE):
        self.names, self.weights, self.bias, self.sure = names, weights, bias, sure

    def scores(self, region: Region) -> dict[tuple[int, int], np.ndarray]:
        return {at: self.bias + self.weights[:, f].sum(axis=1) for at, f in region.segments.items()}

    def inside(self, region: Region, scores) -> tuple[np.ndarray, np.ndarray]:
        """Log sums over all segmentations of the words before, and behind, each boundary."""
        n = len(region.words)
        ending: list[list] = [[] for _ in range(n + 1)]
        starting: list[list] = [[] for _ in range(n + 1)]
        for (i, j), s in scores.items():
            total = _logsum(s)
            ending[j].append((i, total))
            starting[i].append((j, total))
        ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            ahead[j] = _logsum(np.array([ahead[j - 1], *(ahead[i] + s for i, s in ending[j])]))
        for i in range(n - 1, -1, -1):
            behind[i] = _logsum(np.array([behind[i + 1], *(behind[j] + s for j, s in starting[i])]))
        return ahead, behind

    def probabilities(self, region: Region) -> dict[tuple[int, int], np.ndarray]:
        """Of each segment and kind."""
        scores = self.scores(region)
        ahead, behind = self.inside(region, scores)
        return {(i, j): np.exp(ahead[i] + s + behind[j] - ahead[-1]) for (i, j), s in scores.items()}

    def best(self, region: Region) -> list[tuple[int, int, int]]:
        """(start, end, kind) of the best segmentation: boundaries and kinds chosen together."""
        n, scores = len(region.words), self.scores(region)
        value, step = np.zeros(n + 1), [(0, -1)] * (n + 1)
        for j in range(1, n + 1):
            value[j], step[j] = value[j - 1], (j - 1, -1)
            for i in range(max(0, j - LONGEST), j):
                if (i, j) in scores:
                    kind = int(scores[i, j].argmax())
                    if value[i] + scores[i, j][kind] > value[j]:
                        value[j], step[j] = value[i] + scores[i, j][kind], (i, kind)
        found, at = [], n
        while at:
            i, kind = step[at]
            if kind >= 0:
                found.append((i, at, kind))
            at = i
        return found[::-1]


    def likely(self, text: str, words: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, float]]:
        """(start, end, kind, probability) of the segments of the best segmentation of a region, of any length.

        One pass ahead finds it and the sums up to each boundary, one pass back the sums behind; scores are held
        for the segments that end at one boundary, and their sums for the way back.
        """
        n = len(words)
        value, ahead, behind = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
        size, kind, score = np.ones(n + 1, np.int8), np.full(n + 1, -1, np.int8), np.zeros(n + 1)
        sums = np.full((n + 1, LONGEST + 1), -np.inf)  # of the segments by end and words
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for i in range(max(0, j - LONGEST), j):
                held = context(text, words, i, j)
                if held is None:
                    continue
                own = self.bias + self.weights[:, [self.names[f] for f in held if f in self.names]].sum(axis=1)
                sums[j, j - i] = _logsum(own)
                k = int(own.argmax())
                if value[i] + own[k] > value[j]:
                    value[j], size[j], kind[j], score[j] = value[i] + own[k], j - i, k, own[k]
            back = np.arange(1, min(LONGEST, j) + 1)
            ahead[j] = _logsum(np.append(ahead[j - back] + sums[j, back], ahead[j - 1]))
        for i in range(n - 1, -1, -1):
            on = np.arange(1, min(LONGEST, n - i) + 1)
            behind[i] = _logsum(np.append(behind[i + on] + sums[i + on, on], behind[i + 1]))
        at = n
        while at:
            i = at - int(size[at])
            if kind[at] >= 0:
                yield i, at, int(kind[at]), math.exp(min(0.0, ahead[i] + score[at] + behind[at] - ahead[n]))
            at = i


def _logsum(x: np.ndarray) -> float:
    top = x.max()
    return float(top + math.log(np.exp(x - top).sum()))


def train(examples: list[tuple], rounds: int = 150, rate: float = 0.2, ridge: float = 1e-6) -> Field:
    """Ascend the likelihood of the spans' segmentations; examples are (text, words, spans) of regions, or without
    spans, which are the base spans then."""
    names: dict[str, int] = {}
    known = []
    for text, words, *spans in examples:
        region = Region(text, words, names, grow=True)
        gold = region.gold(spans[0] if spans else base_spans(text))
        if gold is not None:
            known.append((region, gold))
    field = Field(names, np.zeros((len(KINDS), len(names) + 1)), np.full(len(KINDS), -2.0))
    past, past_bias = np.full_like(field.weights, 1e-4), np.full_like(field.bias, 1e-4)
    for _ in range(rounds if known else 0):
        slope, slope_bias = -ridge * len(known) * field.weights, np.zeros_like(field.bias)
        for region, gold in known:
            for at, p in field.probabilities(region).items():
                change = -p
                if at in gold:
                    change[gold[at]] += 1
                if np.abs(change).max() > 1e-9:
                    np.add.at(slope.T, region.segments[at], change)
                    slope_bias += change
        past = 0.9 * past + 0.1 * slope**2
        past_bias = 0.9 * past_bias + 0.1 * slope_bias**2
        field.weights += rate * slope / np.sqrt(past + 1e-4)
        field.bias += rate * slope_bias / np.sqrt(past_bias + 1e-4)
    return field


def _between(signs: str, text: str) -> str:
    """The groups of digits of a text with ``signs`` between them; a long run is cut into fours."""
    groups = re.findall(r"[0-9]+", text)
    if len(groups) == 1:
        groups = re.findall(r"[0-9]{1,4}", groups[0])
    return signs.join(groups)


#: Ways in which spans are written that the rules do not see.
REWRITTEN: dict[str, list[Callable[[str], str]]] = {
    "email": [lambda x: x.replace("@", " @ "), lambda x: x.replace("@", "(@)"), lambda x: x.replace("@", "[@]"),
              lambda x: x.replace("@", "@ "), lambda x: x.partition("@")[0] + "@" + x.partition("@")[2].replace(".", ",")],
    "ip": [lambda x: x.replace(".", ","), lambda x: x.replace(".", ". "), lambda x: x.replace(".", "[.]"),
           lambda x: x.replace(".", "-"), lambda x: x.replace(".", " ")],
    "card": [lambda x: _between(".", x), lambda x: _between("/", x), lambda x: _between("  ", x), lambda x: _between("_", x)],
    "phone": [lambda x: x.removeprefix("+"), lambda x: "00" + x.removeprefix("+"), lambda x: _between("/", x),
              lambda x: _between(".", x), lambda x: _between(" ", x)],
}


def rewritten(text: str, pick: int) -> tuple[str, list[Span]]:
    """The text with each base span written in another way, the ``pick``-th from one chosen by the span itself, and
    where the spans stand now. Spans that overlap others, or that a rule still finds, stay out of the result."""
    parts, spans, at, end = [], [], 0, 0
    for kind, s, e in base_spans(text):
        if s < end:
            continue
        ways = REWRITTEN[kind]
        new = ways[(zlib.crc32(text[s:e].encode("utf-8", "replace")) + pick) % len(ways)](text[s:e])
        parts += [text[end:s], new]
        at += s - end
        spans.append((kind, at, at + len(new)))
        at, end = at + len(new), e
    made = "".join(parts) + text[end:]
    seen = [(s, e) for _, s, e in base_spans(made)]
    return made, [x for x in spans if not any(s < x[2] and e > x[1] for s, e in seen)]


def examples(text: str, pick: int) -> Iterator[tuple]:
    """(text, words, spans) of a region as it stands and, if it has spans, of the same with all of them rewritten."""
    def words(own: str) -> list[tuple[int, int]]:
        return [_trimmed(own, m.start(), m.end()) for m in re.finditer(r"\S+", own)]

    base = base_spans(text)
    yield text, words(text), base
    if base:
        made, spans = rewritten(text, pick)
        if len(spans) == len(base):
            yield made, words(made), spans


def likely_spans(field: Field, text: str, words: list[tuple[int, int]]) -> list[tuple[Span, float]]:
    return [((KINDS[k], words[i][0], words[j - 1][1]), p) for i, j, k, p in field.likely(text, words)]


def threshold(field: Field, held: list[tuple]) -> float:
    """The lowest of ``THRESHOLDS`` from which at least ``RIGHT`` of the segments added in held-out examples are
    right, or ``SURE``."""
    found = []
    for text, words, spans in held:
        base = base_spans(text)
        found += [(p, span in spans) for span, p in likely_spans(field, text, words)
                  if not any(s < span[2] and e > span[1] for _, s, e in base)]
    for least in THRESHOLDS:
        taken = [right for p, right in found if p >= least]
        if len(taken) >= 20 and sum(taken) >= RIGHT * len(taken):
            return least
    return SURE


def fit(docs: DataFrame) -> Field:
    """Fit the field on a bounded sample: regions of the ``SAMPLE_DOCS`` documents with a digit or @ whose texts hash
    lowest, at most ``SAMPLE_REGIONS`` regions. Only that sample reaches the driver; without any, nothing is added."""
    marked = docs.filter(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), "text")
    bound = marked.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if bound is None:
        return train([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text[words[0][0]:words[-1][1]] for text in batch.column(0).to_pylist() for words in regions(text, REGION)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])

    sample = [r["text"] for r in marked.filter(F.col("h") <= bound).select("text").mapInArrow(run, "text string")
              .distinct().orderBy(F.xxhash64("text")).limit(SAMPLE_REGIONS).collect()]
    made = [list(examples(text, k)) for k, text in enumerate(sample)]
    field = train([x for k, some in enumerate(made) if k % HELD_OUT for x in some])
    field.sure = threshold(field, [x for some in made[::HELD_OUT] for x in some])
    return field


def added_spans(field: Field, text: str, base: list[Span]) -> list[Span]:
    """Segments of the best segmentation of each region that are likely enough and touch no base span."""
    found: list[Span] = []
    stands = sorted((s, e) for _, s, e in base)
    reach = list(itertools.accumulate((e for _, e in stands), max))
    for words in regions(text):
        added = []
        for i, j, kind, probability in field.likely(text, words):
            start, end = words[i][0], words[j - 1][1]
            before = bisect.bisect_left(stands, (end,))  # base spans that start before the end
            if probability >= field.sure and not (before and reach[before - 1] > start):
                added.append((KINDS[kind], start, end))
        found += added[::-1]
    return found


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added) of every row.

    Spans are kind:start:end in code points, by start, then kind. Null and empty texts have none; repeated rows
    and null ids are rows like others; further columns are ignored; no rows, no rows. Each text is taken whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounded_batches(docs.sparkSession)
    field = fit(rows)
    shared = docs.sparkSession.sparkContext.broadcast(field)  # weights of at most the sample's features
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                counts.append([sum(s[0] == k for s in base) for k in KINDS] if base else [0] * len(KINDS))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(base + added_spans(shared.value, text, base)))
            columns = [batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))),
                       pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string")
