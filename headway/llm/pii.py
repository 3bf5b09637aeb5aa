"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers.
The field looks at the zones around digits, at signs and spelled addresses (``name at
host dot com``, ``name [at] host``): a zone is cut into atoms
(runs of digits, runs of letters, single other characters), every run of up to
``MAX_ATOMS`` atoms is a candidate segment, and whole-segment features (digits and
their groups, separators, check sums, what stands before and after) are scored for
every type. Dynamic programming chooses boundaries and types together. Segments
that touch what the patterns found are not candidates, so pattern spans stay.

The field is trained here, on at most ``TRAINING_ZONES`` zones of at most ``ZONE_CHARS``
characters from at most ``TRAINING_DOCS`` documents; zones with spelled addresses
are left out, as nothing labels them. The patterns' own matches are the labels; each is also shown in the forms the patterns
do not know (no plus sign, words for the signs of an address), and numbers that the
patterns refuse are examples of none. Without any match nothing is added.

Null texts count as empty. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.staging import bounded_batches

KINDS = ("email", "ip", "card", "phone")
TRAINING_DOCS = 5_000
TRAINING_ZONES = TRAINING_DOCS // 10
ZONE_CHARS = 400
MAX_ATOMS = 24
NEAR, MARGIN = 12, 32
EPOCHS, STEP, DAMPING = 40, 0.5, 0.01
#: A segment is added only if its score beats leaving it out by this much.
CAUTION = 1.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile("[0-9@]+")
#: What joins name and host in a spelled address, and the host after it; a bare word needs spelled dots as well.
_AT = (" at ", "[at]", "(at)")
_LABEL = r"[A-Za-z0-9-]++"
_SPELLED_HOST = re.compile(rf"{_LABEL}(?: dot {_LABEL})+")
_BRACKET_HOST = re.compile(rf"\x20?{_LABEL}(?:(?:\.| dot |\x20?[\[(]dot[\])]\x20?){_LABEL})+")
_MORE_HOST = re.compile(r"(?:\.| dot |\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]")
_ATOM = re.compile("[0-9]+|[^\\W\\d_]+|.", re.S)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The patterns' matches, by start and then kind as listed. Each pattern passes over the text once."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        if domain := _DOMAIN.match(text, at):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = domain.end()
                found.append((start, end, "email"))
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = re.sub("[^0-9]", "", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def spelled(text: str) -> list[tuple[int, int]]:
    """Where a name, a word or bracket for the at sign and a host stand; the host's dots can be words too."""
    found = []
    for sign in _AT:
        at = text.find(sign)
        while at >= 0:
            host = (_SPELLED_HOST if sign == " at " else _BRACKET_HOST).match(text, at + 4)
            if host:
                end = start = at - (sign != " at " and text[at - 1 : at] == " ")
                while start > 0 and text[start - 1] in _LOCAL:
                    start -= 1
                if start < end:
                    found.append((start, host.end()))
            at = text.find(sign, host.end() if host else at + 1)
    return found


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around digits, at signs and spelled addresses; triggers close to each other share one."""
    first = last = -1
    triggers = [m.span() for m in _TRIGGER.finditer(text)]
    if words := spelled(text):
        triggers = sorted(triggers + words)
    for start, end in triggers:
        if first >= 0 and start - last > NEAR:
            yield max(0, first - MARGIN), min(len(text), last + MARGIN)
            first = start
        elif first < 0:
            first = start
        last = max(last, end)
    if first >= 0:
        yield max(0, first - MARGIN), min(len(text), last + MARGIN)


def atoms(zone: str) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(zone)]


def _plausible(segment: str) -> bool:
    """Cheap bounds on what any type could be."""
    if len(segment) < 7 or segment[0] in " \t\n.,;:-)" or segment[-1] in " \t\n.,;:-(+@":
        return False
    digits = sum(map(str.isdigit, segment))
    return digits >= 7 or "@" in segment or " at " in segment or "[at]" in segment or "(at)" in segment


def features(zone: str, start: int, end: int) -> list[str]:
    """What is seen of a whole segment and its two neighbours."""
    segment = zone[start:end]
    digits = re.sub("[^0-9]", "", segment)
    groups = re.findall("[0-9]+", segment)
    letters = re.sub(r"[\W\d_]", "", segment)
    others = "".join(sorted(set(re.sub(r"[\w]", "", segment))))
    before, after = zone[start - 1 : start], zone[end : end + 1]
    small = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    shape = "-".join(str(min(len(g), 9)) for g in groups[:6])
    return [
        "bias",
        f"digits{min(len(digits), 20)}",
        f"groups{min(len(groups), 7)}",
        f"signs{others[:6]}",
        f"letters{min(len(letters), 3) > 0}",
        f"shape{shape if not letters else 'w'}",
        f"octets{small and not letters and others == '.'}",
        f"luhn{12 <= len(digits) <= 19 and luhn(digits) and not letters}",
        f"at{bool(re.search(r'[@]| at |[\[(]at[\])]', segment))}",
        f"dot{bool(re.search(r'[\[(]dot[\])]| dot |[.]', segment)) and len(letters) > 2}",
        f"joined{bool(before and before.isalnum()) or bool(after and after.isalnum())}",
        f"more{before in tuple('+-./') or (after in tuple('-/') and after != '')}",
        f"spaces{min(segment.count(' '), 4)}",
        f"blank{'  ' in segment or chr(10) in segment}",
        f"spelled{spelled(segment) == [(0, len(segment))] and not (before and before in _LOCAL) and not _MORE_HOST.match(zone, end)}",
    ]


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping stretches put together, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def candidates(zone: str, cuts: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Candidate segments as atom ranges, none touching what is taken (apart from one another, in order)."""
    out = []
    ends = [b for _, b in taken]
    for i in range(len(cuts)):
        for j in range(i + 1, min(i + MAX_ATOMS, len(cuts)) + 1):
            start, end = cuts[i][0], cuts[j - 1][1]
            near = bisect_right(ends, start)
            if near < len(taken) and taken[near][0] < end:
                break  # so would every longer one
            if _plausible(zone[start:end]):
                out.append((i, j))
    return out


def best_segments(n: int, segments: list[tuple[int, int]], scores: np.ndarray) -> list[tuple[int, int, int]]:
    """The best non-overlapping choice of typed segments over ``n`` atoms (the rest scores 0)."""
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    ending = defaultdict(list)
    for k, (i, j) in enumerate(segments):
        ending[j].append((i, k))
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, k in ending[j]:
            for kind in range(len(KINDS)):
                value = best[i] + scores[k, kind] - CAUTION
                if value > best[j]:
                    best[j], back[j] = value, (i, kind)
    out, j = [], n
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            out.append((back[j][0], j, back[j][1]))
            j = back[j][0]
    return out[::-1]


def marginals(n: int, segments: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """Probability of every typed segment, by the forward and backward sums."""
    ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = behind[n] = 0.0
    whole = np.logaddexp.reduce(scores, axis=1)
    ending, starting = defaultdict(list), defaultdict(list)
    for k, (i, j) in enumerate(segments):
        ending[j].append((i, k))
        starting[i].append((j, k))
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + whole[k] for i, k in ending[j])])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + whole[k] for j, k in starting[i])])
    log_p = [ahead[i] + behind[j] - ahead[n] for i, j in segments]
    return np.exp(scores + np.array(log_p)[:, None])


def _variants(zone: str, gold: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The zone as it stands, and with each match in forms the patterns do not know."""
    yield zone, gold
    for start, end, kind in gold:
        own = zone[start:end]
        if kind == "phone":
            others = [own.lstrip("+"), re.sub(r"^\+[0-9]+[ .-]*", "", own)]
        elif kind == "email":
            name, host = own.split("@")
            spoken = host.replace(".", " dot ")
            others = [f"{name} at {spoken}", f"{name}[at]{host}", f"{name} (at) {host}", f"{name} [at] {host.replace('.', ' [dot] ')}"]
        else:
            others = []
        for other in others:
            yield zone[:start] + other + zone[end:], [(start, start + len(other), kind)]


class Field:
    """Weights of segment features for each type."""

    def __init__(self, index: dict[str, int], weights: np.ndarray):
        self.index, self.weights = index, weights

    def scores(self, zone: str, cuts: list[tuple[int, int]], segments: list[tuple[int, int]]) -> np.ndarray:
        out = np.zeros((len(segments), len(KINDS)))
        for k, (i, j) in enumerate(segments):
            known = [self.index[f] for f in features(zone, cuts[i][0], cuts[j - 1][1]) if f in self.index]
            out[k] = self.weights[known].sum(axis=0)
        return out

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        out: list[Span] = []
        matches = joined((a, b) for a, b, _ in base)
        ends, starts = [b for _, b in matches], [a for a, _ in matches]
        for low, high in zones(text):
            zone = text[low:high]
            own = matches[bisect_right(ends, low) : bisect_left(starts, high)]
            taken = [(a - low, b - low) for a, b in own]
            cuts = atoms(zone)
            segments = candidates(zone, cuts, taken)
            if segments:
                for i, j, kind in best_segments(len(cuts), segments, self.scores(zone, cuts, segments)):
                    out.append((low + cuts[i][0], low + cuts[j - 1][1], KINDS[kind]))
        return out


def train(examples: list[tuple[str, list[Span]]]) -> Field | None:
    """Maximises the likelihood of the labelled segmentations by damped gradient steps."""
    index: dict[str, int] = {}
    data = []
    for zone, gold in examples:
        for text, labels in _variants(zone, gold):
            cuts = atoms(text)
            segments = candidates(text, cuts, [])
            place = {(cuts[i][0], cuts[j - 1][1]): k for k, (i, j) in enumerate(segments)}
            target = np.zeros((len(segments), len(KINDS)))
            for start, end, kind in labels:
                if (start, end) in place:
                    target[place[start, end], KINDS.index(kind)] = 1
            if segments:
                rows = [
                    [index.setdefault(f, len(index)) for f in features(text, cuts[i][0], cuts[j - 1][1])]
                    for i, j in segments
                ]
                data.append((len(cuts), segments, np.array(rows), target))
    if not any(target.any() for *_, target in data):
        return None
    weights, squares = np.zeros((len(index), len(KINDS))), np.full((len(index), len(KINDS)), 1e-6)
    for _ in range(EPOCHS):
        gradient = -DAMPING * weights
        for n, segments, rows, target in data:
            wrong = target - marginals(n, segments, weights[rows].sum(axis=1))
            np.add.at(gradient, rows.ravel(), np.repeat(wrong, rows.shape[1], axis=0))
        squares += gradient**2
        weights += STEP * gradient / np.sqrt(squares)
    return Field(index, weights)


def fit(docs: DataFrame) -> Field | None:
    """A field trained on the zones of ``TRAINING_DOCS`` documents, chosen by a hash of their ids."""
    bounded_batches(docs.sparkSession)
    ids = docs.select(F.col("doc_id").alias("chosen")).where("chosen is not null").distinct()
    ids = ids.orderBy(F.xxhash64("chosen"), "chosen").limit(TRAINING_DOCS)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, begun, ended, kinds = [], [], [], []
            for text in batch.column(0).to_pylist():
                base = base_spans(text or "")
                for low, high in zones(text or ""):
                    inside = [(a - low, b - low, k) for a, b, k in base if low <= a and b <= high]
                    if high - low <= ZONE_CHARS and not spelled(text[low:high]) and not any(x[0] < y[1] and y[0] < x[1] for x in inside for y in inside if x != y):
                        kept.append(text[low:high])
                        begun.append([a for a, _, _ in inside])
                        ended.append([b for _, b, _ in inside])
                        kinds.append([k for _, _, k in inside])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kept, pa.string()),
                    pa.array(begun, pa.list_(pa.int64())),
                    pa.array(ended, pa.list_(pa.int64())),
                    pa.array(kinds, pa.list_(pa.string())),
                ],
                names=["zone", "begun", "ended", "kinds"],
            )

    chosen = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("chosen")).select("text")
    found = chosen.mapInArrow(examples, "zone string, begun array<long>, ended array<long>, kinds array<string>")
    found = found.distinct().orderBy(F.xxhash64("zone"), "zone").limit(TRAINING_ZONES)
    return train([(r.zone, list(zip(r.begun, r.ended, r.kinds))) for r in found.collect()])


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


SCHEMA = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: counts of the patterns' matches by kind, a digest of them, and all spans."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    field = fit(narrow)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, all_spans = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                counts.append([sum(k == kind for _, _, k in base) for kind in KINDS])
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                all_spans.append(_listed(base + (field.spans(text, base) if field else [])))
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns), pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return narrow.mapInArrow(find, SCHEMA)


def masked(text: str, spans: list[Span]) -> str:
    """Each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    merged: list[list] = []
    for a, b, k in sorted(spans, key=lambda s: (s[0], -s[1])):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    for a, b, k in merged:
        out += [text[at:a], f"[{k.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` counted anew; all rows stay."""
    field = fit(docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")))
    place = docs.columns.index("text")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                if text:
                    base = base_spans(text)
                    text = masked(text, base + (field.spans(text, base) if field else []))
                texts.append(text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(cover, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
