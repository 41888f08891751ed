"""Operator 9: personal data by fixed patterns and a semi-Markov conditional random field.

The base spans are fixed patterns with checks. The model adds spans that the
patterns miss (other separators, missing prefixes): it cuts each zone of text
around digits and ``@`` into segments, scores candidate segments by features of
the whole span (digit count, check sums, groups, separators, borders), and a
dynamic program over segments of bounded length picks boundaries and types
together. It is trained by the conditional likelihood of segmentations on a
bounded sample of zones that the base spans label, with varied copies of them.
Texts are read whole, row by row; nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._io import bounded_sample, free_name, let_go, prepare

# The kinds in order and the base patterns. Look-behinds and
# possessive repeats keep the matches of the plain patterns but no re-tries.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Documents that the model is trained on at most (those with the smallest hashes of their ids), and zones of them.
SAMPLE_DOCS, SAMPLE_ZONES = 4000, 1500
#: Atoms (runs of digits, runs of letters, single other characters) of a segment at most.
SEGMENT_ATOMS = 24
#: Passes over the sample, learning rate, L2.
PASSES, RATE, DECAY = 4, 0.3, 1e-4

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass their checks, by start, then kind."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_TRIGGER = re.compile(r"[0-9]+|@|[(\[]at[)\]]")
_SPACE = re.compile(r"\s")
_ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.S)


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches of words that hold a digit, ``@`` or a bracketed ``at``; those that one white space separates are one."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        low = out[-1][1] if out else 0
        if m.start() < low:
            continue
        start = m.start()
        while start > low and not text[start - 1].isspace():
            start -= 1
        found = _SPACE.search(text, m.end())
        end = found.start() if found else len(text)
        if out and start - out[-1][1] <= 1 and text[out[-1][1]:start].isspace():
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _atoms(zone: str) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(zone)]


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


_DIGIT_EDGES = (7, 9, 11, 12, 16, 17, 20)
FEATURES = 42


def features(zone: str, start: int, end: int) -> list[int]:
    """The whole-span features of a segment that hold."""
    s = zone[start:end]
    d = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    before, after = zone[start - 1:start], zone[end:end + 1]
    dots, on = s.count("."), [0, 1 + _bucket(len(d), _DIGIT_EDGES)]  # 1 to 8
    on.append(9 + min(dots, 4))  # 9 to 13
    tests = (12 <= len(d) <= 19 and luhn(d), s[0] == "+", "(" in s, len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups),
             "@" in s, bool(re.search(r"[(\[]at[)\]]", s)), bool(re.search(r"[A-Za-z]\.[A-Za-z]{2,}$", s)), any(c.isalpha() for c in s),
             not d, any(c.isspace() for c in s), "-" in s, bool(before) and not before.isspace(), bool(after) and not after.isspace(),
             before.isalnum(), after.isalnum(), s[-1:].isdigit(), s[0].isdigit(), [len(g) for g in groups][-3:] == [3, 3, 4],
             len(groups) == 4 and {len(g) for g in groups} == {4}, len(groups) == 1, any(c in "=/:,_\"'" for c in s),
             s.count("(") != s.count(")"), before == "+", s.count("@") > 1, not re.fullmatch(r"[+(]?[0-9][0-9 ().-]*", s), len(groups) > 5)
    return on + [14 + i for i, t in enumerate(tests) if t]


def _candidates(zone: str, atoms: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first atom, atom after the last, kind number) of segments that could be an entity at all."""
    out = []
    for i, (start, first_end) in enumerate(atoms):
        if not (zone[start].isalnum() or zone[start] in "+("):
            continue
        n_digits = dots = marks = groups = 0
        for j in range(i, min(len(atoms), i + SEGMENT_ATOMS)):
            a, b = atoms[j]
            c = zone[a]
            if "0" <= c <= "9":
                n_digits, groups = n_digits + b - a, groups + 1
            elif c == ".":
                dots += 1
            elif c == "@" or zone[a - 1:b + 1] in ("(at)", "[at]"):
                marks += 1
            if n_digits > 19 and not marks:
                break
            if not (c.isalnum()):
                continue
            if marks and dots:
                out.append((i, j + 1, 0))
            if groups == 4 and dots == 3 and "0" <= zone[start] <= "9":
                out.append((i, j + 1, 1))
            if 12 <= n_digits <= 19 and not marks:
                out.append((i, j + 1, 2))
            if 7 <= n_digits <= 15 and not marks:
                out.append((i, j + 1, 3))
    return out


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # kinds x features

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Base spans and those that the best segmentations add beside them, by start, then kind."""
        added = []
        for a, b in zones(text):
            zone = text[a:b]
            atoms = _atoms(zone)
            held = _candidates(zone, atoms)
            if not held:
                continue
            scores = [float(self.weight[k, features(zone, atoms[i][0], atoms[j - 1][1])].sum()) for i, j, k in held]
            for kind, i, j in _best(len(atoms), held, scores):
                start, end = a + atoms[i][0], a + atoms[j - 1][1]
                if all(end <= s or start >= e for _, s, e in base):
                    added.append((KINDS[kind], start, end))
        return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def _best(n: int, held: list[tuple[int, int, int]], scores: list[float]) -> list[tuple[int, int, int]]:
    """(kind, first atom, atom after the last) of the entities of the best segmentation; single atoms outside score 0."""
    ends: dict[int, list[int]] = {}
    for c, (_, j, _) in enumerate(held):
        ends.setdefault(j, []).append(c)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for c in ends.get(j, ()):
            if (s := best[held[c][0]] + scores[c]) > best[j]:
                best[j], back[j] = s, c
    out, j = [], n
    while j > 0:
        if back[j] >= 0:
            i, _, kind = held[back[j]]
            out.append((kind, i, j))
            j = i
        else:
            j -= 1
    return out[::-1]


def _gradient(n: int, held, scores: np.ndarray) -> np.ndarray:
    """Each candidate's probability under the current weights, by the forward and backward sums over segmentations."""
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for c, (i, j, _) in enumerate(held):
        starts.setdefault(i, []).append(c), ends.setdefault(j, []).append(c)
    forward, backward = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        forward[j] = np.logaddexp.reduce([forward[j - 1], *(forward[held[c][0]] + scores[c] for c in ends.get(j, ()))])
    for i in range(n - 1, -1, -1):
        backward[i] = np.logaddexp.reduce([backward[i + 1], *(backward[held[c][1]] + scores[c] for c in starts.get(i, ()))])
    return np.exp([forward[i] + s + backward[j] - forward[n] for (i, j, _), s in zip(held, scores, strict=True)])


def _varied(zone: str, spans: list[Span]) -> list[tuple[str, list[Span]]]:
    """Copies of a zone of one entity in spellings that the base patterns miss, with the entity's new place; of a card also one with a wrong check digit, which is none."""
    if len(spans) != 1:
        return []
    kind, a, b = spans[0]
    s, out = zone[a:b], []
    if kind == "email":
        out = [s.replace("@", "(at)"), s.replace("@", "[at]")]
    elif kind == "card" and len(d := _digits(s)) == 16:
        wrong = d[:-1] + str((int(d[-1]) + 1) % 10)
        dotted, off = (".".join(x[i:i + 4] for i in range(0, 16, 4)) for x in (d, wrong))
        return [(zone[:a] + dotted + zone[b:], [(kind, a, a + len(dotted))]), (zone[:a] + off + zone[b:], [])]
    elif kind == "phone" and len(d := _digits(s)) >= 10:
        d = d[-10:]
        out = [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
    return [(zone[:a] + v + zone[b:], [(kind, a, a + len(v))]) for v in out]


#: Zones without personal data that every sample gets, so that plain numbers stay.
PLAIN = ("2024-01-15", "12:30:45", "3.14159265", "1,234,567.89", "v1.2.3", "1998-06-01 12:00", "10 000 000", "0xdeadbeef1234567", "page 1234567",
         "id=99887766554433", "1234567890", "20240115123000", "123456789012345678901234567890", "1 2 3 4 5 6 7 8 9 10", "1990 1991 1992", "10.5.2")


def fit(held_zones: list[tuple[str, list[Span]]]) -> Model:
    """Weights that make the given segmentations likely (gradient ascent, one zone at a time, in the order given)."""
    weight, examples = np.zeros((len(KINDS), FEATURES)), []
    every = [z for zone, spans in held_zones for z in [(zone, spans), *_varied(zone, spans)]] + [(p, []) for p in PLAIN] * 5
    for zone, spans in every:
        atoms = _atoms(zone)
        held = _candidates(zone, atoms)
        if not held:
            continue
        begin, end = {a: i for i, (a, _) in enumerate(atoms)}, {b: i + 1 for i, (_, b) in enumerate(atoms)}
        told = {(begin.get(a), end.get(b), KINDS.index(k)) for k, a, b in spans}
        rows = np.zeros((len(held), FEATURES))
        for c, (i, j, _) in enumerate(held):
            rows[c, features(zone, atoms[i][0], atoms[j - 1][1])] = 1
        examples.append((len(atoms), held, rows, np.array([c in told for c in held], float), np.array([k for _, _, k in held])))
    for turn in range(PASSES):
        for n, held, rows, told, kinds in examples:
            scores = (rows * weight[kinds]).sum(1)
            off = told - _gradient(n, held, scores)
            step = RATE / (1 + turn)
            np.add.at(weight, kinds, step * off[:, None] * rows)
            weight *= 1 - step * DECAY
    return Model(weight)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model trained on zones of a bounded sample of the documents that hold digits or ``@``."""
    prepare(docs.sparkSession)

    def cut(batches):
        let_go()
        for batch in batches:
            rows = []
            for mark, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                base = base_spans(text)
                for a, b in zones(text):
                    own, last = [], a
                    for k, s, e in base:
                        if s >= last and e <= b:  # of overlapping spans the first
                            own.append((k, s - a, e - a))
                            last = e
                    if b - a <= 400:
                        rows.append((mark, text[a:b], ",".join(f"{k}:{s}:{e}" for k, s, e in own)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.string())], names=["mark", "zone", "spans"])

    some = bounded_sample(docs.filter(F.col(text_col).rlike("[0-9@]")).select(id_col, text_col), F.col(id_col), SAMPLE_DOCS)
    rows = some.select(F.xxhash64(id_col).alias("mark"), text_col).mapInArrow(cut, "mark bigint, zone string, spans string") \
        .orderBy("mark", "zone", "spans").limit(SAMPLE_ZONES).collect()
    return fit([(r.zone, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]) for r in rows])


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, model: Model, text_col: str = "text", base_out: str = "base", spans_out: str = "spans", redacted_out: str | None = None) -> DataFrame:
    """``docs`` with the base spans and all spans (kind, start, end in code points, end exclusive); underscores added to names that are taken.

    Null and empty texts have none. With ``redacted_out``, also the text in
    which each span (the union of overlapping ones) is the first one's kind in
    angle brackets; a null text stays null. Repeated rows stay as they are.
    """
    prepare(docs.sparkSession)
    names = [free_name(docs, n) for n in (base_out, spans_out, *([redacted_out] if redacted_out else []))]

    def run(batches):
        let_go()
        for batch in batches:
            base, spans, clean = [], [], []
            for t in batch.column(batch.schema.names.index(text_col)):
                text = t.as_py()
                own = base_spans(text or "")
                every = model.spans(text or "", own)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in every])
                clean.append(text and redact(text, every))
            new = [pa.array(base, _SPAN_TYPE), pa.array(spans, _SPAN_TYPE), *([pa.array(clean, pa.string())] if redacted_out else [])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    more = f", `{names[2]}` string" if redacted_out else ""
    return docs.mapInArrow(run, f"{fields}, `{names[0]}` {_SPANS}, `{names[1]}` {_SPANS}{more}")


def redact(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: str, kind: str) -> Column:
    """How many spans of the column are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
