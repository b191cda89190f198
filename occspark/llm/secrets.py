"""Secret scans: all rules in one deterministic automaton, one pass over the bytes.

Rule regexes (bytes; literals, classes, groups, alternatives, repeats) become one
nondeterministic automaton, subset construction makes it deterministic, and partition refinement
minimises it. The result is an array of transitions over byte classes. Texts are laid end to end,
cut into lanes, and all lanes step through the array together; a lane that another rule's text
reaches into is stepped again until its states agree.

Between two places where the automaton is in its start state no match is under way. Stretches in
which a rule accepts are therefore the only ones whose exact spans are taken, leftmost and longest
first, never overlapping within one kind, by an anchored automaton of the same rules.

Base kinds: ``assign`` (kept if its value has 6 characters or more), ``access`` (20 or more), ``hex``
(24 or more). The further kinds only add spans.

Defined cases: a null text is empty; positions count code points, the end excluded; very long texts
are taken in pieces that end where the automaton is in its start state; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occspark.llm.langid import fresh
from occspark.llm.store import bound_batches
from occspark.llm.words import utf8

# The kinds in their order, each with its rule over ASCII bytes.
BASE = ("assign", "access", "hex")
RULES = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "forge": r"gh[opsu]_[A-Za-z0-9]+",
    "chat": r"xox[abprs]-[A-Za-z0-9-]+",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
#: Matches of fewer characters are dropped. Counted repeats would multiply the automaton's states with each other;
#: only ``hex`` needs one, as nearly every text has short runs.
LEAST = {"access": 20, "hex": 24, "forge": 40, "chat": 15}
_VALUE = re.compile(r"[:=] *[\"']?([A-Za-z0-9+/_.=-]+)$")

_REPEAT_NONE = re._constants.MAXREPEAT


class _Nfa:
    """Thompson's construction over byte sets."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, parsed, start: int, fold: bool) -> int:
        """Append a parsed regex behind ``start``; returns the state behind it."""
        for kind, value in parsed:
            name = str(kind)
            if name == "LITERAL":
                start = self.step(start, {value}, fold)
            elif name == "IN":
                start = self.step(start, _members(value), fold)
            elif name == "SUBPATTERN":
                start = self.add(value[3], start, fold or bool(value[1] & re.IGNORECASE))
            elif name == "BRANCH":
                ends = [self.add(branch, start, fold) for branch in value[1]]
                start = self.state()
                for end in ends:
                    self.empty[end].append(start)
            elif name == "MAX_REPEAT":
                least, most, body = value
                for _ in range(least):
                    start = self.add(body, start, fold)
                if most == _REPEAT_NONE:
                    loop = self.state()
                    self.empty[start].append(loop)
                    back = self.add(body, loop, fold)
                    self.empty[back].append(loop)
                    start = loop
                else:
                    exits = [start]
                    for _ in range(most - least):
                        start = self.add(body, start, fold)
                        exits.append(start)
                    start = self.state()
                    for end in exits:
                        self.empty[end].append(start)
            else:
                raise ValueError(f"Rules can't use {name}.")
        return start

    def step(self, start: int, members: set, fold: bool) -> int:
        if fold:
            members = members | {ord(chr(b).swapcase()) for b in members if b < 128 and chr(b).isalpha()}
        here, end = self.state(), self.state()
        self.empty[start].append(here)
        self.moves[here] = (frozenset(members), end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.empty[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


def _members(items) -> set:
    found: set[int] = set()
    for kind, value in items:
        if str(kind) == "RANGE":
            found |= set(range(value[0], value[1] + 1))
        elif str(kind) == "LITERAL":
            found.add(value)
        else:
            raise ValueError(f"Classes can't use {kind}.")
    return found


@dataclass
class Automaton:
    """``table[state * classes + class_of[byte]]`` is the next state times ``classes``; start is 0.

    The last class stands for a text's end and leads to the start. ``accepts[state]`` has a bit per rule.
    """

    table: np.ndarray
    class_of: np.ndarray
    classes: int
    accepts: np.ndarray
    dead: int
    rows: list = field(default_factory=list)


def compile_rules(rules: list[str], anchored: bool) -> Automaton:
    """Subset construction over all rules, then minimisation. Unless ``anchored``, a match may start anywhere."""
    nfa = _Nfa()
    root = nfa.state()
    ends = []
    for rule in rules:
        start = nfa.state()
        nfa.empty[root].append(start)
        ends.append(nfa.add(re._parser.parse(rule), start, False))
    sets = [m[0] for m in nfa.moves if m]
    signature = {b: tuple(b in s for s in sets) for b in range(256)}
    kinds = {s: k for k, s in enumerate(dict.fromkeys(signature.values()))}
    class_of = np.array([kinds[signature[b]] for b in range(256)], dtype=np.int32)
    samples = [int(np.argmax(class_of == k)) for k in range(len(kinds))]
    first = nfa.closure([root])
    states, order, next_states = {first: 0}, [first], []
    for subset in order:
        row = []
        for byte in samples:
            reached = {nfa.moves[s][1] for s in subset if nfa.moves[s] and byte in nfa.moves[s][0]}
            if not anchored:
                reached.add(root)
            target = nfa.closure(reached)
            if target not in states:
                states[target] = len(order)
                order.append(target)
            row.append(states[target])
        next_states.append(row)
    moves = np.array(next_states)
    accepts = np.array([sum(1 << r for r, end in enumerate(ends) if end in s) for s in order])
    # The start stays a block of its own: being in it means that no match is under way.
    block = np.unique(np.stack([accepts, np.arange(len(order)) == 0], axis=1), axis=0, return_inverse=True)[1].ravel()
    while True:
        refined = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    names = {}
    for b in block.tolist():  # number blocks by their first state, so that the start is 0
        names.setdefault(b, len(names))
    block = np.array([names[b] for b in block.tolist()])
    heads = [int(np.argmax(block == b)) for b in range(len(names))]
    classes = len(samples) + 1
    table = np.zeros((len(heads), classes), dtype=np.int32)
    table[:, :-1] = block[moves[heads]] * classes
    dead = [b for b, h in enumerate(heads) if not order[h]]
    return Automaton(
        table.ravel(), class_of, classes, accepts[heads], dead[0] * classes if dead else -1, table.tolist()
    )


KINDS = tuple(RULES)
SEARCH = compile_rules(list(RULES.values()), anchored=False)
ANCHORED = compile_rules(list(RULES.values()), anchored=True)

_LANES = 1024
_PIECE = 1 << 22


def states_of(classes: np.ndarray) -> np.ndarray:
    """The search automaton's state (times its classes) behind each symbol, from the start state."""
    automaton, count = SEARCH, len(classes)
    lanes = max(1, min(_LANES, count // 64))
    steps = -(-count // lanes)
    grid = np.full(lanes * steps, automaton.classes - 1, dtype=np.int32)
    grid[:count] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    out = np.empty_like(grid)
    state = np.zeros(lanes, dtype=np.int32)
    table = automaton.table
    for step in range(steps):
        state = table[state + grid[step]]
        out[step] = state
    flat = np.ascontiguousarray(out.T).ravel()[:count]
    rows, width = automaton.rows, automaton.classes
    for lane in range(1, lanes):
        at = lane * steps
        if at >= count:
            break
        now = int(flat[at - 1])
        if now == 0:
            continue
        while at < count:
            now = rows[now // width][classes[at]]
            if flat[at] == now:
                break
            flat[at] = now
            at += 1
    return flat


def longest(data: bytes, start: int, end: int, rule: int) -> int:
    """Past-the-end of the rule's longest match at ``start``, or -1."""
    rows, width, class_of, accepts = ANCHORED.rows, ANCHORED.classes, ANCHORED.class_of, ANCHORED.accepts
    state, found = 0, -1
    for at in range(start, end):
        state = rows[state // width][class_of[data[at]]]
        if state == ANCHORED.dead:
            break
        if accepts[state // width] >> rule & 1:
            found = at + 1
    return found


def _stretches(texts_classes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(rule, begin, end) of stretches between start states in which a rule accepts."""
    states = states_of(texts_classes)
    accepted = SEARCH.accepts[states // SEARCH.classes]
    at = np.flatnonzero(accepted)
    if not len(at):
        return
    resting = np.concatenate(([-1], np.flatnonzero(states == 0), [len(states)]))
    place = np.searchsorted(resting, at)
    begins, ends = resting[place - 1] + 1, resting[place]
    for rule in range(len(KINDS)):
        mine = (accepted[at] >> rule & 1).astype(bool)
        for begin, end in dict.fromkeys(zip(begins[mine].tolist(), ends[mine].tolist(), strict=True)):
            yield rule, begin, end


def _matches(data: bytes, begin: int, end: int, rule: int) -> Iterator[tuple[int, int]]:
    """Leftmost, longest, non-overlapping matches of a rule in a stretch."""
    at = begin
    while at < end:
        stop = longest(data, at, end, rule)
        if stop < 0:
            at += 1
            continue
        yield at, stop
        at = stop


def spans_of(offsets: np.ndarray, data: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Per text, (start, kind number, end) in code points, by start and then kind."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    row = 0
    while row < len(found):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, side="right")) - 1)
        part = data[offsets[row] : offsets[last]]
        if len(part) <= _PIECE:
            # Every text is followed by its end symbol, so byte k of text r is symbol k + r.
            bounds = offsets[row : last + 1] - offsets[row]
            symbols = np.insert(SEARCH.class_of[part], bounds[1:], SEARCH.classes - 1)
            raw = np.insert(part, bounds[1:], 0).tobytes()
            heads = bounds + np.arange(len(bounds))
            for rule, begin, end in _stretches(symbols):
                text = int(np.searchsorted(heads, begin, side="right")) - 1
                for a, b in _matches(raw, begin, end, rule):
                    found[row + text].append((a - int(heads[text]), rule, b - int(heads[text])))
        else:
            found[row] = list(_long(part))
        row = last
    for number, own in enumerate(found):
        if own:
            text = data[offsets[number] : offsets[number + 1]]
            found[number] = _kept(text, own)
    return found


def _long(data: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Spans of one very long text in bytes, in pieces that end where no match is under way."""
    at, size = 0, _PIECE
    while at < len(data):
        piece = data[at : at + size]
        final = at + len(piece) == len(data)
        symbols = SEARCH.class_of[piece]
        cut = len(piece)
        if not final:
            resting = np.flatnonzero(states_of(symbols) == 0)
            if not len(resting):
                size *= 2
                continue
            cut = int(resting[-1]) + 1
        raw = piece[:cut].tobytes()
        for rule, begin, end in _stretches(symbols[:cut]):
            for a, b in _matches(raw, begin, end, rule):
                yield at + a, rule, at + b
        at, size = at + cut, _PIECE


def _kept(text: np.ndarray, own: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Drop assignments of short values; count code points instead of bytes."""
    inner = np.concatenate(([0], np.cumsum((text & 0xC0) == 0x80)))
    kept = []
    for start, rule, end in sorted(own):
        if end - start < LEAST.get(KINDS[rule], 0):
            continue
        if rule == 0 and len(_VALUE.search(text[start:end].tobytes().decode("ascii"))[1]) < 6:
            continue
        kept.append((start - int(inner[start]), rule, end - int(inner[end])))
    return kept


def listed(spans: list[tuple[int, int, int]], kinds: int = len(KINDS)) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans if k < kinds)


def scan(docs: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans, for every row of (doc_id, text)."""
    bound_batches(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of(*utf8(batch.column("text")))
            counts = [pa.array([sum(k == kind for _, k, _ in own) for own in found], pa.int64()) for kind in range(3)]
            digests = [hashlib.sha256(listed(own, len(BASE)).encode()).hexdigest() for own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([listed(o) for o in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        search, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: Column) -> Column:
    """The text with every secret replaced by its kind in brackets; texts without any are unchanged."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        column = pa.array(texts, pa.string())
        result = texts.copy()
        for row, own in enumerate(spans_of(*utf8(column))):
            if own:
                result.iloc[row] = _replaced(texts.iloc[row], own)
        return result

    return redact(text)


def _replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans count as one, named after the first."""
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """All documents with their secrets redacted and ``n_chars`` counted anew where a text changed."""
    bound_batches(docs.sparkSession)
    name = fresh(docs, "_redacted")
    found = docs.withColumn(name, redacted(F.col("text").cast("string")))
    changed = ~F.col("text").eqNullSafe(F.col(name))
    columns = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length(name).cast(kind)).otherwise(F.col("n_chars"))
    return found.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])
