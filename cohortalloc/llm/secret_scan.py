"""Secret scan: all rules in one deterministic automaton, one pass over the bytes.

Method.  The rules' regular expressions become one NFA; subset construction
gives a DFA for "some rule ends here, wherever it began"; partition
refinement minimises it; its transitions are one flat array over byte
classes.  A scan reads each byte of a text once, with one array look-up.
Only where the automaton accepts, the reversed automaton of that rule finds
the leftmost start (not before the end of the rule's last match) and the
forward one the longest end.

A rule's matches are leftmost and do not overlap each other; a match whose
``least`` characters (of all, or of its tail: from the first character at
which it is complete) are not reached is dropped but still consumes its
text, as with a regular expression and a later length test.  Rules must be
such that no match can begin inside the head of another one of the same
rule; the ones below are.

Rules are ASCII; a text's UTF-8 bytes are scanned, spans are in code points.

Edge cases.  A NULL text counts as empty (no span).  Repeated rows and NULL
keys stay as they are; extra columns are ignored by ``scan`` and kept by
``redact``.  Scale: one narrow pass, no shuffle, whole texts of any length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import ship_package, table


@dataclass(frozen=True)
class Rule:
    """``least``: characters a match needs, counted in its tail if ``tail``."""

    name: str
    pattern: str
    least: int = 0
    tail: bool = False
    any_case: bool = False


# fixed values: the base rules, then those this operator adds
BASE = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        least=12, tail=True, any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]+", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", least=40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


# --- regular expression -> syntax tree --------------------------------------
# A tree is ("set", frozenset of bytes) | ("seq", [trees]) | ("any", [trees]) | ("rep", tree, low, high or None).


class _Reader:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("any", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.item()))
        return ("seq", parts)

    def repeated(self, tree):
        while (sign := self.peek()) and sign in "?*+{":
            self.take()
            if sign == "{":
                low, comma, high = self.text[self.at : self.text.index("}", self.at)].partition(",")
                self.at = self.text.index("}", self.at) + 1
                tree = ("rep", tree, int(low), int(high) if high else None if comma else int(low))
            else:
                tree = ("rep", tree, int(sign == "+"), 1 if sign == "?" else None)
        return tree

    def sign(self) -> int:
        c = self.take()
        if c == "\\":
            c = self.take()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
            if c.isalnum():
                raise ValueError(f"unknown escape \\{c}")
        return ord(c)

    def item(self):
        c = self.peek()
        if c == "(":
            self.take()
            tree = self.alternatives()
            self.take()
            return tree
        if c == "[":
            self.take()
            negated = self.peek() == "^"
            self.at += negated
            members: set[int] = set()
            while self.peek() != "]":
                low = high = self.sign()
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    high = self.sign()
                members.update(range(low, high + 1))
            self.take()
            return ("set", frozenset(range(256)) - members if negated else frozenset(members))
        if c == ".":
            self.take()
            return ("set", frozenset(range(256)) - {10})
        return ("set", frozenset({self.sign()}))


def parse(rule: Rule):
    """Syntax tree of a rule's pattern."""
    reader = _Reader(rule.pattern)
    tree = reader.alternatives()
    if reader.at != len(rule.pattern):
        raise ValueError(f"cannot read {rule.pattern!r} beyond {reader.at}")

    def both_cases(t):
        if t[0] == "set":
            return ("set", frozenset(o for b in t[1] for o in (b, *([b ^ 32] if chr(b).isalpha() and b < 128 else []))))
        if t[0] == "rep":
            return ("rep", both_cases(t[1]), *t[2:])
        return (t[0], [both_cases(x) for x in t[1]])

    return both_cases(tree) if rule.any_case else tree


def reverse(tree):
    if tree[0] == "set":
        return tree
    if tree[0] == "rep":
        return ("rep", reverse(tree[1]), *tree[2:])
    return (tree[0], [reverse(x) for x in (tree[1][::-1] if tree[0] == "seq" else tree[1])])


# --- tree -> NFA -> DFA -----------------------------------------------------


class Nfa:
    """States with empty moves and moves on byte sets; ``accepts``: rule of a final state."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[tuple[frozenset, int] | None] = []
        self.accepts: dict[int, int] = {}
        self.starts: list[int] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append(None)
        return len(self.empty) - 1

    def add(self, tree, rule: int) -> None:
        start = self.state()
        self.accepts[self.build(tree, start)] = rule
        self.starts.append(start)

    def build(self, tree, at: int) -> int:
        """Extend from state ``at`` by ``tree``; the state after it."""
        kind = tree[0]
        if kind == "set":
            to = self.state()
            here = self.state()
            self.empty[at].append(here)
            self.moves[here] = (tree[1], to)
            return to
        if kind == "seq":
            for part in tree[1]:
                at = self.build(part, at)
            return at
        if kind == "any":
            ends = [self.build(part, at) for part in tree[1]]
            to = self.state()
            for e in ends:
                self.empty[e].append(to)
            return to
        _, part, low, high = tree
        for _ in range(low):
            at = self.build(part, at)
        if high is None:
            loop, to = self.state(), self.state()
            self.empty[at].append(loop)
            self.empty[self.build(part, loop)].append(loop)
            self.empty[loop].append(to)
            return to
        to = self.state()
        self.empty[at].append(to)
        for _ in range(high - low):
            at = self.build(part, at)
            self.empty[at].append(to)
        return to

    def closure(self, states) -> frozenset:
        seen, left = set(states), list(states)
        while left:
            for s in self.empty[left.pop()]:
                if s not in seen:
                    seen.add(s)
                    left.append(s)
        return frozenset(s for s in seen if self.moves[s] is not None or s in self.accepts)


@dataclass
class Dfa:
    """``table[state * width + class]``: next state times width; states from ``accepting`` on accept.

    ``classes``: 256 bytes, the class of each byte; ``rules[state]``: rules
    that accept there; state 0 starts; ``dead``: the state that never accepts
    (-1: none).
    """

    classes: bytes
    width: int
    table: list[int]
    accepting: int
    rules: list[tuple[int, ...]]
    dead: int


def determinise(nfa: Nfa, search: bool) -> Dfa:
    """Subset construction and minimisation; ``search``: a match may begin at any byte."""
    sets = list({m[0] for m in nfa.moves if m})
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
    width = len(kinds)
    sample = [classes.index(c) for c in range(width)]
    start = nfa.closure(nfa.starts)
    number, order, rows = {start: 0}, [start], []
    for now in order:
        row = []
        movers = [nfa.moves[s] for s in now if nfa.moves[s]]
        for b in sample:
            to = nfa.closure({t for m, t in movers if b in m})
            if search:
                to |= start
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
    moves = np.array(rows)
    accept = [tuple(sorted({nfa.accepts[s] for s in now if s in nfa.accepts})) for now in order]
    label = np.unique([repr(a) for a in accept], return_inverse=True)[1]
    while True:  # states stay together while their moves lead to states that stay together
        keys = np.column_stack([label, label[moves]])
        finer = np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == label.max():
            break
        label = finer
    first = {}
    for s, x in enumerate(label.tolist()):
        first.setdefault(x, s)
    kept = sorted(first.values(), key=lambda s: (bool(accept[s]), s))  # the start is state 0 unless it accepts
    if accept[0]:
        raise ValueError("a rule matches the empty text")
    place = {label[s]: i for i, s in enumerate(kept)}
    flat = [place[label[t]] * width for s in kept for t in moves[s].tolist()]
    rules = [accept[s] for s in kept]
    accepting = sum(not r for r in rules)
    dead = next((i for i in range(accepting) if all(x == i * width for x in flat[i * width : (i + 1) * width])), -1)
    return Dfa(classes, width, flat, accepting, rules, dead)


class Scanner:
    """The combined automaton of ``rules`` and each rule's own ones."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        trees = [parse(r) for r in rules]
        union = Nfa()
        for i, t in enumerate(trees):
            union.add(t, i)
        self.all = determinise(union, search=True)
        self.forward, self.backward = [], []
        for t in trees:
            for made, tree in ((self.forward, t), (self.backward, reverse(t))):
                one = Nfa()
                one.add(tree, 0)
                made.append(determinise(one, search=False))

    @staticmethod
    def _run(dfa: Dfa, data) -> tuple[int, int]:
        """Length of the shortest and the longest accepted beginning of ``data`` (0: none)."""
        s, limit, dead, shortest, longest = 0, dfa.accepting * dfa.width, dfa.dead * dfa.width, 0, 0
        classes, table = dfa.classes, dfa.table
        for n, b in enumerate(data, 1):
            s = table[s + classes[b]]
            if s >= limit:
                shortest, longest = shortest or n, n
            elif s == dead:
                break
        return shortest, longest

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, in that order."""
        dfa = self.all
        table, limit, width = dfa.table, dfa.accepting * dfa.width, dfa.width
        free = [0] * len(self.rules)  # end of each rule's last match
        out, s, at = [], 0, -1
        for c in data.translate(dfa.classes):
            at += 1
            s = table[s + c]
            if s >= limit:
                for r in dfa.rules[s // width]:
                    if at >= free[r]:
                        self._match(data, r, at, free, out)
        return sorted(out)

    def _match(self, data: bytes, r: int, at: int, free: list[int], out: list) -> None:
        """The leftmost longest match of rule ``r`` among those that are complete at byte ``at``."""
        behind = (data[i] for i in range(at, free[r] - 1, -1))
        back = self._run(self.backward[r], behind)[1]
        if not back:
            return
        start = at + 1 - back
        shortest, longest = self._run(self.forward[r], (data[i] for i in range(start, len(data))))
        free[r] = end = start + longest
        rule = self.rules[r]
        if (longest - shortest + 1 if rule.tail else longest) >= rule.least:
            out.append((start, r, end))

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points."""
        data = text.encode()
        found = self.spans(data)
        if found and len(data) != len(text):
            before = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            found = [(int(before[a]), r, int(before[b])) for a, r, b in found]
        return found


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """The automata of ``rules``, compiled once per process."""
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


def scan(docs: DataFrame, key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, spans): array of (rule, start, end) by start, then by the rules' order."""
    shared = ship_package(docs.sparkSession).sparkContext.broadcast(scanner(rules))  # bounded by the rules

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [
                [{"rule": rules[r].name, "start": a, "end": b} for a, r, b in own.scan(t or "")]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, kind)], names=[key, "spans"])

    kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    own_kind = docs.schema[key].dataType.simpleString()
    spans = "spans array<struct<rule:string,start:bigint,end:bigint>>"
    return docs.select(key, "text").mapInArrow(run, f"`{key}` {own_kind}, {spans}")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; ``n_chars`` follows.

    Every row stays; a NULL text stays NULL.
    """
    shared = ship_package(docs.sparkSession).sparkContext.broadcast(scanner(rules))

    def clean(text: str) -> str:
        out, at = [], 0
        for a, _, b in shared.value.scan(text):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches):
        for batch in batches:
            texts = [None if t is None else clean(t) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def digest_columns(spans: Column) -> dict[str, Column]:
    """Counts of the base kinds, digest of the base spans, and all spans as text."""
    def shown(xs):
        return F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s.rule, s.start, s.end)), ",")

    def of(name):
        return F.size(F.filter(spans, lambda s: s.rule == name)).cast("long")

    return {
        **{f"n_{name}": of(name) for name in BASE},
        "base_sha256": F.sha2(shown(F.filter(spans, lambda s: s.rule.isin(*BASE))), 256),
        "spans": shown(spans),
    }


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scanned by all rules; see the module."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[c.alias(n) for n, c in digest_columns(F.col("spans")).items()])
