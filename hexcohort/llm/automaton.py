"""Byte regexes compiled together into one deterministic automaton.

Syntax: literals, ``\\`` escapes, ``\\xHH``, classes with ranges, groups, ``|`` and the postfix ``? * + {m} {m,} {m,n}``.
Everything works on bytes, so a class cannot hold characters beyond ASCII; ``ignore_case`` folds A-Z only.

``Scanner`` joins all rules by subset construction over the reversed rules, minimises the result and keeps it as flat
transition arrays.  One pass over the bytes, last to first, finds for every rule each place where a match starts; the end
of a match then comes from the rule's own forward automaton, which reads no more than the match.  That gives the leftmost,
longest, non-overlapping matches of each rule, whatever the rules are.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

ANY = frozenset(range(256))


# --- syntax tree: ("set", bytes) | ("cat", parts) | ("or", parts) | ("rep", part, low, high or None) ---------------------

class _Reader:
    def __init__(self, pattern: str, ignore_case: bool):
        self.s, self.i, self.fold = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def choice(self):
        parts = [self.chain()]
        while self.peek() == "|":
            self.take()
            parts.append(self.chain())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def chain(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeat(self.atom()))
        return ("cat", parts)

    def repeat(self, node):
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.s.index("}", self.i)
                low, comma, high = self.s[self.i:end].partition(",")
                self.i = end + 1
                bounds = (int(low), int(high) if high else None if comma else int(low))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, *bounds)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.choice()
            self.take()
            return node
        if c == "[":
            return ("set", self.klass())
        return ("set", self.folded({ord(self.escape() if c == "\\" else c)}))

    def escape(self) -> str:
        c = self.take()
        if c == "x":
            self.i += 2
            return chr(int(self.s[self.i - 2:self.i], 16))
        return {"n": "\n", "t": "\t", "r": "\r"}.get(c, c)

    def klass(self) -> frozenset[int]:
        found: set[int] = set()
        negate = self.peek() == "^" and bool(self.take())
        while self.peek() != "]":
            low = self.item()
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.take()
                found.update(range(ord(low), ord(self.item()) + 1))
            else:
                found.add(ord(low))
        self.take()
        found = set(self.folded(found))
        return ANY - found if negate else frozenset(found)

    def item(self) -> str:
        c = self.take()
        return self.escape() if c == "\\" else c

    def folded(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            text = "".join(map(chr, (b for b in found if b < 128)))
            found = found | {ord(c) for c in text.lower() + text.upper()}
        return frozenset(found)


def parse(pattern: str, ignore_case: bool = False):
    reader = _Reader(pattern, ignore_case)
    tree = reader.choice()
    if reader.i != len(pattern):
        raise ValueError(f"unbalanced ) in {pattern!r}")
    return tree


def mirrored(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [mirrored(p) for p in reversed(node[1])])
    if kind == "or":
        return ("or", [mirrored(p) for p in node[1]])
    if kind == "rep":
        return ("rep", mirrored(node[1]), *node[2:])
    return node


# --- Thompson automaton, subset construction, minimisation --------------------------------------------------------------

@dataclass
class _Nfa:
    free: list[list[int]] = field(default_factory=list)                          # moves without a byte
    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    accepts: dict[int, int] = field(default_factory=dict)                        # state to rule bits

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, node, start: int) -> int:
        """Adds the tree from ``start`` on; the state in which it ends."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "or":
            for part in node[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, low, high = node
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            start = loop
        else:
            for _ in range(high - low):
                self.free[start].append(end)
                start = self.add(part, start)
        self.free[start].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Dfa:
    """Flat transition arrays.  States are named by their row's start, so a step is ``next[state + class]``.

    Rows from ``accepting`` on accept; ``rules`` holds their bits in row order.  ``start`` is the first row; ``dead`` is a
    row that never accepts again, or -1.
    """

    classes: bytes
    next: list[int]
    width: int
    start: int
    accepting: int
    rules: list[int]
    dead: int


def _determine(nfa: _Nfa, start: int) -> Dfa:
    # bytes that no rule tells apart share a class
    signature: dict[int, list] = {b: [] for b in ANY}
    for sets in {s for row in nfa.moves for s, _ in row}:
        for b in ANY:
            signature[b].append(b in sets)
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(signature[b]), len(kinds)) for b in range(256))
    sample = [classes.index(k) for k in range(len(kinds))]

    first = nfa.closure([start])
    number, todo, table = {first: 0}, [first], []
    while todo:
        states = todo.pop(0)
        row = []
        for b in sample:
            to = nfa.closure({t for s in states for held, t in nfa.moves[s] if b in held})
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    bits = [0] * len(number)
    for states, n in number.items():
        for s in states:
            bits[n] |= nfa.accepts.get(s, 0)

    # Moore: split groups until all members of a group move alike
    group = list(bits)
    while True:
        keys: dict[tuple, int] = {}
        finer = [keys.setdefault((group[n], *[group[t] for t in table[n]]), len(keys)) for n in range(len(table))]
        if len(keys) == len(set(group)):
            break
        group = finer
    member: dict[int, int] = {}
    for n, g in enumerate(finer):
        member.setdefault(g, n)
    order = sorted(member, key=lambda g: bits[member[g]] != 0)         # accepting rows last
    place = {g: i * len(kinds) for i, g in enumerate(order)}
    rows = [[place[finer[t]] for t in table[member[g]]] for g in order]
    silent = sum(not bits[member[g]] for g in order)
    dead = next((place[g] for g, row in zip(order, rows, strict=True) if set(row) == {place[g]} and not bits[member[g]]), -1)
    return Dfa(classes, [t for row in rows for t in row], len(kinds), place[finer[0]], silent * len(kinds),
               [bits[member[g]] for g in order[silent:]], dead)


class Scanner:
    """Finds the matches of all rules (pattern, ignore_case) in bytes."""

    def __init__(self, rules: Iterable[tuple[str, bool]]):
        trees = [parse(p, fold) for p, fold in rules]
        back = _Nfa()
        start = back.state()
        back.moves[start].append((ANY, start))
        for i, tree in enumerate(trees):
            entry = back.state()
            back.free[start].append(entry)
            end = back.add(mirrored(tree), entry)
            back.accepts[end] = 1 << i
        self.back = _determine(back, start)
        self.forward = []
        for tree in trees:
            nfa = _Nfa()
            entry = nfa.state()
            nfa.accepts[nfa.add(tree, entry)] = 1
            self.forward.append(_determine(nfa, entry))

    def starts(self, data: bytes) -> list[tuple[int, int]]:
        """(place, bits of the rules with a match that starts there), in rising order: the one pass over all bytes."""
        dfa = self.back
        step, accepting, state = dfa.next, dfa.accepting, dfa.start
        found = []
        for i, c in enumerate(data.translate(dfa.classes)[::-1]):
            state = step[state + c]
            if state >= accepting:
                found.append((i, state))
        last, width = len(data) - 1, dfa.width
        return [(last - i, dfa.rules[(s - accepting) // width]) for i, s in reversed(found)]

    def end(self, rule: int, data: bytes, at: int) -> int:
        """Where the longest match of the rule that starts at ``at`` ends; -1 if there is none."""
        dfa = self.forward[rule]
        step, state, best = dfa.next, dfa.start, -1
        for i in range(at, len(data)):
            state = step[state + dfa.classes[data[i]]]
            if state == dfa.dead:
                break
            if state >= dfa.accepting:
                best = i + 1
        return best

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) of every rule's leftmost, longest, non-overlapping matches, by start and rule."""
        found = []
        free = [0] * len(self.forward)
        for at, bits in self.starts(data):
            rule = 0
            while bits:
                if bits & 1 and at >= free[rule]:
                    free[rule] = self.end(rule, data, at)
                    found.append((rule, at, free[rule]))
                bits >>= 1
                rule += 1
        return found
