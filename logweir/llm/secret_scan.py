"""Secrets by one combined deterministic automaton.

Each rule's regex becomes a nondeterministic automaton. A rule's search state is the list of its
live starts, earliest first, each a set of automaton states; subset construction over such lists
gives leftmost, longest, non-overlapping matches. The rules' search automata run as one product,
which is minimised and laid out as a transition array over bytes. A text is read once, byte by
byte; a state tells which rules are inside a match. The start of a match is read off the reversed
rule, from its end backwards.
"""

import hashlib
import re
from array import array

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The base rules and the least number of characters of a match (for assign, of the
# value); shorter matches use up their text and are dropped. A hex string is a whole run, so the
# automaton need not stop at runs of under eight.
BASE_RULES = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{8,}",
}
#: Further well-known forms of credentials, whose spans are added.
MORE_RULES = {
    "hosting": r"gh[pousr]_[A-Za-z0-9]+",
    "chat": r"xox[abprs]-[A-Za-z0-9-]+",
    "signed": r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
    "private": r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----",
}
LEAST = {"assign": 6, "access": 20, "hex": 24, "hosting": 40, "chat": 15, "signed": 36}
RULES = BASE_RULES | MORE_RULES


class _Rule:
    """Reads a rule: characters, sets, groups with or without (?i:, alternatives and greedy repeats,
    all of ASCII. Gives ("bytes", set), ("row", parts), ("choice", options) and ("repeat", least,
    most, part)."""

    _TIMES = re.compile(r"\{(\d+)(,?)(\d*)\}")

    def __init__(self, pattern):
        self.text, self.at = pattern, 0

    def read(self):
        node = self._choice(False)
        if self.at < len(self.text):
            raise ValueError(f"a rule has {self.text[self.at]} too many")
        return node

    def _peek(self):
        return self.text[self.at : self.at + 1]

    def _take(self):
        self.at += 1
        if self.at > len(self.text):
            raise ValueError("a rule ends too early")
        return self.text[self.at - 1]

    def _choice(self, fold):
        options = [self._row(fold)]
        while self._peek() == "|":
            self.at += 1
            options.append(self._row(fold))
        return options[0] if len(options) == 1 else ("choice", options)

    def _row(self, fold):
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated(self._part(fold)))
        return "row", parts

    def _repeated(self, part):
        sign = self._peek()
        if not sign or sign not in "?*+{":
            return part
        times = self._TIMES.match(self.text, self.at)
        if sign == "{" and not times:
            raise ValueError("a rule may not use a brace but for repeats")
        if times:
            least = int(times[1])
            most = int(times[3]) if times[3] else None if times[2] else least
            self.at = times.end()
        else:
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            self.at += 1
        if self._peek() and self._peek() in "?*+{":
            raise ValueError("a rule may only use greedy repeats")
        return "repeat", least, most, part

    def _part(self, fold):
        sign = self._take()
        if sign == "(":
            if self.text.startswith("?i:", self.at):
                self.at, fold = self.at + 3, True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            elif self._peek() == "?":
                raise ValueError("a rule may only use plain and (?i: groups")
            inner = self._choice(fold)
            if self._take() != ")":
                raise ValueError("a group of a rule is not closed")
            return inner
        if sign == "[":
            return "bytes", self._folded(self._set(), fold)
        if sign in ".^$*+?{)":
            raise ValueError(f"a rule may not use {sign}")
        return "bytes", self._folded({self._byte(sign)}, fold)

    def _byte(self, sign):
        if sign == "\\":
            sign = self._take()
            if sign == "x":
                sign = chr(int(self._take() + self._take(), 16))
            elif sign.isalnum():
                raise ValueError(f"a rule may not use \\{sign}")
        if ord(sign) > 127:
            raise ValueError("a rule may only name ASCII characters")
        return ord(sign)

    def _set(self):
        if self._peek() == "^":
            raise ValueError("a rule may not use a set of what it leaves out")
        found = set()
        while not found or self._peek() != "]":
            low = high = self._byte(self._take())
            if self._peek() == "-" and self.text[self.at + 1 : self.at + 2] not in ("", "]"):
                self.at += 1
                high = self._byte(self._take())
            found.update(range(low, high + 1))
        self.at += 1
        return found

    @staticmethod
    def _folded(found, fold):
        if fold:
            found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
        return frozenset(found)


class Nfa:
    """States with moves on byte sets and free moves, made from a rule."""

    def __init__(self, pattern):
        self.free, self.moves = [], []
        self.start = self._state()
        self.end = self._build(_Rule(pattern).read(), self.start)

    def _state(self):
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def _build(self, node, at):
        """Adds what a node matches from state `at` on; returns the state behind it."""
        kind = node[0]
        if kind == "row":
            for part in node[1]:
                at = self._build(part, at)
            return at
        end = self._state()
        if kind == "bytes":
            self.moves[at].append((node[1], end))
        elif kind == "choice":
            for option in node[1]:
                self.free[self._build(option, at)].append(end)
        else:
            _, least, most, part = node
            for _ in range(least):
                at = self._build(part, at)
            if most is None:
                self.free[at].append(end)
                self.free[self._build(part, end)].append(end)
            else:
                for _ in range(most - least):
                    self.free[at].append(end)
                    at = self._build(part, at)
                self.free[at].append(end)
        return end

    def close(self, states):
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def step(self, states, byte):
        return self.close({to for s in states for accepted, to in self.moves[s] if byte in accepted})

    def start_of(self, data, end, floor):
        """The earliest start, not before `floor`, of a match that ends at `end`."""
        if not hasattr(self, "_back"):
            self._back = [[] for _ in self.moves]
            self._unfree = [[] for _ in self.free]
            for s, moves in enumerate(self.moves):
                for accepted, to in moves:
                    self._back[to].append((accepted, s))
                for to in self.free[s]:
                    self._unfree[to].append(s)
        at, states, found = end, self._unclose({self.end}), None
        while states:
            if self.start in states:
                found = at
            if at == floor:
                break
            at -= 1
            states = self._unclose({s for x in states for accepted, s in self._back[x] if data[at] in accepted})
        return found

    def _unclose(self, states):
        todo, seen = list(states), set(states)
        while todo:
            for to in self._unfree[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return seen


class Search:
    """One rule's search automaton; a state is (inside a match?, live starts)."""

    idle = (False, ())

    def __init__(self, nfa):
        self.nfa, self.first = nfa, nfa.close({nfa.start})
        if nfa.end in self.first:
            raise ValueError("a rule may not match the empty text")

    def next(self, state, byte):
        inside, starts = state
        if inside:
            moved = self.nfa.step(starts[0], byte)
            if moved:
                if self.nfa.end not in moved:
                    raise ValueError("a longer match of a rule must not pass through no match")
                return True, (moved,)
            return self.next(self.idle, byte)  # the match ended before this byte
        live, seen = [], set()
        for group in (*starts, self.first):
            moved = self.nfa.step(group, byte) - seen
            if moved:
                seen |= moved
                live.append(frozenset(moved))
        for place, group in enumerate(live):
            if self.nfa.end in group:
                if place:
                    raise ValueError("a later start of a rule must not match before an earlier one")
                return True, (group,)
        return False, tuple(live)


def _byte_classes(nfas):
    """Bytes that no rule tells apart, and a byte of each class."""
    sets = {accepted for nfa in nfas for moves in nfa.moves for accepted, _ in moves}
    by_kind = {}
    for byte in range(256):
        by_kind.setdefault(tuple(byte in s for s in sets), []).append(byte)
    return list(by_kind.values())


def _minimise(table, labels):
    """Merge states that no text tells apart, by refining the partition by labels."""
    block = {label: n for n, label in enumerate(dict.fromkeys(labels))}
    of = [block[label] for label in labels]
    while True:
        keys = {}
        new = [keys.setdefault((of[s], *(of[t] for t in row)), len(keys)) for s, row in enumerate(table)]
        if len(keys) == len(set(of)):
            return of
        of = new


class Automaton:
    """The combined automaton: `table[state * 256 + byte]` is the next state, times 256. States
    from `inside` on are inside a match of the rules in `rules_in[state]`."""

    def __init__(self, rules):
        self.names = list(rules)
        self.nfas = [Nfa(pattern) for pattern in rules.values()]
        searches = [Search(nfa) for nfa in self.nfas]
        classes = _byte_classes(self.nfas)
        start = tuple(s.idle for s in searches)
        number, states, rows = {start: 0}, [start], []
        for state in states:  # grows as states are found
            row = []
            for members in classes:
                to = tuple(s.next(x, members[0]) for s, x in zip(searches, state))
                if to not in number:
                    number[to] = len(states)
                    states.append(to)
                row.append(number[to])
            rows.append(row)
        labels = [tuple(n for n, (inside, _) in enumerate(state) if inside) for state in states]
        # a match that ends and another that begins at the same byte need telling apart
        of = _minimise(rows, labels)
        first = {}
        for state, block in enumerate(of):
            first.setdefault(block, state)
        order = sorted(first, key=lambda b: (bool(labels[first[b]]), first[b]))
        place = {block: n for n, block in enumerate(order)}
        table = [0] * (256 * len(order))
        for block, at in place.items():
            for members, to in zip(classes, rows[first[block]]):
                for byte in members:
                    table[256 * at + byte] = 256 * place[of[to]]
        self.table, self.n_states = table, len(order)
        self.start = 256 * place[of[0]]
        self.rules_in = {256 * place[b]: labels[first[b]] for b in order if labels[first[b]]}
        self.inside = min(self.rules_in, default=256 * len(order))

    def __getstate__(self):
        """Made once, on the driver; what tasks get is arrays."""
        return self.__dict__ | {"table": array("l", self.table)}

    def __setstate__(self, state):
        # a list gives the numbers that it holds, an array makes one at each look
        self.__dict__.update(state | {"table": state["table"].tolist()})

    def ends(self, data):
        """(rule, end) of every match, in one pass over the bytes."""
        table, inside, state = self.table, self.inside, self.start
        rules_in, now, found = self.rules_in, (), []
        for at, byte in enumerate(data):
            state = table[state + byte]
            if state >= inside or now:
                after = rules_in.get(state, ())
                if after != now:
                    found += [(rule, at) for rule in now if rule not in after]
                    now = after
        return found + [(rule, len(data)) for rule in now]

    def spans(self, data):
        """(start, end, rule) in bytes, non-overlapping for each rule."""
        floors, found = [0] * len(self.names), []
        for rule, end in self.ends(data):
            start = self.nfas[rule].start_of(data, end, floors[rule])
            floors[rule] = end
            found.append((start, end, rule))
        return sorted(found)


_AUTOMATA = {}


def combined_automaton(rules):
    key = tuple(rules.items())
    if key not in _AUTOMATA:
        _AUTOMATA[key] = Automaton(rules)
    return _AUTOMATA[key]


_ASSIGNED = re.compile(BASE_RULES["assign"], re.ASCII)


def find_secrets(text, rules=RULES):
    """(kind, start, end) in code points, by start and then in the order of the rules."""
    return _found(combined_automaton(rules), text)


def _found(automaton, text):
    data = text.encode("utf-8", "replace")
    found, at, chars = [], 0, 0
    for start, end, rule in automaton.spans(data):
        kind, matched = automaton.names[rule], data[start:end].decode()
        counted = _ASSIGNED.fullmatch(matched).group(2) if kind == "assign" else matched
        if len(counted) < LEAST.get(kind, 0):
            continue
        chars += len(data[at:start].decode())
        at = start
        found.append((kind, chars, chars + len(matched)))
    return found


def _report(automaton, text):
    found = _found(automaton, text)
    counts = [sum(kind == base for kind, _, _ in found) for base in BASE_RULES]
    spans = [f"{kind}:{start}:{end}" for kind, start, end in found]
    base = ",".join(s for s, (kind, _, _) in zip(spans, found) if kind in BASE_RULES)
    return (*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(spans))


REPORT = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_assign", "n_access", "n_hex")]
    + [T.StructField(name, T.StringType()) for name in ("base_sha256", "spans")]
)


def scan_secrets(docs, id_col="doc_id", text_col="text"):
    """One row per input row: doc_id, counts of the base kinds, base_sha256, spans.

    Null text is empty and has no spans; repeated rows are scanned each. Matches of a kind are
    leftmost and do not overlap; spans of different kinds may. Whole texts are read. The automaton
    is built once, on the driver, and its arrays go with the tasks; its size follows the rules."""
    automaton = combined_automaton(RULES)

    @F.pandas_udf(REPORT)
    def _reports(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_report(automaton, t) for t in text], columns=REPORT.names)

    found = docs.select(
        F.col(id_col).alias("doc_id"), _reports(F.coalesce(F.col(text_col), F.lit(""))).alias("r")
    )
    return found.select("doc_id", "r.*")
