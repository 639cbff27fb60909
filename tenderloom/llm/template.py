"""A compiler for chat templates: source -> syntax tree -> folded tree -> Python closures.

The language is closed: a template sees the messages one at a time (``message.role``, ``message.text``), the loop's
place (``loop.index``, ``loop.index0``, ``loop.first``, ``loop.last``) and names it sets itself.  There are no calls, no
attributes of other values and no loops but the one over the messages, so rendering takes time and room in
proportion to the texts, whatever the template says.  Values are texts, whole numbers, booleans and none.

    {# comment #}   {{ expression }}   {% set name = expression %}   {% control 'a', 'b' %}
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}   {% generation %} .. {% endgeneration %}
    {% for message in messages %} .. {% endfor %}

``-`` inside a delimiter strips the white space beside it.  Expressions have ``or and not``, comparisons, ``in``,
``not in``, ``~`` (joins as text), ``+ -`` of numbers, ``a if c else b`` and filters (``| escape`` and those in
``FILTERS``).  ``control`` declares the strings that mark turns; ``escape`` puts a backslash before each place where
a text would be read as one, and before each backslash, and ``unescape`` takes them away.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

MOST_SOURCE, MOST_DEPTH, MOST_TOKENS = 100_000, 60, 400
ESCAPE = "\\"
LOOP = ("index", "index0", "first", "last")
MESSAGE = ("role", "text")
FILTERS: dict[str, Callable[[str], Any]] = {
    "upper": str.upper,
    "lower": str.lower,
    "trim": str.strip,
    "capitalize": str.capitalize,
    "length": len,
}


class TemplateError(ValueError):
    """The template is not of the language, or its marks could be confused with texts."""


# --- syntax tree ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str  # "message.text", "loop.first", or a name that the template sets


@dataclass(frozen=True)
class Apply:
    """An operation on values without side effects: unary, binary or a filter."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Logic:
    """``and`` or ``or``: the value that decides."""

    op: str
    first: Any
    second: Any


@dataclass(frozen=True)
class Choose:
    """``then`` if the test holds, else ``other``."""

    test: Any
    then: Any
    other: Any


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    expr: Any


@dataclass(frozen=True)
class Set:
    name: str
    expr: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class For:
    body: tuple


# --- reading ----------------------------------------------------------------------------------------

_QUOTED = r"'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\""
_DELIMITED = re.compile(
    r"\{#(?P<before>-?).*?(?P<after>-?)#\}|\{(?P<kind>[{%])(?P<left>-?)"
    rf"(?P<inside>(?:{_QUOTED}|[^'\"])*?)(?P<right>-?)(?P<close>\}}\}}|%\}})",
    re.S,
)
_TOKEN = re.compile(
    rf"\s*(?:(?P<number>\d+)|(?P<text>{_QUOTED})|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[<>~+\-|().,=]))", re.S
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_RESERVED = {*_WORDS, "and", "or", "not", "in", "if", "else", "message", "messages", "loop"}
_COMPARED = ("==", "!=", "<", "<=", ">", ">=", "in")


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while source[at:].strip():
        found = _TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"cannot read {source[at:].strip()[:20]!r}")
        out.append((found.lastgroup, found[found.lastgroup]))
        at = found.end()
        if len(out) > MOST_TOKENS:
            raise TemplateError("an expression is too long")
    return out


class _Expressions:
    """Reads expressions, by descent from ``if`` over ``or`` down to single values."""

    def __init__(self, source: str):
        self.tokens, self.at, self.depth = _tokens(source), 0, 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return value if kind in ("name", "sign") else None

    def take(self, *values: str) -> str | None:
        if self.peek() in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, *values: str) -> str:
        found = self.take(*values)
        if found is None:
            raise TemplateError(f"expected {' or '.join(values)}")
        return found

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def whole(self):
        found = self.expression()
        self.end()
        return found

    def expression(self):
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise TemplateError("nested too deeply")
        value = self.either()
        if self.take("if"):
            test = self.either()
            other = self.expression() if self.take("else") else Const("")
            value = Choose(test, value, other)
        self.depth -= 1
        return value

    def either(self):
        value = self.both()
        while self.take("or"):
            value = Logic("or", value, self.both())
        return value

    def both(self):
        value = self.negated()
        while self.take("and"):
            value = Logic("and", value, self.negated())
        return value

    def negated(self):
        if self.take("not"):
            return Apply("not", (self.negated(),))
        return self.compared()

    def compared(self):
        value = self.joined()
        while True:
            if op := self.take(*_COMPARED):
                value = Apply(op, (value, self.joined()))
            elif self.peek() == "not":
                self.at += 1
                self.need("in")
                value = Apply("not", (Apply("in", (value, self.joined())),))
            else:
                return value

    def joined(self):
        value = self.added()
        while self.take("~"):
            value = Apply("~", (value, self.added()))
        return value

    def added(self):
        value = self.single()
        while op := self.take("+", "-"):
            value = Apply(op, (value, self.single()))
        return value

    def single(self):
        value = self.atom()
        while self.take("|"):
            name = self.name()
            if name != "escape" and name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            value = Apply(f"|{name}", (value,))
        return value

    def atom(self):
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too soon")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Const(int(value))
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if value == "(":
            inner = self.expression()
            self.need(")")
            return inner
        if kind == "name" and value in _WORDS:
            return Const(_WORDS[value])
        if kind == "name" and value in ("message", "loop"):
            self.need(".")
            part = self.name()
            if part not in (MESSAGE if value == "message" else LOOP):
                raise TemplateError(f"{value} has no {part!r}")
            return Name(f"{value}.{part}")
        if kind == "name" and value not in _RESERVED:
            return Name(value)
        raise TemplateError(f"unexpected {value!r}")


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """(text, '{' or '%') and their contents in order, with white space stripped and comments left out."""
    at, strip = 0, False
    for found in _DELIMITED.finditer(source):
        text = source[at : found.start()]
        text = text.lstrip() if strip else text
        yield "text", text.rstrip() if found["left"] or found["before"] else text
        at, strip = found.end(), bool(found["right"] or found["after"])
        if found["kind"]:
            if found["close"] != ("}}" if found["kind"] == "{" else "%}"):
                raise TemplateError(f"{found[0][:20]!r} is not closed as it was opened")
            yield found["kind"], found["inside"].strip()
    rest = source[at:].lstrip() if strip else source[at:]
    if re.search(r"\{[{%#]", rest):
        raise TemplateError("a delimiter is not closed")
    yield "text", rest


class _Statements:
    def __init__(self, source: str):
        if len(source) > MOST_SOURCE:
            raise TemplateError("the template is too long")
        self.pieces, self.at = list(_pieces(source)), 0
        self.controls: list[str] = []
        self.loops = 0

    def block(self, ends: tuple[str, ...], depth: int, inside: frozenset[str]) -> tuple[tuple, str, str]:
        """Nodes up to a tag of ``ends``, that tag and the rest of it."""
        if depth > MOST_DEPTH:
            raise TemplateError("nested too deeply")
        nodes: list = []
        while self.at < len(self.pieces):
            kind, content = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Text(content))
                continue
            if kind == "{":
                nodes.append(Output(self.checked(_Expressions(content).whole(), inside)))
                continue
            tag, _, rest = content.partition(" ")
            if tag in ends:
                return tuple(nodes), tag, rest
            nodes.extend(self.statement(tag, rest, depth, inside))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(nodes), "", ""

    def statement(self, tag: str, rest: str, depth: int, inside: frozenset[str]) -> list:
        if tag == "control":
            reader = _Expressions(rest)
            while True:
                found = fold_expression(reader.expression(), {}, ())
                if not isinstance(found, Const) or not isinstance(found.value, str):
                    raise TemplateError("a control string must be a constant text")
                self.controls.append(found.value)
                if not reader.take(","):
                    reader.end()
                    return []
        if tag == "set":
            reader = _Expressions(rest)
            name = reader.name()
            if name in _RESERVED:
                raise TemplateError(f"{name!r} cannot be set")
            reader.need("=")
            return [Set(name, self.checked(reader.whole(), inside))]
        if tag == "if":
            return [self.branch(rest, depth, inside)]
        if tag == "generation":
            if "generation" in inside:
                raise TemplateError("generation inside generation")
            return [Generation(self.block(("endgeneration",), depth + 1, inside | {"generation"})[0])]
        if tag == "for":
            if rest.split() != ["message", "in", "messages"] or inside or depth or self.loops:
                raise TemplateError("the one loop is {% for message in messages %}, outside of all other blocks")
            self.loops = 1
            return [For(self.block(("endfor",), depth + 1, inside | {"for"})[0])]
        raise TemplateError(f"unknown tag {tag!r}")

    def branch(self, test: str, depth: int, inside: frozenset[str]) -> If:
        held = self.checked(_Expressions(test).whole(), inside)
        then, tag, rest = self.block(("elif", "else", "endif"), depth + 1, inside | {"if"})
        if tag == "elif":
            return If(held, then, (self.branch(rest, depth + 1, inside),))
        other = self.block(("endif",), depth + 1, inside | {"if"})[0] if tag == "else" else ()
        return If(held, then, other)

    @staticmethod
    def checked(expr, inside: frozenset[str]):
        if "for" not in inside and any("." in n for n in names_in(expr)):
            raise TemplateError("message and loop are only known inside the loop")
        return expr


def names_in(expr) -> set[str]:
    if isinstance(expr, Name):
        return {expr.name}
    if isinstance(expr, Apply):
        parts = expr.args
    elif isinstance(expr, Logic):
        parts = (expr.first, expr.second)
    else:
        parts = (expr.test, expr.then, expr.other) if isinstance(expr, Choose) else ()
    return {n for p in parts for n in names_in(p)}


def parse(source: str) -> tuple[tuple, tuple[str, ...]]:
    """The syntax tree of a template and the control strings it declares."""
    reader = _Statements(source)
    nodes = reader.block((), 0, frozenset())[0]
    if not reader.loops:
        raise TemplateError("the template has no {% for message in messages %}")
    return nodes, tuple(dict.fromkeys(reader.controls))


# --- values -----------------------------------------------------------------------------------------


def as_text(value) -> str:
    if isinstance(value, str):
        return value
    return "" if value is None else str(value).lower()


def _number(value) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise TemplateError("+ and - are for numbers; texts are joined by ~")
    return value


def _ordered(test):
    def compare(a, b):
        if type(a) is not type(b) or a is None:
            return False
        return test(a, b)

    return compare


OPERATIONS: dict[str, Callable] = {
    "not": lambda a: not a,
    "==": lambda a, b: type(a) is type(b) and a == b,
    "!=": lambda a, b: not (type(a) is type(b) and a == b),
    "<": _ordered(lambda a, b: a < b),
    "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b),
    ">=": _ordered(lambda a, b: a >= b),
    "in": lambda a, b: as_text(a) in as_text(b),
    "~": lambda a, b: as_text(a) + as_text(b),
    "+": lambda a, b: _number(a) + _number(b),
    "-": lambda a, b: _number(a) - _number(b),
    **{f"|{name}": lambda a, f=f: f(as_text(a)) for name, f in FILTERS.items()},
}


@dataclass(frozen=True)
class Marks:
    """Control strings, and texts written so that none of them is read as one."""

    controls: tuple[str, ...]
    _place: re.Pattern = field(init=False, compare=False)
    _first: re.Pattern = field(init=False, compare=False)

    def __post_init__(self):
        if any(not c or ESCAPE in c for c in self.controls):
            raise TemplateError("a control string is not empty and has no backslash")
        # A text may also end with the beginning of a control string that what follows would complete.
        begun = sorted({c[:k] for c in self.controls for k in range(1, len(c))})
        places = [re.escape(x) for x in (ESCAPE, *self.controls)] + [f"{re.escape(b)}\\Z" for b in begun]
        object.__setattr__(self, "_place", re.compile(f"(?={'|'.join(places)})"))
        firsts = "".join(sorted({re.escape(c[0]) for c in (ESCAPE, *self.controls)}))
        object.__setattr__(self, "_first", re.compile(f"[{firsts}]"))

    def escape(self, text: str) -> str:
        return self._place.sub(lambda _: ESCAPE, text) if self._first.search(text) else text

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S) if ESCAPE in text else text

    def reader(self) -> re.Pattern:
        """Finds escaped characters (``.group(1)`` is None) and control strings (it is the string)."""
        return re.compile(f"\\\\.|({'|'.join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True))})", re.S)

    def check(self, literal: str) -> None:
        if ESCAPE in literal or any(literal.endswith(c[:k]) for c in self.controls for k in range(1, len(c))):
            raise TemplateError(f"{literal[-20:]!r} could be read as part of a control string with what follows it")


# --- folding ----------------------------------------------------------------------------------------


def fold_expression(expr, known: dict[str, Any], controls: tuple[str, ...]):
    """The expression with everything worked out that needs no message."""
    if isinstance(expr, Name):
        return Const(known[expr.name]) if expr.name in known else expr
    if isinstance(expr, Apply):
        args = tuple(fold_expression(a, known, controls) for a in expr.args)
        if all(isinstance(a, Const) for a in args):
            operation = Marks(controls).escape if expr.op == "|escape" else OPERATIONS[expr.op]
            values = [as_text(a.value) if expr.op == "|escape" else a.value for a in args]
            return Const(operation(*values))
        return Apply(expr.op, args)
    if isinstance(expr, Logic):
        first = fold_expression(expr.first, known, controls)
        second = fold_expression(expr.second, known, controls)
        if isinstance(first, Const):
            return second if bool(first.value) == (expr.op == "and") else first
        return Logic(expr.op, first, second)
    if isinstance(expr, Choose):
        test = fold_expression(expr.test, known, controls)
        if isinstance(test, Const):
            return fold_expression(expr.then if test.value else expr.other, known, controls)
        return Choose(test, fold_expression(expr.then, known, controls), fold_expression(expr.other, known, controls))
    return expr


def _times_set(nodes: Iterable) -> dict[str, int]:
    times: dict[str, int] = {}
    for node in nodes:
        if isinstance(node, Set):
            times[node.name] = times.get(node.name, 0) + 1
        inner = (*node.then, *node.other) if isinstance(node, If) else getattr(node, "body", ())
        for name, n in _times_set(inner).items():
            times[name] = times.get(name, 0) + n
    return times


def fold(nodes: tuple, controls: tuple[str, ...]) -> tuple:
    """The tree with constants worked out, decided branches taken and neighbouring texts joined.

    A name that is set once, outside of all blocks and to a constant, is replaced wherever it is used after that.
    """
    once = {name for name, n in _times_set(nodes).items() if n == 1}
    known: dict[str, Any] = {}

    def folded(nodes, top: bool) -> tuple:
        out: list = []
        for node in nodes:
            if isinstance(node, Output):
                expr = fold_expression(node.expr, known, controls)
                found = [Text(as_text(expr.value))] if isinstance(expr, Const) else [Output(expr)]
            elif isinstance(node, Set):
                expr = fold_expression(node.expr, known, controls)
                if top and node.name in once and isinstance(expr, Const):
                    known[node.name] = expr.value
                    found = []
                else:
                    found = [Set(node.name, expr)]
            elif isinstance(node, If):
                test = fold_expression(node.test, known, controls)
                if isinstance(test, Const):
                    found = list(folded(node.then if test.value else node.other, False))
                else:
                    found = [If(test, folded(node.then, False), folded(node.other, False))]
            elif isinstance(node, (Generation, For)):
                found = [type(node)(folded(node.body, False))]
            else:
                found = [node]
            for one in found:
                if isinstance(one, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + one.value)
                elif not isinstance(one, Text) or one.value:
                    out.append(one)
        return tuple(out)

    return folded(nodes, True)


# --- closures ---------------------------------------------------------------------------------------


class Written:
    """What has been rendered: pieces of text, their length, and spans (start, end) of generated text."""

    def __init__(self):
        self.pieces, self.length, self.spans = [], 0, []

    def add(self, text: str) -> None:
        if text:
            self.pieces.append(text)
            self.length += len(text)

    def text(self) -> str:
        return "".join(self.pieces)


def expression_closure(expr, marks: Marks) -> Callable[[dict], Any]:
    if isinstance(expr, Const):
        return lambda scope, value=expr.value: value
    if isinstance(expr, Name):
        return lambda scope, name=expr.name: scope.get(name)
    if isinstance(expr, Choose):
        test, then, other = (expression_closure(e, marks) for e in (expr.test, expr.then, expr.other))
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(expr, Logic):
        first, second = expression_closure(expr.first, marks), expression_closure(expr.second, marks)
        if expr.op == "and":
            return lambda scope: first(scope) and second(scope)
        return lambda scope: first(scope) or second(scope)
    if expr.op == "|escape":
        value, escape = expression_closure(expr.args[0], marks), marks.escape
        return lambda scope: escape(as_text(value(scope)))
    operation, args = OPERATIONS[expr.op], [expression_closure(a, marks) for a in expr.args]
    if len(args) == 1:
        return lambda scope, a=args[0]: operation(a(scope))
    return lambda scope, a=args[0], b=args[1]: operation(a(scope), b(scope))


def block_closure(nodes: tuple, marks: Marks) -> Callable[[dict, Written], None]:
    """One closure that renders these nodes in turn."""
    steps = [_node_closure(n, marks) for n in nodes]

    def run(scope, out):
        for step in steps:
            step(scope, out)

    return steps[0] if len(steps) == 1 else run


def _node_closure(node, marks: Marks) -> Callable[[dict, Written], None]:
    if isinstance(node, Text):
        marks.check(node.value)
        return lambda scope, out, value=node.value: out.add(value)
    if isinstance(node, Output):
        value = expression_closure(node.expr, marks)
        return lambda scope, out: out.add(as_text(value(scope)))
    if isinstance(node, Set):
        value, name = expression_closure(node.expr, marks), node.name

        def assign(scope, out):
            scope[name] = value(scope)

        return assign
    if isinstance(node, If):
        test = expression_closure(node.test, marks)
        then, other = block_closure(node.then, marks), block_closure(node.other, marks)

        def choose(scope, out):
            (then if test(scope) else other)(scope, out)

        return choose
    body = block_closure(node.body, marks)

    def generate(scope, out):
        start = out.length
        body(scope, out)
        if out.length > start:
            out.spans.append((start, out.length))

    return generate


@dataclass(frozen=True)
class Program:
    """A compiled template: what it writes before, for each of and after the messages."""

    marks: Marks
    before: Callable[[dict, Written], None]
    turn: Callable[[dict, Written], None]
    after: Callable[[dict, Written], None]

    def begin(self, out: Written) -> dict:
        """Writes what comes before the messages and returns the names set there."""
        scope: dict = {}
        self.before(scope, out)
        return scope

    def message(self, names: dict, role: str, text: str, index: int, last: bool, out: Written) -> None:
        """Writes one message; names that it sets are gone with the next one."""
        place = {"loop.index": index + 1, "loop.index0": index, "loop.first": index == 0, "loop.last": last}
        self.turn({**names, **place, "message.role": role, "message.text": text}, out)

    def end(self, names: dict, out: Written) -> None:
        self.after(dict(names), out)

    def render(self, messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The text of a whole conversation of (role, text) and its spans of generated text."""
        out = Written()
        names = self.begin(out)
        for i, (role, text) in enumerate(messages):
            self.message(names, role, text, i, i + 1 == len(messages), out)
        self.end(names, out)
        return out.text(), out.spans


def compile_template(source: str) -> Program:
    nodes, controls = parse(source)
    nodes, marks = fold(nodes, controls), Marks(controls)
    at = next(i for i, n in enumerate(nodes) if isinstance(n, For))
    parts = nodes[:at], nodes[at].body, nodes[at + 1 :]
    return Program(marks, *(block_closure(p, marks) for p in parts))
