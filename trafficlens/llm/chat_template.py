"""Compiler of a small sandboxed template language (used by operator 12).

    {% for message in messages %}<turn>{{ message.role | escape }}...{% endfor %}

Statements: ``for x in expr``, ``if / elif / else``, ``set x = expr``,
``generation`` (marks what the model is to learn), each with its ``end``.
Expressions: literals, names, ``a.key``, ``a[key]``, ``~`` (join as text),
``+ -``, comparisons, ``in``, ``not and or``, ``x if c else y`` and filters
``| name(args)``. A minus sign inside a tag strips white space on that side;
``{# #}`` is a comment.

A source is parsed into a syntax tree, constant parts are folded, and the tree
becomes nested Python closures. Sandbox: names come from the given scope only,
keys are looked up in mappings and lists only (never attributes), nothing can
be called but the filters listed here, loops run over lists, and ``set`` inside
a loop ends with its round.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

DEPTH = 40  # nested blocks or brackets
FOLDED = 1 << 16  # characters of a folded constant at most


class TemplateError(ValueError):
    pass


# ---- syntax tree: expressions, then statements -------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Apply:
    """A pure function of its arguments: an operator or a filter."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Choice:
    """``and``, ``or`` and ``if else``: not every argument is evaluated."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body); the last condition may be Const(True)


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


def text_of(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (str, int, float)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} has no text")


def _look_up(of: object, key: object) -> object:
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else None
    if of is None:
        return None
    raise TemplateError(f"a {type(of).__name__} has no item {key!r}")


def _number(value: object) -> object:
    if isinstance(value, (int, float)):
        return value
    raise TemplateError("+ and - take numbers; ~ joins texts")


def _within(a: object, b: object) -> bool:
    if isinstance(b, str):
        return text_of(a) in b
    return b is not None and a in b


FUNCTIONS: dict[str, Callable] = {
    "~": lambda a, b: text_of(a) + text_of(b),
    "+": lambda a, b: _number(a) + _number(b),
    "-": lambda a, b: _number(a) - _number(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": _within,
    "not": lambda a: not a,
    "item": _look_up,
    "list": lambda *items: list(items),
}
FILTERS: dict[str, Callable] = {
    "trim": lambda v: text_of(v).strip(),
    "upper": lambda v: text_of(v).upper(),
    "lower": lambda v: text_of(v).lower(),
    "capitalize": lambda v: text_of(v)[:1].upper() + text_of(v)[1:],
    "replace": lambda v, old, new: text_of(v).replace(text_of(old), text_of(new)),
    "default": lambda v, other: other if v is None else v,
    "length": lambda v: len(v) if v is not None else 0,
    "join": lambda v, by="": text_of(by).join(map(text_of, v)),
}


# ---- parser ---------------------------------------------------------------------------

_TAG = re.compile(r"\{%.*?%\}|\{\{.*?\}\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+(?:\.\d+)?)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>.,|()\[\]=]))""",
    re.S,
)
_WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expressions:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.at, self.depth, self.filters = [], 0, 0, filters
        end = len(source.rstrip())
        place = 0
        while place < end:
            m = _TOKEN.match(source, place)
            if not m:
                raise TemplateError(f"cannot read {source[place:place + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            place = m.end()

    def peek(self, *texts: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in texts

    def take(self, *texts: str) -> str | None:
        if not self.peek(*texts):
            return None
        self.at += 1
        return self.tokens[self.at - 1][1]

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def identifier(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is not expected")

    def expression(self) -> object:
        self.depth += 1
        if self.depth > DEPTH:
            raise TemplateError("brackets are nested too deeply")
        value = self.either()
        if self.take("if"):
            condition = self.either()
            other = self.expression() if self.take("else") else Const(None)
            value = Choice("if", (condition, value, other))
        self.depth -= 1
        return value

    def either(self) -> object:
        value = self.both()
        while self.take("or"):
            value = Choice("or", (value, self.both()))
        return value

    def both(self) -> object:
        value = self.negated()
        while self.take("and"):
            value = Choice("and", (value, self.negated()))
        return value

    def negated(self) -> object:
        odd = False
        while self.take("not"):
            odd = not odd
        value = self.comparison()
        return Apply("not", (value,)) if odd else value

    def comparison(self) -> object:
        value = self.joined()
        if op := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            return Apply(op, (value, self.joined()))
        if self.peek("not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
            self.at += 2
            return Apply("not", (Apply("in", (value, self.joined())),))
        return value

    def joined(self) -> object:
        value = self.summed()
        while self.take("~"):
            value = Apply("~", (value, self.summed()))
        return value

    def summed(self) -> object:
        value = self.filtered()
        while op := self.take("+", "-"):
            value = Apply(op, (value, self.filtered()))
        return value

    def filtered(self) -> object:
        value = self.postfix()
        while self.take("|"):
            name = self.identifier()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            value = Apply(f"|{name}", (value, *(self.arguments(")") if self.take("(") else ())))
        return value

    def arguments(self, close: str) -> tuple:
        values = []
        while not self.take(close):
            if values:
                self.need(",")
            values.append(self.expression())
        return tuple(values)

    def postfix(self) -> object:
        value = self.primary()
        while sign := self.take(".", "["):
            if sign == ".":
                value = Item(value, Const(self.identifier()))
            else:
                value = Item(value, self.expression())
                self.need("]")
        return value

    def primary(self) -> object:
        if self.take("("):
            value = self.expression()
            self.need(")")
            return value
        if self.take("["):
            return Apply("list", self.arguments("]"))
        if self.take("-"):
            return Apply("-", (Const(0), self.primary()))
        if self.at >= len(self.tokens):
            raise TemplateError("a value is missing")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Const(float(text) if "." in text else int(text))
        if kind == "name":
            return Const(_WORDS[text]) if text in _WORDS else Name(text)
        raise TemplateError(f"{text!r} is not expected")


def _pieces(source: str) -> list[tuple[str, str]]:
    """Texts, outputs and tags, with white space stripped where a minus asks for it."""
    out: list[tuple[str, str]] = []
    place, strip = 0, False
    for m in [*_TAG.finditer(source), None]:
        text = source[place : m.start() if m else len(source)]
        text = text.lstrip() if strip else text
        strip = bool(m) and m[0][-3] == "-" and len(m[0]) > 5
        if m and m[0][2] == "-":
            text = text.rstrip()
        if text:
            out.append(("text", text))
        if m:
            place = m.end()
            inner = m[0][2:-2]
            inner = inner[1:] if inner.startswith("-") else inner
            inner = inner[:-1] if strip else inner
            if m[0][1] != "#":
                out.append(("output" if m[0][1] == "{" else "tag", inner))
    return out


class _Parser:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.pieces, self.at, self.filters = _pieces(source), 0, filters

    def block(self, ends: tuple[str, ...], depth: int) -> tuple[tuple, str, _Expressions | None]:
        """Statements up to one of the tags ``ends``, which is read too."""
        if depth > DEPTH:
            raise TemplateError("blocks are nested too deeply")
        body: list = []
        while self.at < len(self.pieces):
            kind, text = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                body.append(Output(Const(text)))
                continue
            e = _Expressions(text, self.filters)
            if kind == "output":
                body.append(Output(e.expression()))
                e.end()
                continue
            word = e.identifier()
            if word in ends:
                return tuple(body), word, e
            body.append(self.statement(word, e, depth))
        if ends:
            raise TemplateError(f"{ends[0]!r} is missing")
        return tuple(body), "", None

    def statement(self, word: str, e: _Expressions, depth: int) -> object:
        if word == "set":
            name = e.identifier()
            e.need("=")
            made: object = Set(name, e.expression())
            e.end()
            return made
        if word == "generation":
            e.end()
            body, _, last = self.block(("endgeneration",), depth + 1)
            last.end()
            return Generation(body)
        if word == "for":
            name = e.identifier()
            e.need("in")
            over = e.expression()
            e.end()
            body, _, last = self.block(("endfor",), depth + 1)
            last.end()
            return For(name, over, body)
        if word == "if":
            branches, tag = [], "if"
            while tag != "endif":
                condition = Const(True) if tag == "else" else e.expression()
                e.end()
                ends = ("endif",) if tag == "else" else ("endif", "else", "elif")
                body, tag, e = self.block(ends, depth + 1)
                branches.append((condition, body))
            e.end()
            return If(tuple(branches))
        raise TemplateError(f"no statement {word!r}")


# ---- constant folding -------------------------------------------------------------------


def fold(node: object, functions: Mapping[str, Callable]) -> object:
    """The expression with every part that is known beforehand put in."""
    if isinstance(node, Item):
        node = Apply("item", (node.of, node.key))
    if isinstance(node, Choice):
        args = tuple(fold(a, functions) for a in node.args)
        if isinstance(args[0], Const):
            known = bool(args[0].value)
            if node.op == "if":
                return args[1] if known else args[2]
            return args[0] if known == (node.op == "or") else args[1]
        return Choice(node.op, args)
    if isinstance(node, Apply):
        args = tuple(fold(a, functions) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            try:
                value = functions[node.op](*(a.value for a in args))
            except (TypeError, TemplateError) as error:
                raise TemplateError(f"{node.op} cannot be applied: {error}") from None
            if not isinstance(value, str) or len(value) <= FOLDED:
                return Const(value)
        return Apply(node.op, args)
    return node


def fold_body(body: Sequence, functions: Mapping[str, Callable]) -> tuple:
    """Statements with folded expressions; constant branches are chosen, and
    neighbouring constant texts joined."""
    out: list = []
    for s in body:
        if isinstance(s, Output):
            value = fold(s.value, functions)
            made: list = [Output(Const(text_of(value.value)) if isinstance(value, Const) else value)]
        elif isinstance(s, Set):
            made = [Set(s.name, fold(s.value, functions))]
        elif isinstance(s, Generation):
            made = [Generation(fold_body(s.body, functions))]
        elif isinstance(s, For):
            made = [For(s.name, fold(s.over, functions), fold_body(s.body, functions))]
        else:
            made, left = [], []
            for condition, part in s.branches:
                condition, part = fold(condition, functions), fold_body(part, functions)
                if isinstance(condition, Const) and not condition.value:
                    continue
                left.append((condition, part))
                if isinstance(condition, Const):
                    break
            if left and isinstance(left[0][0], Const):
                made = list(left[0][1])
            elif left:
                made = [If(tuple(left))]
        for m in made:
            if isinstance(m, Output) and isinstance(m.value, Const) and not m.value.value:
                continue
            last = out[-1] if out else None
            if all(isinstance(x, Output) and isinstance(x.value, Const) for x in (m, last)):
                out[-1] = Output(Const(last.value.value + m.value.value))
            else:
                out.append(m)
    return tuple(out)


# ---- closures ------------------------------------------------------------------------------


class Writer:
    """Collects text, and the marked ranges in code points."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.marks: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node: object, functions: Mapping[str, Callable]) -> Callable[[dict], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Choice):
        first, *rest = (_value(a, functions) for a in node.args)
        if node.op == "and":
            return lambda scope: first(scope) and rest[0](scope)
        if node.op == "or":
            return lambda scope: first(scope) or rest[0](scope)
        return lambda scope: rest[0](scope) if first(scope) else rest[1](scope)
    f, args = functions[node.op], [_value(a, functions) for a in node.args]
    if len(args) == 1:
        (one,) = args
        return lambda scope: f(one(scope))
    if len(args) == 2:
        a, b = args
        return lambda scope: f(a(scope), b(scope))
    return lambda scope: f(*(a(scope) for a in args))


def _run(body: Sequence, functions: Mapping[str, Callable]) -> Callable[[dict, Writer], None]:
    steps = [_step(s, functions) for s in body]
    if len(steps) == 1:
        return steps[0]

    def run(scope: dict, out: Writer) -> None:
        for step in steps:
            step(scope, out)

    return run


def _step(s: object, functions: Mapping[str, Callable]) -> Callable[[dict, Writer], None]:
    if isinstance(s, Output):
        if isinstance(s.value, Const):
            text = s.value.value
            return lambda scope, out: out.write(text)
        value = _value(s.value, functions)
        return lambda scope, out: out.write(text_of(value(scope)))
    if isinstance(s, Set):
        name, new = s.name, _value(s.value, functions)

        def assign(scope: dict, out: Writer) -> None:
            scope[name] = new(scope)

        return assign
    if isinstance(s, Generation):
        inner = _run(s.body, functions)

        def mark(scope: dict, out: Writer) -> None:
            start = out.length
            inner(scope, out)
            out.marks.append((start, out.length))

        return mark
    if isinstance(s, If):
        branches = [(_value(c, functions), _run(b, functions)) for c, b in s.branches]

        def choose(scope: dict, out: Writer) -> None:
            for condition, body in branches:
                if condition(scope):
                    return body(scope, out)

        return choose
    over, body, name = _value(s.over, functions), _run(s.body, functions), s.name

    def loop(scope: dict, out: Writer) -> None:
        items = over(scope) or []
        if not isinstance(items, (list, tuple)):
            raise TemplateError("loops run over lists")
        for i, item in enumerate(items):
            state = {"first": i == 0, "last": i == len(items) - 1, "index": i + 1, "index0": i, "length": len(items)}
            body({**scope, name: item, "loop": state}, out)

    return loop


def names_in(node: object, found: set | None = None) -> set[str]:
    """Names an expression or statement reads; ``loop.key`` by its full name."""
    found = set() if found is None else found
    if isinstance(node, Apply) and node.op == "item" and node.args[0] == Name("loop") and isinstance(node.args[1], Const):
        found.add(f"loop.{node.args[1].value}")
    elif isinstance(node, Name):
        found.add(node.name)
    elif isinstance(node, (tuple, list)):
        for x in node:
            names_in(x, found)
    elif hasattr(node, "__dataclass_fields__") and not isinstance(node, Const):
        for field in node.__dataclass_fields__:
            value = getattr(node, field)
            if not isinstance(value, str):
                names_in(value, found)
    return found


class Template:
    """A compiled template. ``filters`` adds to the built-in ones."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None):
        filters = {**FILTERS, **(filters or {})}
        self.functions = {**FUNCTIONS, **{f"|{k}": f for k, f in filters.items()}}
        parsed, _, _ = _Parser(source, filters).block((), 0)
        self.body = fold_body(parsed, self.functions)
        self._run = _run(self.body, self.functions)

    def render(self, **scope: object) -> tuple[str, list[tuple[int, int]]]:
        """The text and the marked ranges (start, end) in code points."""
        out = Writer()
        self._run(dict(scope), out)
        return "".join(out.parts), out.marks

    def turnwise(self, messages: str = "messages") -> tuple[Callable, Callable, Callable, set[str]]:
        """Functions (scope, writer) for what stands before the loop over the
        messages, for one round of it, and for what stands after it, so turns
        can be rendered apart. The last item names the ``loop`` values a round
        reads. An error if the template has another shape, or a round needs
        more than its own message and whether it is the first or last."""
        at = [i for i, s in enumerate(self.body) if isinstance(s, For) and s.over == Name(messages)]
        if len(at) != 1:
            raise TemplateError(f"one loop over {messages!r} must stand outside all other blocks")
        before, loop, after = self.body[: at[0]], self.body[at[0]], self.body[at[0] + 1 :]
        read = names_in(loop.body)
        if messages in names_in(before) | read | names_in(after):
            raise TemplateError(f"{messages!r} may be read by the loop only")
        if wrong := {x for x in read if x == "loop" or x.startswith("loop.")} - {"loop.first", "loop.last"}:
            raise TemplateError(f"{sorted(wrong)[0]!r} would need the whole conversation at once")
        turn, name = _run(loop.body, self.functions), loop.name

        def one(scope: dict, message: object, first: bool, last: bool, out: Writer) -> None:
            turn({**scope, name: message, "loop": {"first": first, "last": last}}, out)

        return _run(before, self.functions), one, _run(after, self.functions), read & {"loop.first", "loop.last"}
