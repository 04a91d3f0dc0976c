"""A small template language for conversations, compiled to Python closures.

``{{ expression }}`` writes a value, ``{% if %} {% elif %} {% else %} {% endif %}`` chooses,
``{% set name = expression %}`` names a value, ``{% for message in messages %} {% endfor %}`` goes over
the turns, ``{% generation %} {% endgeneration %}`` marks what a model is to learn, ``{# #}`` is a
comment.  A minus inside a tag strips the blanks on its side.

The sandbox is what the language lacks: no calls, no subscripts, no access to Python
objects.  A name must be one given or set; fields are those of ``message`` and ``loop``;
filters are those of ``FILTERS``.  All else fails when the template is compiled.

There is one loop, outside of every other tag, and what is set inside holds for one turn.  So
turns depend on their own message and place only, and parts of a conversation can be rendered apart.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

FIELDS = {"message": ("role", "content"), "loop": ("index", "index0", "first", "last")}
_TAG = re.compile(r"\{#.*?#\}|\{(?P<kind>[{%])(?P<left>-?)(?P<body>.*?)(?P<right>-?)[}%]\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<name>[A-Za-z]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>()|.,=]))""", re.S)
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


class TemplateError(ValueError):
    """The template is not in the language, or asks for something outside of the sandbox."""


def escape(text: str) -> str:
    """No ``<|`` is left: one backslash more stands between the two characters."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def one_line(text: str) -> str:
    return text.replace("\\", "\\\\").replace("\n", "\\n")


def many_lines(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)), "line": lambda x: one_line(_text(x)), "trim": lambda x: _text(x).strip(),
    "lower": lambda x: _text(x).lower(), "upper": lambda x: _text(x).upper(), "length": len,
    "default": lambda x, other: other if x is None or x == "" else x,
}


def _text(value) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


# Expressions.  A node has ``parts``; ``value`` computes it from theirs.


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Read:
    """A name, or a field of one."""

    name: str
    of: str = ""


@dataclass(frozen=True)
class Apply:
    """A function of values; it has no effect, so it can be folded when all parts are constants."""

    function: Callable
    parts: tuple


@dataclass(frozen=True)
class Choose:
    """``yes if test else no``; ``and`` and ``or`` are written so as well, with NULL for the test's own value."""

    test: object
    yes: object
    no: object


# Statements.


@dataclass(frozen=True)
class Write:
    value: object


@dataclass(frozen=True)
class Put:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Mark:
    body: tuple


@dataclass(frozen=True)
class Loop:
    body: tuple


class _Expression:
    """Reads one expression by precedence."""

    def __init__(self, source: str, known: set[str]):
        self.source, self.known, self.tokens, at = source, known, [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:].strip()!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("sign", "name") and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        found = self.peek(*values)
        self.at += found
        return found

    def next(self) -> tuple[str, str]:
        if self.at == len(self.tokens):
            raise TemplateError(f"{self.source.strip()!r} ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self):
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is left over in {self.source.strip()!r}")
        return node

    def choice(self):
        node = self.any_of()
        if self.take("if"):
            test = self.any_of()
            node = Choose(test, node, self.choice() if self.take("else") else Const(""))
        return node

    def any_of(self):
        node = self.all_of()
        while self.take("or"):
            node = Choose(node, None, self.all_of())
        return node

    def all_of(self):
        node = self.negated()
        while self.take("and"):
            node = Choose(node, self.negated(), None)
        return node

    def negated(self):
        return Apply(operator.not_, (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        node = self.added()
        while self.peek(*_COMPARE, "in"):
            sign = self.next()[1]
            right = self.added()
            node = Apply(_COMPARE[sign], (node, right)) if sign in _COMPARE else Apply(lambda a, b: _text(a) in _text(b), (node, right))
        return node

    def added(self):
        node = self.filtered()
        while self.peek("+", "-", "~"):
            sign = self.next()[1]
            function = {"+": operator.add, "-": operator.sub, "~": lambda a, b: _text(a) + _text(b)}[sign]
            node = Apply(function, (node, self.filtered()))
        return node

    def filtered(self):
        node = self.single()
        while self.take("|"):
            name = self.next()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            parts = [node]
            if self.take("("):
                while not self.take(")"):
                    parts.append(self.choice())
                    self.take(",")
            node = Apply(FILTERS[name], tuple(parts))
        return node

    def single(self):
        kind, value = self.next()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if value == "(":
            node = self.choice()
            if not self.take(")"):
                raise TemplateError(f"a bracket stays open in {self.source.strip()!r}")
            return node
        if value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        if kind != "name" or value not in self.known:
            raise TemplateError(f"{value!r} is not known")
        if value not in FIELDS:
            return Read(value)
        if not self.take(".") or (name := self.next()[1]) not in FIELDS[value]:
            raise TemplateError(f"{value!r} has the fields {', '.join(FIELDS[value])} only")
        return Read(name, value)


class _Parser:
    """Reads statements into a tree."""

    def __init__(self, source: str, given: Iterable[str]):
        self.known, self.looped, self.inside = set(given), False, 0
        self.pieces, at, strip = [], 0, False
        for m in [*_TAG.finditer(source), None]:
            text = source[at:m.start() if m else len(source)]
            text = text.lstrip() if strip else text
            text = text.rstrip() if m and m["left"] else text
            if text:
                self.pieces.append(("text", text))
            if m and m["kind"]:
                if source[m.end() - 2] != {"{": "}", "%": "%"}[m["kind"]]:
                    raise TemplateError(f"{m[0]!r} does not close as it opens")
                self.pieces.append((m["kind"], m["body"].strip()))
            at, strip = m.end() if m else at, bool(m and m["right"])
        self.place = 0

    def body(self, *ends: str) -> tuple[tuple, str]:
        """Statements up to one of the tags in ``ends``, and that tag."""
        found = []
        while self.place < len(self.pieces):
            kind, body = self.pieces[self.place]
            self.place += 1
            if kind == "text":
                found.append(Write(Const(body)))
            elif kind == "{":
                found.append(Write(_Expression(body, self.known).whole()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return tuple(found), body
                found.append(self.statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(found), ""

    def statement(self, word: str, rest: str):
        if word == "set":
            name, _, value = rest.partition("=")
            name = name.strip()
            if not re.fullmatch(r"[A-Za-z]\w*", name) or name in FIELDS:
                raise TemplateError(f"{name!r} cannot be set")
            node = Put(name, _Expression(value, self.known).whole())
            self.known.add(name)
            return node
        if word not in ("if", "for", "generation"):
            raise TemplateError(f"no tag {word!r}")
        outer = set(self.known)
        if word == "for":
            if rest.split() != ["message", "in", "messages"] or self.looped or self.inside:
                raise TemplateError("the one loop is {% for message in messages %}, outside of other tags")
            self.looped = True
            self.known |= set(FIELDS)
        self.inside += 1
        if word == "if":
            node = self.branches(rest)
        else:
            body, _ = self.body(f"end{word}")
            node = Loop(body) if word == "for" else Mark(body)
        self.inside -= 1
        if word == "for":
            self.known = outer
        return node

    def branches(self, test: str):
        condition = _Expression(test, self.known).whole()
        yes, end = self.body("elif", "else", "endif")
        if end.startswith("elif"):
            return If(condition, yes, (self.branches(end[4:]),))
        no = self.body("endif")[0] if end == "else" else ()
        return If(condition, yes, no)


def fold(node):
    """An expression with every constant part worked out."""
    if isinstance(node, Apply):
        parts = tuple(map(fold, node.parts))
        if all(isinstance(p, Const) for p in parts):
            try:
                return Const(node.function(*(p.value for p in parts)))
            except TypeError as wrong:
                raise TemplateError(str(wrong)) from wrong
        return Apply(node.function, parts)
    if isinstance(node, Choose):
        test = fold(node.test)
        yes, no = (test if x is None else fold(x) for x in (node.yes, node.no))
        if isinstance(test, Const):
            return yes if test.value else no
        return Choose(test, *(None if x is None else y for x, y in ((node.yes, yes), (node.no, no))))
    return node


def fold_body(body: Iterable) -> tuple:
    """Statements with constants folded: dead branches go, neighbouring texts become one."""
    found = []
    for node in body:
        if isinstance(node, If):
            test = fold(node.test)
            yes, no = fold_body(node.yes), fold_body(node.no)
            nodes = (yes if test.value else no) if isinstance(test, Const) else (If(test, yes, no),)
        elif isinstance(node, Write):
            value = fold(node.value)
            nodes = (Write(Const(_text(value.value)) if isinstance(value, Const) else value),)
        elif isinstance(node, Put):
            nodes = (Put(node.name, fold(node.value)),)
        else:
            nodes = (type(node)(fold_body(node.body)),)
        for x in nodes:
            if isinstance(x, Write) and isinstance(x.value, Const) and found and isinstance(found[-1], Write) and isinstance(found[-1].value, Const):
                found[-1] = Write(Const(found[-1].value.value + x.value.value))
            else:
                found.append(x)
    return tuple(x for x in found if x != Write(Const("")))


@dataclass
class Page:
    """What is written, and the marks as first and one past the last code point."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    marks: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _value(node) -> Callable[[dict], object]:
    """A closure from a scope to the value of an expression."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Read):
        key = f"{node.of}.{node.name}" if node.of else node.name
        return lambda scope: scope.get(key)
    if isinstance(node, Choose):
        test = _value(node.test)
        yes, no = (None if x is None else _value(x) for x in (node.yes, node.no))

        def choose(scope):
            got = test(scope)
            branch = yes if got else no
            return got if branch is None else branch(scope)

        return choose
    function, parts = node.function, [_value(p) for p in node.parts]
    if len(parts) == 1:
        (only,) = parts
        return lambda scope: function(only(scope))
    return lambda scope: function(*(p(scope) for p in parts))


def _run(body: tuple) -> Callable[[dict, Page], None]:
    """A closure that renders statements into a page."""
    steps = [_step(node) for node in body]

    def run(scope: dict, page: Page) -> None:
        for step in steps:
            step(scope, page)

    return run


def _step(node) -> Callable[[dict, Page], None]:
    if isinstance(node, Write):
        if isinstance(node.value, Const):
            text = node.value.value
            return lambda scope, page: page.write(text)
        value = _value(node.value)
        return lambda scope, page: page.write(_text(value(scope)))
    if isinstance(node, Put):
        name, value = node.name, _value(node.value)
        return lambda scope, page: scope.__setitem__(name, value(scope))
    if isinstance(node, If):
        test, yes, no = _value(node.test), _run(node.yes), _run(node.no)
        return lambda scope, page: (yes if test(scope) else no)(scope, page)
    body = _run(node.body)

    def mark(scope, page):
        start = page.size
        body(scope, page)
        if page.marks and page.marks[-1][1] > start:
            raise TemplateError("generation marks must not nest")
        page.marks.append((start, page.size))

    return mark


class Template:
    """A compiled template: ``head``, ``turn`` and ``tail`` render what stands before, in and behind the loop."""

    def __init__(self, source: str, **given):
        tree = fold_body(_Parser(source, given).body()[0])
        at = next((i for i, node in enumerate(tree) if isinstance(node, Loop)), len(tree))
        self.given, self.tree = given, tree
        self._head, self._tail = _run(tree[:at]), _run(tree[at + 1:])
        self._turn = _run(tree[at].body) if at < len(tree) else _run(())

    def pages(self, turns: Iterable[tuple[str, str]], before: int, total: int, characters: int) -> Iterator[Page]:
        """Pages for the turns (role, content) that follow ``before`` earlier ones of ``total``.

        The head stands on the page of the first turn, the tail on that of the last.  A page ends
        behind the turn that fills it.
        """
        outer, page, at = dict(self.given), Page(), before
        self._head(outer, page if before == 0 else Page())
        for role, content in turns:
            scope = outer | {
                "message.role": role, "message.content": content, "loop.index0": at, "loop.index": at + 1, "loop.first": at == 0, "loop.last": at == total - 1,
            }
            self._turn(scope, page)
            at += 1
            if at == total:
                self._tail(dict(outer), page)
            if page.size >= characters and at < total:
                yield page
                page = Page()
        if page.size or page.marks:
            yield page

    def render(self, turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """One conversation as a whole: its text and marks."""
        turns = list(turns)
        (page,) = [*self.pages(turns, 0, len(turns), 1 << 62)] or [Page()]
        return "".join(page.parts), page.marks
