"""A small sandboxed template language, compiled to Python closures.

A template is parsed into a syntax tree, constant expressions are folded, and every node
becomes a closure that writes text. The language has output (``{{ … }}``), loops over the
messages (``{% for m in messages %}``), ``{% if %}``/``{% elif %}``/``{% else %}``,
``{% set %}``, and ``{% generation %}`` … ``{% endgeneration %}`` around what a model is
to be trained on. Expressions are names, attributes of messages and of ``loop``, string
and integer literals, ``+``, comparison, ``and``/``or``/``not``, and filters. Nothing else
can be reached: no calls, no indexing, no Python attributes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

Emit = Callable[[str, bool], None]
Env = dict[str, object]


class TemplateError(ValueError):
    """The template is not a sentence of the language."""


# Syntax tree -----------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Attr:
    of: object
    name: str


@dataclass(frozen=True)
class Filter:
    of: object
    name: str


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    of: object


@dataclass
class Text:
    value: str


@dataclass
class Output:
    expr: object


@dataclass
class Set:
    name: str
    expr: object


@dataclass
class If:
    arms: list[tuple[object, list]]
    other: list = field(default_factory=list)


@dataclass
class For:
    name: str
    over: str
    body: list


@dataclass
class Generation:
    body: list


# Filters ---------------------------------------------------------------------------

_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash goes between, one more where some are there."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_line(text: str) -> str:
    """``escape`` for a field that ends at a line break."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    plain = {"\\\\": "\\", "\\n": "\n"}
    return re.sub(r"\\[\\n]", lambda m: plain[m.group()], unescape(text))


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}

# Parser ----------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(-?)(.*?)(-?)%\}", re.S)
_LEX = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[=+|.()]))""", re.S)
_CHARS = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


class Tokens:
    def __init__(self, source: str) -> None:
        self.items, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _LEX.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            kind = "string number name op".split()[m.lastindex - 1]
            self.items.append((kind, m.group(m.lastindex)))
            at = m.end()

    def peek(self) -> tuple[str, str]:
        return self.items[0] if self.items else ("end", "")

    def take(self, value: str | None = None, kind: str | None = None) -> str:
        k, v = self.peek()
        if k == "end" or (value is not None and v != value) or (kind is not None and k != kind):
            raise TemplateError(f"expected {value or kind}, found {v!r}")
        self.items.pop(0)
        return v

    def accept(self, *values: str) -> str | None:
        k, v = self.peek()
        return self.take() if k != "string" and k != "end" and v in values else None


def expression(t: Tokens) -> object:
    left = conjunction(t)
    while t.accept("or"):
        left = Binary("or", left, conjunction(t))
    return left


def conjunction(t: Tokens) -> object:
    left = negation(t)
    while t.accept("and"):
        left = Binary("and", left, negation(t))
    return left


def negation(t: Tokens) -> object:
    if t.accept("not"):
        return Not(negation(t))
    left = addition(t)
    if op := t.accept("==", "!="):
        return Binary(op, left, addition(t))
    return left


def addition(t: Tokens) -> object:
    left = filtered(t)
    while t.accept("+"):
        left = Binary("+", left, filtered(t))
    return left


def filtered(t: Tokens) -> object:
    left = primary(t)
    while True:
        if t.accept("."):
            left = Attr(left, t.take(kind="name"))
        elif t.accept("|"):
            name = t.take(kind="name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            left = Filter(left, name)
        else:
            return left


def primary(t: Tokens) -> object:
    kind, value = t.peek()
    if t.accept("("):
        inner = expression(t)
        t.take(")")
        return inner
    if kind == "string":
        t.take()
        return Const(re.sub(r"\\(.)", lambda m: _CHARS.get(m[1], m[0]), value[1:-1], flags=re.S))
    if kind == "number":
        return Const(int(t.take()))
    if kind == "name":
        t.take()
        return Const(value == "true") if value in ("true", "false") else Name(value)
    raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list:
    """The syntax tree of a template. ``{%-`` and ``-%}`` take the white space beside them."""
    pieces, at, strip = [], 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        text = text.rstrip() if m.group(2) else text
        pieces += [("text", text)] if text else []
        pieces.append(("out", m.group(1)) if m.group(1) is not None else ("tag", m.group(3)))
        at, strip = m.end(), bool(m.group(4))
    rest = source[at:].lstrip() if strip else source[at:]
    pieces += [("text", rest)] if rest else []
    body, end = block(pieces, ())
    assert not end
    return body


def block(pieces: list, ends: tuple[str, ...]) -> tuple[list, Tokens | None]:
    body: list = []
    while pieces:
        kind, value = pieces.pop(0)
        if kind == "text":
            body.append(Text(value))
            continue
        t = Tokens(value)
        if kind == "out":
            body.append(Output(expression(t)))
        elif (word := t.take(kind="name")) in ends:
            t.items.insert(0, ("name", word))
            return body, t
        elif word == "set":
            name = t.take(kind="name")
            t.take("=")
            body.append(Set(name, expression(t)))
        elif word == "if":
            body.append(branches(pieces, expression(t)))
        elif word == "for":
            name = t.take(kind="name")
            t.take("in")
            over = t.take(kind="name")
            inner, _ = block(pieces, ("endfor",))
            body.append(For(name, over, inner))
        elif word == "generation":
            inner, _ = block(pieces, ("endgeneration",))
            body.append(Generation(inner))
        else:
            raise TemplateError(f"unknown tag {word!r}")
        if t.items:
            raise TemplateError(f"left over: {t.items[0][1]!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return body, None


def branches(pieces: list, test: object) -> If:
    node = If([])
    while True:
        inner, end = block(pieces, ("elif", "else", "endif"))
        word = end.take()
        node.arms.append((test, inner))
        if word == "endif":
            return node
        if word == "else":
            node.other, _ = block(pieces, ("endif",))
            return node
        test = expression(end)


# Constant folding ------------------------------------------------------------------


def fold(e: object) -> object:
    """The expression with everything computed that no message can change."""
    if isinstance(e, Attr):
        return Attr(fold(e.of), e.name)
    if isinstance(e, Filter):
        of = fold(e.of)
        return Const(FILTERS[e.name](text_of(of.value))) if isinstance(of, Const) else Filter(of, e.name)
    if isinstance(e, Not):
        of = fold(e.of)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(e, Binary):
        left, right = fold(e.left), fold(e.right)
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(OPS[e.op](left.value, right.value))
        if isinstance(left, Const) and e.op in ("and", "or"):
            return right if bool(left.value) == (e.op == "and") else left
        inner = isinstance(left, Binary) and left.op == e.op == "+"
        if inner and isinstance(right, Const) and isinstance(left.right, Const) and both_text(left, right):
            return Binary("+", left.left, Const(left.right.value + right.value))
        return Binary(e.op, left, right)
    return e


def both_text(left: Binary, right: Const) -> bool:
    return isinstance(left.right.value, str) and isinstance(right.value, str)


def fold_body(body: list) -> list:
    out: list = []
    for node in body:
        if isinstance(node, Output):
            e = fold(node.expr)
            node = Text(text_of(e.value)) if isinstance(e, Const) else Output(e)
        elif isinstance(node, Set):
            node = Set(node.name, fold(node.expr))
        elif isinstance(node, For):
            node = For(node.name, node.over, fold_body(node.body))
        elif isinstance(node, Generation):
            node = Generation(fold_body(node.body))
        elif isinstance(node, If):
            arms, other = [], fold_body(node.other)
            for test, inner in node.arms:
                test = fold(test)
                if isinstance(test, Const) and test.value:
                    other = fold_body(inner)
                    break
                if not isinstance(test, Const):
                    arms.append((test, fold_body(inner)))
            if not arms:
                for inner in other:
                    join(out, inner)
                continue
            node = If(arms, other)
        join(out, node)
    return out


def join(out: list, node: object) -> None:
    if isinstance(node, Text) and out and isinstance(out[-1], Text):
        out[-1] = Text(out[-1].value + node.value)
    elif not (isinstance(node, Text) and not node.value):
        out.append(node)


# Code ------------------------------------------------------------------------------


def text_of(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value)


def plus(a: object, b: object) -> object:
    return a + b if isinstance(a, int) and isinstance(b, int) else text_of(a) + text_of(b)


OPS: dict[str, Callable] = {
    "+": plus,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def value_code(e: object) -> Callable[[Env], object]:
    if isinstance(e, Const):
        return lambda env, v=e.value: v
    if isinstance(e, Name):
        return lambda env, n=e.name: env.get(n)
    if isinstance(e, Attr):
        of, name = value_code(e.of), e.name

        def attr(env: Env) -> object:
            holder = of(env)
            return holder.get(name) if isinstance(holder, dict) else None

        return attr
    if isinstance(e, Filter):
        of, f = value_code(e.of), FILTERS[e.name]
        return lambda env: f(text_of(of(env)))
    if isinstance(e, Not):
        of = value_code(e.of)
        return lambda env: not of(env)
    left, right, op = value_code(e.left), value_code(e.right), e.op
    if op == "and":
        return lambda env: left(env) and right(env)
    if op == "or":
        return lambda env: left(env) or right(env)
    return lambda env, f=OPS[op]: f(left(env), right(env))


def body_code(body: list) -> Callable[[Env, Emit, bool], Iterator[None]]:
    """A generator of the body: it yields after each message, so that output can be drained."""
    steps = [node_code(n) for n in body]

    def run(env: Env, emit: Emit, on: bool) -> Iterator[None]:
        for loops, step in steps:
            if loops:
                yield from step(env, emit, on)
            else:
                step(env, emit, on)

    return run


def plain(run: Callable) -> Callable[[Env, Emit, bool], None]:
    def step(env: Env, emit: Emit, on: bool) -> None:
        for _ in run(env, emit, on):
            pass

    return step


def loops_in(body: list) -> bool:
    return any(
        isinstance(n, For)
        or (isinstance(n, Generation) and loops_in(n.body))
        or (isinstance(n, If) and (loops_in(n.other) or any(loops_in(b) for _, b in n.arms)))
        for n in body
    )


def node_code(node: object) -> tuple[bool, Callable]:
    if isinstance(node, Text):
        return False, lambda env, emit, on, v=node.value: emit(v, on)
    if isinstance(node, Output):
        value = value_code(node.expr)
        return False, lambda env, emit, on: emit(text_of(value(env)), on)
    if isinstance(node, Set):
        value = value_code(node.expr)
        return False, lambda env, emit, on, n=node.name: env.__setitem__(n, value(env))
    if isinstance(node, Generation):
        inner, deep = body_code(node.body), loops_in(node.body)
        if deep:
            return True, lambda env, emit, on: inner(env, emit, True)
        once = plain(inner)
        return False, lambda env, emit, on: once(env, emit, True)
    if isinstance(node, If):
        arms = [(value_code(t), body_code(b)) for t, b in node.arms]
        other, deep = body_code(node.other), loops_in([node])

        def choose(env: Env, emit: Emit, on: bool) -> Iterator[None]:
            for test, inner in arms:
                if test(env):
                    return inner(env, emit, on)
            return other(env, emit, on)

        return (True, choose) if deep else (False, plain(choose))
    inner = body_code(node.body)

    def loop(env: Env, emit: Emit, on: bool) -> Iterator[None]:
        items = iter(env.get(node.over) or ())
        done = object()
        item, i = next(items, done), 0
        while item is not done:
            after = next(items, done)
            env[node.name] = item
            env["loop"] = {"index": i + 1, "first": i == 0, "last": after is done}
            yield from inner(env, emit, on)
            yield
            item, i = after, i + 1

    return True, loop


def compile_template(source: str) -> Callable[[Iterable[dict], Emit], Iterator[None]]:
    """A renderer: it reads messages one by one, emits (text, under the mask?), yields."""
    code = body_code(fold_body(parse(source)))
    return lambda messages, emit: code({"messages": messages}, emit, False)
