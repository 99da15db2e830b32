"""A compiler for chat templates: text to a syntax tree, constants folded, closures generated.

The language has `{{ expression }}`, `{% for %}`, `{% if %}` / `{% elif %}` / `{% else %}`,
`{% set %}`, `{% generation %}` (its output is what a model learns to write) and comments
`{# #}`; a `-` inside a tag strips the white space beside it. Expressions have literals, names,
`.name` and `[key]`, comparisons, `in`, `and`, `or`, `not`, `+` and `~` (joining text), `%`,
`a if c else b`, filters and `is` tests.

It is sandboxed: a template sees the values it is given and a fixed set of filters. Names and
keys that start with an underscore are refused, keys are looked up in mappings and sequences
only, never as attributes, and nothing can be called.

A rendering is a stream of pieces, so a conversation of any length is never held as a whole; the
loop looks one message ahead for `loop.last`.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

Piece = tuple[str, bool]
_NOTHING = object()


class TemplateError(ValueError):
    """A template that cannot be compiled, or that asks for what the sandbox refuses."""


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.DOTALL)
_LEX = re.compile(
    r"\s*(?:(?P<number>\d+)|(?P<string>'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|<=|>=|[-+~%<>=().,|\[\]]))"
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_COMPARE = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": len,
    "string": str,
    "default": lambda x, other="": other if x is None else x,
}
_TESTS = {"none": lambda x: x is None, "defined": lambda x: x is not None, "string": lambda x: isinstance(x, str)}


# -- syntax --------------------------------------------------------------------


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = _LEX.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return [*out, ("end", "")]


def _checked(name: str) -> str:
    if name.startswith("_"):
        raise TemplateError(f"the name {name!r} is refused")
    return name


class _Parser:
    """Recursive descent over the tokens of one tag; nodes are tuples."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def next(self, *values: str) -> str | None:
        kind, value = self.tokens[self.at]
        if kind in ("op", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.next(value):
            raise TemplateError(f"{value!r} is missing before {self.tokens[self.at][1]!r}")

    def name(self) -> str:
        kind, value = self.tokens[self.at]
        if kind != "name":
            raise TemplateError(f"a name is missing before {value!r}")
        self.at += 1
        return _checked(value)

    def done(self, node):
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def expression(self):
        value = self.either()
        if self.next("if"):
            test = self.either()
            other = self.expression() if self.next("else") else ("const", None)
            return ("choose", test, value, other)
        return value

    def either(self):
        left = self.both()
        while self.next("or"):
            left = ("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.next("and"):
            left = ("and", left, self.negated())
        return left

    def negated(self):
        return ("not", self.negated()) if self.next("not") else self.compared()

    def compared(self):
        left = self.joined()
        while True:
            sign = self.next("==", "!=", "<=", ">=", "<", ">", "in")
            if sign is None and self.next("not"):
                self.need("in")
                sign = "not in"
            if sign:
                left = ("compare", sign, left, self.joined())
            elif self.next("is"):
                flip = bool(self.next("not"))
                test = self.name()
                if test not in _TESTS:
                    raise TemplateError(f"there is no test {test!r}")
                left = ("not", ("test", test, left)) if flip else ("test", test, left)
            else:
                return left

    def joined(self):
        left = self.filtered()
        while sign := self.next("+", "~", "-", "%"):
            left = ("join", sign, left, self.filtered())
        return left

    def filtered(self):
        value = self.postfix()
        while self.next("|"):
            name, given = self.name(), []
            if self.next("("):
                while not self.next(")"):
                    given.append(self.expression())
                    self.next(",")
            value = ("filter", name, value, tuple(given))
        return value

    def postfix(self):
        value = self.primary()
        while True:
            if self.next("."):
                value = ("get", value, ("const", self.name()))
            elif self.next("["):
                value = ("get", value, self.expression())
                self.need("]")
            elif self.next("("):
                raise TemplateError("nothing can be called")
            else:
                return value

    def primary(self):
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return ("const", int(value))
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.DOTALL))
        if kind == "name":
            fixed = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
            return ("const", fixed[value]) if value in fixed else ("name", _checked(value))
        if value == "(":
            inner = self.expression()
            self.need(")")
            return inner
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str):
    """The syntax tree of a template."""
    items: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAG.finditer(source):
        text = source[at : m.start()]
        text = text.lstrip() if strip else text
        before, after = m[1] or m[4] or m[7], m[3] or m[6] or m[8]
        items.append(("text", text.rstrip() if before else text))
        if m[2] is not None:
            items.append(("out", m[2]))
        elif m[5] is not None:
            items.append(("tag", m[5].strip()))
        at, strip = m.end(), bool(after)
    items.append(("text", source[at:].lstrip() if strip else source[at:]))
    place = 0

    def body(*ends: str):
        nonlocal place
        out = []
        while place < len(items):
            kind, value = items[place]
            place += 1
            if kind == "text":
                out.append(("text", value))
            elif kind == "out":
                p = _Parser(value)
                out.append(("out", p.done(p.expression())))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("body", tuple(out)), word, rest
                out.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return ("body", tuple(out)), "", ""

    def statement(word: str, rest: str):
        p = _Parser(rest)
        if word == "for":
            name = p.name()
            p.need("in")
            over = p.done(p.expression())
            return ("for", name, over, body("endfor")[0])
        if word == "if":
            test = p.done(p.expression())
            inside, end, more = body("elif", "else", "endif")
            if end == "elif":
                return ("if", test, inside, ("body", (statement("if", more),)))
            other = body("endif")[0] if end == "else" else ("body", ())
            return ("if", test, inside, other)
        if word == "set":
            name = p.name()
            p.need("=")
            return ("set", name, p.done(p.expression()))
        if word == "generation":
            return ("generation", body("endgeneration")[0])
        raise TemplateError(f"there is no tag {word!r}")

    tree, _, _ = body()
    return tree


# -- folding -------------------------------------------------------------------


def _apply(node, values, filters):
    """The value of an operation on known values."""
    kind = node[0]
    if kind == "compare":
        return _COMPARE[node[1]](*values)
    if kind == "join":
        a, b = values
        if node[1] == "~" or isinstance(a, str) and node[1] == "+":
            return f"{_shown(a)}{_shown(b)}"
        if not (isinstance(a, int) and isinstance(b, int)):
            raise TemplateError("only whole numbers are added or divided")
        return a + b if node[1] == "+" else a - b if node[1] == "-" else a % b
    if kind == "filter":
        return filters[node[1]](*values)
    if kind == "test":
        return _TESTS[node[1]](*values)
    if kind == "not":
        return not values[0]
    if kind == "get":
        return _looked_up(*values)
    raise TemplateError(f"there is no {kind}")


def _parts(node) -> list:
    """The operands of an operation."""
    kind = node[0]
    if kind in ("compare", "join"):
        return [node[2], node[3]]
    if kind == "filter":
        return [node[2], *node[3]]
    return [node[2]] if kind == "test" else list(node[1:])


def _with_parts(node, parts):
    kind = node[0]
    if kind in ("compare", "join"):
        return (kind, node[1], *parts)
    if kind == "filter":
        return (kind, node[1], parts[0], tuple(parts[1:]))
    return (kind, node[1], *parts) if kind == "test" else (kind, *parts)


def fold(node, filters: Mapping[str, Callable] = FILTERS):
    """The tree with constant operations worked out, dead branches gone and texts joined."""
    kind = node[0]
    if kind in ("const", "name", "text"):
        return node
    if kind == "body":
        out: list = []
        for item in (fold(x, filters) for x in node[1]):
            if item[0] == "out" and item[1][0] == "const":
                item = ("text", _shown(item[1][1]))
            inner = item[1] if item[0] == "body" else (item,)
            for x in inner:
                if x[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + x[1])
                elif x != ("text", ""):
                    out.append(x)
        return ("body", tuple(out))
    if kind == "if":
        test, yes, no = (fold(x, filters) for x in node[1:])
        return (yes if test[1] else no) if test[0] == "const" else ("if", test, yes, no)
    if kind == "for":
        return ("for", node[1], fold(node[2], filters), fold(node[3], filters))
    if kind == "set":
        return ("set", node[1], fold(node[2], filters))
    if kind in ("out", "generation"):
        return (kind, fold(node[1], filters))
    if kind in ("and", "or", "choose"):
        parts = [fold(x, filters) for x in node[1:]]
        if parts[0][0] != "const":
            return (kind, *parts)
        known = bool(parts[0][1])
        if kind == "choose":
            return parts[1] if known else parts[2]
        return parts[1] if known == (kind == "and") else parts[0]
    if kind == "filter" and node[1] not in filters:
        raise TemplateError(f"there is no filter {node[1]!r}")
    parts = [fold(x, filters) for x in _parts(node)]
    if all(p[0] == "const" for p in parts):
        return ("const", _apply(node, [p[1] for p in parts], filters))
    return _with_parts(node, parts)


# -- closures ------------------------------------------------------------------


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _looked_up(value, key):
    """An entry of a mapping or a sequence; none where there is none."""
    if isinstance(key, str) and key.startswith("_"):
        raise TemplateError(f"the name {key!r} is refused")
    if isinstance(value, Mapping):
        return value.get(key)
    if isinstance(value, Sequence) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    return None


def _value(node, filters) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, v=node[1]: v
    if kind == "name":
        return lambda env, n=node[1]: env.get(n)
    parts = [_value(x, filters) for x in _parts(node)] if kind not in ("and", "or", "choose") else [
        _value(x, filters) for x in node[1:]
    ]
    if kind == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if kind == "or":
        return lambda env: parts[0](env) or parts[1](env)
    if kind == "choose":
        return lambda env: parts[1](env) if parts[0](env) else parts[2](env)
    if kind == "get":
        return lambda env: _looked_up(parts[0](env), parts[1](env))
    if kind == "filter" and len(parts) == 1:
        call = filters[node[1]]
        return lambda env: call(parts[0](env))
    return lambda env: _apply(node, [p(env) for p in parts], filters)


def _writer(node, filters, learned: bool) -> Callable[[dict], Iterator[Piece]]:
    kind = node[0]
    if kind == "text":
        fixed = ((node[1], learned),)
        return lambda env: iter(fixed)
    if kind == "out":
        value = _value(node[1], filters)
        return lambda env: iter(((_shown(value(env)), learned),))
    if kind == "generation":
        return _writer(node[1], filters, True)
    if kind == "set":
        value = _value(node[2], filters)

        def assign(env):
            env[node[1]] = value(env)
            return iter(())

        return assign
    if kind == "if":
        test = _value(node[1], filters)
        yes, no = _writer(node[2], filters, learned), _writer(node[3], filters, learned)
        return lambda env: yes(env) if test(env) else no(env)
    if kind == "for":
        over, inner, name = _value(node[2], filters), _writer(node[3], filters, learned), node[1]

        def loop(env):
            rest = iter(over(env) or ())
            ahead = next(rest, _NOTHING)
            number = 0
            while ahead is not _NOTHING:
                item, ahead = ahead, next(rest, _NOTHING)
                number += 1
                place = {"index": number, "index0": number - 1, "first": number == 1, "last": ahead is _NOTHING}
                yield from inner({**env, name: item, "loop": place})

        return loop
    writers = [_writer(x, filters, learned) for x in node[1]]

    def run(env):
        for w in writers:
            yield from w(env)

    return run


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function from named values to the pieces (text, learned) of the rendering."""
    known = {**FILTERS, **(filters or {})}
    write = _writer(fold(parse(source), known), known, False)
    return lambda **values: write(dict(values))
