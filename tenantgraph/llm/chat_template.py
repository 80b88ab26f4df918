"""Chat formatting: a compiler for a small sandboxed template language.

Source text is parsed into a syntax tree, constants are folded, and the tree becomes Python closures, generators that
yield (text, under_loss) as they go. Messages are pulled one by one, so a conversation of any length is rendered in
bounded memory, and the caller gets each turn's text when it is done.

Language: text; ``{{ expression }}``; ``{% if %} {% elif %} {% else %} {% endif %}``; ``{% for x in expression %}
{% endfor %}`` with loop.index, loop.index0, loop.first; ``{% set name = expression %}``; ``{% generation %}
{% endgeneration %}``, which marks what the loss is taken on; ``{# comment #}``; ``-`` inside a tag trims white space on
that side. Expressions: strings, integers, true, false, none, names, ``a.b`` and ``a['b']`` on mappings alone,
``== != < > <= >= in``, ``and or not``, ``+ - ~``, brackets, and filters from a fixed table. There are no calls and no
access to Python attributes, so a template can reach nothing but what it is given.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

Piece = tuple[str, bool]
_TAG = re.compile(r"\{\{-?|\{%-?|\{#")
_TOKEN = re.compile(r"\s*(?:(?P<num>\d+)|(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-<>+~|.()\[\]]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


class Escaper:
    """Makes control strings in texts harmless, reversibly: a backslash goes behind their first character, backslashes are doubled."""

    def __init__(self, controls: Iterable[str]):
        self.controls = tuple(sorted(set(controls), key=lambda x: (-len(x), x)))
        if any(len(x) < 2 or "\\" in x for x in self.controls):
            raise TemplateError("a control string has two characters at least and no backslash")
        if any(a[i:] == b[: len(a) - i] for a in self.controls for b in self.controls for i in range(1, len(a))):
            raise TemplateError("the end of a control string must not begin another")
        self._find = re.compile("|".join([r"\\", *map(re.escape, self.controls)]))

    def escape(self, text: str) -> str:
        return self._find.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)


# Syntax tree: tuples whose first field is the kind.


class _Expression:
    def __init__(self, source: str):
        self.source, self.at, self.tokens = source, 0, []
        end = len(source.rstrip())
        pos = 0
        while pos < end:
            if not (m := _TOKEN.match(source, pos)):
                raise TemplateError(f"unexpected {source[pos : pos + 10]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            pos = m.end()

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected in {self.source!r}")

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.summed()
        while op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
            tree = ("op", op, tree, self.summed())
        return tree

    def summed(self) -> tuple:
        tree = self.filtered()
        while op := self.take("+", "-", "~"):
            tree = ("op", op, tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.item()
        while self.take("|"):
            if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
                raise TemplateError("a filter's name expected")
            tree = ("filter", self.tokens[self.at][1], tree)
            self.at += 1
        return tree

    def item(self) -> tuple:
        if self.take("("):
            tree = self.either()
            self.need(")")
        elif self.at >= len(self.tokens):
            raise TemplateError(f"expression expected in {self.source!r}")
        else:
            kind, value = self.tokens[self.at]
            self.at += 1
            if kind == "num":
                tree = ("const", int(value))
            elif kind == "str":
                tree = ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
            elif kind == "name":
                tree = ("const", {"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else ("name", value)
            else:
                raise TemplateError(f"unexpected {value!r}")
        while op := self.take(".", "["):
            if op == "[":
                tree = ("get", tree, self.either())
                self.need("]")
            else:
                if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
                    raise TemplateError("a field's name expected")
                tree = ("get", tree, ("const", self.tokens[self.at][1]))
                self.at += 1
        return tree


def parse(source: str) -> tuple:
    """Template text to ("block", [nodes])."""
    parts: list[tuple[str, str]] = []
    pos, trim = 0, False
    while True:
        m = _TAG.search(source, pos)
        text = source[pos : m.start() if m else len(source)]
        text = text.lstrip() if trim else text
        if m and m[0].endswith("-"):
            text = text.rstrip()
        if text:
            parts.append(("text", text))
        if not m:
            break
        close = {"{{": "}}", "{%": "%}", "{#": "#}"}[m[0][:2]]
        end = m.end()
        quote = ""
        while end < len(source) and (quote or not source.startswith(close, end)):  # quotes may hold the closing signs
            c = source[end]
            if close != "#}" and c == "\\" and quote:
                end += 1
            elif close != "#}" and c in "'\"":
                quote = "" if c == quote else quote or c
            end += 1
        if end >= len(source):
            raise TemplateError(f"{close} expected")
        body = source[m.end() : end]
        trim = body.endswith("-")
        if close != "#}":
            parts.append(("print" if close == "}}" else "tag", body.rstrip("-").strip()))
        pos = end + 2
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes: list[tuple] = []
        while at < len(parts):
            kind, value = parts[at]
            at += 1
            if kind == "text":
                nodes.append(("text", value))
            elif kind == "print":
                nodes.append(("print", _Expression(value).whole()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("block", nodes), value
                if word == "if":
                    arms, test = [], rest
                    while True:
                        body, end = block("elif", "else", "endif")
                        arms.append((_Expression(test).whole() if test is not None else ("const", True), body))
                        if end == "endif":
                            break
                        if test is None:
                            raise TemplateError("else comes last")
                        test = end.partition(" ")[2] if end.startswith("elif") else None
                    nodes.append(("if", arms))
                elif word == "for":
                    if not (m := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)):
                        raise TemplateError("for needs a name and what it runs over")
                    body, _ = block("endfor")
                    nodes.append(("for", m[1], _Expression(m[2]).whole(), body))
                elif word == "set":
                    name, eq, value = rest.partition("=")
                    if not eq or not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                        raise TemplateError("set needs a name and a value")
                    nodes.append(("set", name.strip(), _Expression(value).whole()))
                elif word == "generation":
                    body, _ = block("endgeneration")
                    nodes.append(("generation", body))
                else:
                    raise TemplateError(f"unknown tag {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} expected")
        return ("block", nodes), ""

    return block()[0]


_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "+": lambda a, b: a + b, "-": lambda a, b: a - b, "~": lambda a, b: _show(a) + _show(b),
}


def _show(value: Any) -> str:
    return "" if value is None else str(value)


def fold(tree: Any, filters: Mapping[str, Callable]) -> Any:
    """Constants worked out ahead: operators and filters of constants, decided branches, runs of text."""
    if isinstance(tree, list):
        return [fold(x, filters) for x in tree]
    if not isinstance(tree, tuple) or tree[0] in ("const", "name", "text"):
        return tree
    tree = tuple(fold(x, filters) if isinstance(x, (tuple, list)) else x for x in tree)
    is_const = lambda x: isinstance(x, tuple) and x[0] == "const"
    if tree[0] == "filter" and tree[1] not in filters:
        raise TemplateError(f"unknown filter {tree[1]!r}")
    if tree[0] in ("op", "filter", "not") and all(is_const(x) for x in tree if isinstance(x, tuple)):
        values = [x[1] for x in tree if isinstance(x, tuple)]
        try:
            return ("const", not values[0] if tree[0] == "not" else (_OPS if tree[0] == "op" else filters)[tree[1]](*values))
        except TypeError as e:
            raise TemplateError(str(e)) from None
    if tree[0] in ("and", "or") and is_const(tree[1]):
        return tree[2] if bool(tree[1][1]) == (tree[0] == "and") else tree[1]
    if tree[0] == "print" and is_const(tree[1]):
        return ("text", _show(tree[1][1]))
    if tree[0] == "if":
        arms = []
        for test, body in tree[1]:
            if is_const(test) and not test[1]:
                continue
            arms.append((test, body))
            if is_const(test):
                break
        return ("block", []) if not arms else arms[0][1] if is_const(arms[0][0]) else ("if", arms)
    if tree[0] == "block":
        nodes: list[tuple] = []
        for x in tree[1]:
            for node in x[1] if x[0] == "block" else [x]:
                if node[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + node[1])
                elif node != ("text", ""):
                    nodes.append(node)
        return ("block", nodes)
    return tree


class Template:
    """render(**names) yields (text, under_loss)."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None):
        self.filters = {"trim": lambda x: _show(x).strip(" \t\n\x0b\x0c\r"), "upper": lambda x: _show(x).upper(), "lower": lambda x: _show(x).lower(), "length": len} | dict(filters or {})
        self.tree = fold(parse(source), self.filters)
        self._run = self._node(self.tree)

    def render(self, **names: Any) -> Iterator[Piece]:
        return self._run(dict(names), False)

    def _value(self, tree: tuple) -> Callable[[dict], Any]:
        kind = tree[0]
        if kind == "const":
            return lambda names, v=tree[1]: v
        if kind == "name":
            return lambda names, n=tree[1]: names.get(n)
        if kind == "get":
            of, key = self._value(tree[1]), self._value(tree[2])

            def get(names: dict) -> Any:
                held = of(names)
                return held.get(key(names)) if isinstance(held, dict) else None

            return get
        if kind == "filter":
            f, x = self.filters[tree[1]], self._value(tree[2])
            return lambda names: f(x(names))
        if kind == "not":
            x = self._value(tree[1])
            return lambda names: not x(names)
        a, b = self._value(tree[-2]), self._value(tree[-1])
        if kind == "and":
            return lambda names: a(names) and b(names)
        if kind == "or":
            return lambda names: a(names) or b(names)
        op = _OPS[tree[1]]
        return lambda names: op(a(names), b(names))

    def _node(self, tree: tuple) -> Callable[[dict, bool], Iterator[Piece]]:
        kind = tree[0]
        if kind == "text":

            def run(names: dict, loss: bool, text: str = tree[1]) -> Iterator[Piece]:
                yield text, loss
        elif kind == "print":
            value = self._value(tree[1])

            def run(names: dict, loss: bool) -> Iterator[Piece]:
                yield _show(value(names)), loss
        elif kind == "set":
            value = self._value(tree[2])

            def run(names: dict, loss: bool) -> Iterator[Piece]:
                names[tree[1]] = value(names)
                return iter(())
        elif kind == "generation":
            body = self._node(tree[1])

            def run(names: dict, loss: bool) -> Iterator[Piece]:
                return body(names, True)
        elif kind == "if":
            arms = [(self._value(test), self._node(body)) for test, body in tree[1]]

            def run(names: dict, loss: bool) -> Iterator[Piece]:
                for test, body in arms:
                    if test(names):
                        yield from body(names, loss)
                        return
        elif kind == "for":
            over, body = self._value(tree[2]), self._node(tree[3])

            def run(names: dict, loss: bool) -> Iterator[Piece]:
                for i, x in enumerate(over(names) or ()):
                    yield from body(names | {tree[1]: x, "loop": {"index": i + 1, "index0": i, "first": i == 0}}, loss)
        else:
            nodes = [self._node(x) for x in tree[1]]

            def run(names: dict, loss: bool) -> Iterator[Piece]:
                for node in nodes:
                    yield from node(names, loss)

        return run


#: Turns are marked by the role between two control strings; the assistant's text alone is under the loss.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = """{%- for message in messages -%}
{{ '<s>' }}{{ message.role | escape }}{{ '[INST]' }}
{%- if message.role == 'assistant' -%}{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else -%}{{ message.text | escape }}{%- endif -%}
{{ '[/INST]' }}{{ '</s>' }}
{%- endfor -%}"""


def formatter() -> tuple[Template, Escaper]:
    escaper = Escaper(CONTROLS)
    return Template(TEMPLATE, {"escape": escaper.escape}), escaper


class Reader:
    """Reads turns back from formatted text, piece by piece: what lies between control strings, unescaped."""

    def __init__(self, escaper: Escaper):
        self.escaper = escaper
        self._controls = re.compile("|".join(map(re.escape, escaper.controls)))
        self._rest = ""

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self._rest += text
        at = 0
        while (end := self._rest.find("</s>", at)) >= 0:
            marks = list(self._controls.finditer(self._rest, at, end))
            if [m[0] for m in marks] != ["<s>", "[INST]", "[/INST]"] or marks[0].start() != at or marks[2].end() != end:
                raise TemplateError("not a formatted turn")
            yield tuple(self.escaper.unescape(self._rest[marks[i].end() : marks[i + 1].start()]) for i in (0, 1))
            at = end + 4
        self._rest = self._rest[at:]

    def close(self) -> None:
        if self._rest:
            raise TemplateError("text after the last turn")
