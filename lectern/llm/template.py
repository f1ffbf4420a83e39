"""A small template language: syntax tree, constant folding, Python closures.

    {{ expression }}   {% for x in expression %} .. {% endfor %}   {# comment #}
    {% if expression %} .. {% elif expression %} .. {% else %} .. {% endif %}
    {% set name = expression %}   {% generation %} .. {% endgeneration %}

Expressions have strings, integers, true, false, none, names, ``a.b``, ``a['b']``,
``+ ~ == != < > in not and or``, and filters after ``|``.  Inside a loop, ``loop.first``,
``loop.last`` and ``loop.index`` are set.  A dash next to a tag's bracket strips white space there.

Templates are data, not code: a name is looked up in the given values only, ``a.b`` reads a
key of a mapping and nothing else, nothing can be called except the named filters, and
a loop runs over given values.  A mistake in a template raises ``TemplateError``.

A compiled template is a function of its values that yields (text, generated)
fragments in order; a value that is an iterator is read as the fragments are, so
a conversation of any length is rendered in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

Fragments = Iterator[tuple[str, bool]]


class TemplateError(ValueError):
    """The template cannot be parsed, or asks for something that it may not have."""


# Syntax tree.


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
    """An operator or a filter on its operands."""

    name: str
    operands: tuple


@dataclass
class Text:
    text: str


@dataclass
class Output:
    value: object


@dataclass
class Loop:
    name: str
    over: object
    body: list


@dataclass
class Choice:
    branches: list  # (condition, body); the last condition may be Const(True)


@dataclass
class Assign:
    name: str
    value: object


@dataclass
class Generation:
    body: list


OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "~": lambda a, b: shown(a) + shown(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "in": lambda a, b: a in b,
    "not": lambda a: not a,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda v: shown(v).strip(),
    "upper": lambda v: shown(v).upper(),
    "lower": lambda v: shown(v).lower(),
    "length": len,
}


def shown(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# Parsing.

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)|(==|!=|[-+~<>|.()\[\],=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


@dataclass
class _Tokens:
    source: str
    items: list = field(default_factory=list)
    at: int = 0

    def __post_init__(self):
        place, end = 0, len(self.source.rstrip())
        while place < end:
            m = _TOKEN.match(self.source, place)
            if not m:
                raise TemplateError(f"unexpected text in tag: {self.source[place:]!r}")
            self.items.append((("int", "str", "name", "op")[m.lastindex - 1], m[m.lastindex]))
            place = m.end()

    def peek(self) -> str | None:
        return self.items[self.at][1] if self.at < len(self.items) and self.items[self.at][0] != "str" else None

    def next(self) -> tuple[str, str]:
        if self.at >= len(self.items):
            raise TemplateError(f"tag ends early: {self.source!r}")
        self.at += 1
        return self.items[self.at - 1]

    def take(self, word: str) -> bool:
        if self.peek() == word:
            self.at += 1
            return True
        return False

    def need(self, word: str) -> None:
        if not self.take(word):
            raise TemplateError(f"expected {word!r} in {self.source!r}")

    def name(self) -> str:
        kind, value = self.next()
        if kind != "name":
            raise TemplateError(f"expected a name in {self.source!r}")
        return value

    def done(self) -> None:
        if self.at < len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r} in {self.source!r}")

    # Each level of binding power has a rule, the loosest first.
    def expression(self):
        left = self.conjunction()
        while self.take("or"):
            left = Apply("or", (left, self.conjunction()))
        return left

    def conjunction(self):
        left = self.negation()
        while self.take("and"):
            left = Apply("and", (left, self.negation()))
        return left

    def negation(self):
        return Apply("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        left = self.sum()
        if self.peek() == "not":
            self.at += 1
            self.need("in")
            return Apply("not", (Apply("in", (left, self.sum())),))
        if self.peek() in ("==", "!=", "<", ">", "in"):
            return Apply(self.next()[1], (left, self.sum()))
        return left

    def sum(self):
        left = self.filtered()
        while self.peek() in ("+", "~"):
            left = Apply(self.next()[1], (left, self.filtered()))
        return left

    def filtered(self):
        value = self.primary()
        while self.take("|"):
            value = Apply("|" + self.name(), (value,))
        return value

    def primary(self):
        kind, word = self.next()
        if kind == "int":
            value = Const(int(word))
        elif kind == "str":
            value = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif word == "(":
            value = self.expression()
            self.need(")")
        elif kind == "name":
            known = {"true": True, "false": False, "none": None}
            value = Const(known[word]) if word in known else Name(word)
        else:
            raise TemplateError(f"unexpected {word!r} in {self.source!r}")
        while True:
            if self.take("."):
                value = Item(value, Const(self.name()))
            elif self.take("["):
                value = Item(value, self.expression())
                self.need("]")
            else:
                return value


def parse(source: str) -> list:
    """Syntax tree of a template."""
    root: list = []
    stack: list[tuple[str, list]] = [("", root)]
    choices: list[Choice] = []
    place, strip_next = 0, False
    for m in [*_TAG.finditer(source), None]:
        text = source[place : m.start()] if m else source[place:]
        if strip_next:
            text = text.lstrip()
        dashes = [m[k] for k in (1, 4, 7)] if m else []
        if any(dashes):
            text = text.rstrip()
        if text:
            stack[-1][1].append(Text(text))
        if m is None:
            break
        place, strip_next = m.end(), any(m[k] for k in (3, 6, 8))
        if m[2] is not None:
            tokens = _Tokens(m[2])
            stack[-1][1].append(Output(tokens.expression()))
            tokens.done()
        elif m[5] is not None:
            _statement(_Tokens(m[5]), stack, choices)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} is not ended")
    return root


def _statement(tokens: _Tokens, stack: list, choices: list) -> None:
    word, body = tokens.name(), stack[-1][1]
    if word == "for":
        name = tokens.name()
        tokens.need("in")
        node = Loop(name, tokens.expression(), [])
        body.append(node)
        stack.append(("for", node.body))
    elif word == "if":
        node = Choice([(tokens.expression(), [])])
        body.append(node)
        choices.append(node)
        stack.append(("if", node.branches[0][1]))
    elif word in ("elif", "else"):
        if stack[-1][0] != "if":
            raise TemplateError(f"{word!r} outside of 'if'")
        branch = (tokens.expression() if word == "elif" else Const(True), [])
        choices[-1].branches.append(branch)
        stack[-1] = ("if" if word == "elif" else "if-else", branch[1])
    elif word == "set":
        name = tokens.name()
        tokens.need("=")
        body.append(Assign(name, tokens.expression()))
    elif word == "generation":
        node = Generation([])
        body.append(node)
        stack.append(("generation", node.body))
    elif word.startswith("end") and stack[-1][0].split("-")[0] == word[3:] != "":
        stack.pop()
        if word == "endif":
            choices.pop()
    else:
        raise TemplateError(f"unexpected tag {word!r}")
    tokens.done()


# Folding.


def fold(nodes: list, filters: Mapping[str, Callable]) -> list:
    """The same tree with constant parts computed: joined texts, decided branches."""
    out: list = []
    for node in nodes:
        if isinstance(node, Output):
            value = _fold(node.value, filters)
            new = [Text(shown(value.value))] if isinstance(value, Const) else [Output(value)]
        elif isinstance(node, Loop):
            new = [Loop(node.name, _fold(node.over, filters), fold(node.body, filters))]
        elif isinstance(node, Assign):
            new = [Assign(node.name, _fold(node.value, filters))]
        elif isinstance(node, Generation):
            new = [Generation(fold(node.body, filters))]
        elif isinstance(node, Choice):
            branches = []
            for condition, body in node.branches:
                condition = _fold(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(body, filters)))
                if isinstance(condition, Const):
                    break
            decided = branches and isinstance(branches[0][0], Const)
            new = branches[0][1] if decided else [Choice(branches)] if branches else []
        else:
            new = [node]
        for n in new:
            if isinstance(n, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + n.text)
            elif not (isinstance(n, Text) and not n.text):
                out.append(n)
    return out


def _fold(e, filters: Mapping[str, Callable]):
    if isinstance(e, Item):
        e = Item(_fold(e.of, filters), _fold(e.key, filters))
    elif isinstance(e, Apply):
        e = Apply(e.name, tuple(_fold(x, filters) for x in e.operands))
        if e.name in ("and", "or") and isinstance(e.operands[0], Const):
            return e.operands[bool(e.operands[0].value) == (e.name == "and")]
        if all(isinstance(x, Const) for x in e.operands):
            return Const(_value(e, filters)({}))
    return e


# Closures.


def _value(e, filters: Mapping[str, Callable]) -> Callable[[Mapping], object]:
    if isinstance(e, Const):
        return lambda env, v=e.value: v
    if isinstance(e, Name):

        def lookup(env, name=e.name):
            if name not in env:
                raise TemplateError(f"unknown name {name!r}")
            return env[name]

        return lookup
    if isinstance(e, Item):
        of, key = _value(e.of, filters), _value(e.key, filters)

        def item(env):
            owner, k = of(env), key(env)
            if isinstance(owner, Mapping):
                return owner.get(k)
            if isinstance(owner, (list, tuple)) and isinstance(k, int):
                return owner[k] if k < len(owner) else None
            raise TemplateError(f"{k!r} can be read of mappings and lists only")

        return item
    parts = [_value(x, filters) for x in e.operands]
    if e.name == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if e.name == "or":
        return lambda env: parts[0](env) or parts[1](env)
    known = filters if e.name[0] == "|" else OPERATORS
    name = e.name.removeprefix("|")
    if name not in known:
        raise TemplateError(f"unknown filter {name!r}")
    f = known[name]

    def apply(env):
        try:
            return f(*(p(env) for p in parts))
        except TypeError as error:
            raise TemplateError(f"{name!r} does not take such a value") from error

    return apply


def _body(nodes: list, filters, generated: bool) -> Callable[[dict], Fragments]:
    steps = [_step(n, filters, generated) for n in nodes]

    def run(env):
        for step in steps:
            yield from step(env)

    return steps[0] if len(steps) == 1 else run


def _step(node, filters, generated: bool) -> Callable[[dict], Fragments]:
    if isinstance(node, Text):
        whole = ((node.text, generated),)
        return lambda env: iter(whole)
    if isinstance(node, Output):
        value = _value(node.value, filters)

        def output(env):
            text = shown(value(env))
            if text:
                yield text, generated

        return output
    if isinstance(node, Generation):
        return _body(node.body, filters, True)
    if isinstance(node, Assign):
        value = _value(node.value, filters)

        def assign(env):
            env[node.name] = value(env)
            return iter(())

        return assign
    if isinstance(node, Choice):
        branches = [(_value(c, filters), _body(b, filters, generated)) for c, b in node.branches]

        def choose(env):
            for condition, body in branches:
                if condition(env):
                    return body(env)
            return iter(())

        return choose
    over, body = _value(node.over, filters), _body(node.body, filters, generated)

    def loop(env):
        values = over(env)
        if not isinstance(values, Iterable) or isinstance(values, (str, Mapping)):
            raise TemplateError("a loop needs a list")
        inner, index = dict(env), 0
        for value, last in _with_last(values):
            index += 1
            inner[node.name] = value
            inner["loop"] = {"first": index == 1, "last": last, "index": index}
            yield from body(inner)

    return loop


def _with_last(values: Iterable) -> Iterator[tuple[object, bool]]:
    rest = iter(values)
    for value in rest:
        break
    else:
        return
    for following in rest:
        yield value, False
        value = following
    yield value, True


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[Mapping], Fragments]:
    """Function from values to (text, generated) fragments; ``filters`` adds to the built-in ones."""
    known = {**FILTERS, **(filters or {})}
    body = _body(fold(parse(source), known), known, False)
    return lambda values: body(dict(values))
