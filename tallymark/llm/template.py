"""A sandboxed template language for conversations: parsed to a syntax tree, folded, and compiled to closures.

Outputs are ``{{ expression }}``, statements ``{% if %} {% elif %} {% else %} {% endif %}``, ``{% for x in y %}
{% endfor %}``, ``{% set x = y %}`` and ``{% generation %} {% endgeneration %}``, which marks the text between as written
by the model; ``{# #}`` is a comment, and a minus sign inside a delimiter trims the white space beyond it. Expressions are
strings, whole numbers, ``true``, ``false``, ``none``, names, ``a.b``, ``a["b"]``, ``x | filter``, ``not``, ``and``, ``or``,
comparisons, ``in``, ``+``, ``-``, ``~`` and ``x if c else y``.

The sandbox is what the language lacks: no calls, no attributes of Python objects (``a.b`` reads a key of a mapping), only
the filters given to the compiler, loops over lists only, and no statement that does not end.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any


class TemplateError(ValueError):
    pass


# --- syntax tree ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """A pure function of its arguments: an operator or a filter."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Choice:
    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Logic:
    """``left and right`` or ``left or right``: the right side counts if the left side does not decide."""

    decided_by: bool
    left: Any
    right: Any


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


def children(node: Any) -> Iterator[Any]:
    if isinstance(node, tuple):
        yield from node
    else:
        for value in vars(node).values():
            if isinstance(value, tuple) or hasattr(value, "__dataclass_fields__"):
                yield value


def names_in(node: Any) -> set[str]:
    """All variables that a part of the tree reads."""
    found = {node.name} if isinstance(node, Name) else set()
    return found.union(*[names_in(c) for c in children(node)])


# --- parser --------------------------------------------------------------------------------------

_PIECES = re.compile(r"\{\{-?|\{%-?|\{#")
_TOKEN = re.compile(
    r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]-])|(?P<set>=))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_CLOSERS = {"{{": "}}", "{%": "%}", "{#": "#}"}
_WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
_RESERVED = {"and", "or", "not", "in", "if", "else", "elif", "for", "set", "endif", "endfor", "generation", "endgeneration"}


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """(kind, content): text, ``{{`` or ``{%``."""
    at, trim = 0, False
    while at <= len(source):
        found = _PIECES.search(source, at)
        text = source[at : found.start()] if found else source[at:]
        if trim:
            text = text.lstrip()
        if found and found[0].endswith("-"):
            text = text.rstrip()
        if text:
            yield "text", text
        if not found:
            return
        kind = found[0][:2]
        end = _closer(source, found.end(), kind)
        content = source[found.end() : end]
        trim = content.endswith("-") and kind != "{#"
        if kind != "{#":
            yield kind, content[:-1] if trim else content
        at = end + 2


def _closer(source: str, at: int, kind: str) -> int:
    """Where a tag ends; what strings hold does not count."""
    pattern = re.compile(r""""(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|""" + re.escape(_CLOSERS[kind]), re.S)
    if kind == "{#":
        pattern = re.compile(re.escape(_CLOSERS[kind]))
    for found in pattern.finditer(source, at):
        if found[0] == _CLOSERS[kind]:
            return found.start()
    raise TemplateError(f"{kind} is never closed")


class _Expression:
    """Tokens of one tag, read by precedence."""

    def __init__(self, source: str, filters: Iterable[str]):
        self.source, self.filters, self.tokens, self.at = source, set(filters), [], 0
        at, end = 0, len(source.rstrip())
        while at < end:
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "string" else text

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing in {self.source.strip()!r}")

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, "")
        if kind != "name" or text in _RESERVED or text in _WORDS:
            raise TemplateError(f"a name is missing in {self.source.strip()!r}")
        self.at += 1
        return text

    def end(self) -> None:
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source.strip()!r}")

    def whole(self) -> Any:
        node = self.choice()
        self.end()
        return node

    def choice(self) -> Any:
        node = self.either()
        if self.take("if"):
            test = self.either()
            return Choice(test, node, self.choice() if self.take("else") else Const(""))
        return node

    def either(self) -> Any:
        node = self.both()
        while self.take("or"):
            node = Logic(True, node, self.both())
        return node

    def both(self) -> Any:
        node = self.negation()
        while self.take("and"):
            node = Logic(False, node, self.negation())
        return node

    def negation(self) -> Any:
        return Apply("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Any:
        node = self.sum()
        if op := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            return Apply(op, (node, self.sum()))
        if self.take("not"):
            self.need("in")
            return Apply("not", (Apply("in", (node, self.sum())),))
        return node

    def sum(self) -> Any:
        node = self.filtered()
        while op := self.take("+", "-", "~"):
            node = Apply(op, (node, self.filtered()))
        return node

    def filtered(self) -> Any:
        node = self.part()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            node = Apply("|" + name, (node,))
        return node

    def part(self) -> Any:
        node = self.atom()
        while op := self.take(".", "["):
            if op == ".":
                node = Item(node, Const(self.name()))
            else:
                node = Item(node, self.choice())
                self.need("]")
        return node

    def atom(self) -> Any:
        if self.at >= len(self.tokens):
            raise TemplateError(f"an expression is missing in {self.source.strip()!r}")
        kind, text = self.tokens[self.at]
        if kind == "string":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), text[1:-1], flags=re.S))
        if kind == "int":
            self.at += 1
            return Const(int(text))
        if self.take("-"):
            if self.at < len(self.tokens) and self.tokens[self.at][0] == "int":
                self.at += 1
                return Const(-int(self.tokens[self.at - 1][1]))
            raise TemplateError(f"a number is missing in {self.source.strip()!r}")
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if text in _WORDS:
            self.at += 1
            return Const(_WORDS[text])
        return Name(self.name())


class _Parser:
    def __init__(self, source: str, filters: Iterable[str]):
        self.pieces, self.filters, self.at = list(_pieces(source)), list(filters), 0

    def nodes(self, inside: Sequence[str] = (), marked: bool = False) -> tuple[tuple, str, _Expression | None]:
        """Nodes up to one of the closing words, with that word and the rest of its tag."""
        out: list[Any] = []
        while self.at < len(self.pieces):
            kind, content = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                out.append(Output(Const(content)))
                continue
            tag = _Expression(content, self.filters)
            if kind == "{{":
                out.append(Output(tag.whole()))
                continue
            word = tag.take("if", "for", "set", "generation", "elif", "else", "endif", "endfor", "endgeneration")
            if word in inside:
                return tuple(out), word, tag
            if word == "if":
                out.append(self.condition(tag, marked))
            elif word == "for":
                name = tag.name()
                tag.need("in")
                over = tag.whole()
                body, _, last = self.nodes(("endfor",), marked)
                last.end()
                out.append(For(name, over, body))
            elif word == "set":
                name = tag.name()
                tag.need("=")
                out.append(Set(name, tag.whole()))
            elif word == "generation" and not marked:
                tag.end()
                body, _, last = self.nodes(("endgeneration",), True)
                last.end()
                out.append(Generation(body))
            else:
                raise TemplateError(f"unexpected {content.strip()!r}")
        if inside:
            raise TemplateError(f"{inside[-1]} is missing")
        return tuple(out), "", None

    def condition(self, tag: _Expression, marked: bool) -> If:
        test = tag.whole()
        yes, word, rest = self.nodes(("elif", "else", "endif"), marked)
        no: tuple = ()
        if word == "elif":
            return If(test, yes, (self.condition(rest, marked),))
        rest.end()
        if word == "else":
            no, _, last = self.nodes(("endif",), marked)
            last.end()
        return If(test, yes, no)


def parse(source: str, filters: Iterable[str] = ()) -> tuple:
    return _Parser(source, filters).nodes()[0]


# --- meaning of operators, folding ---------------------------------------------------------------


def shown(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str | int):
        return str(value)
    raise TemplateError(f"cannot print {type(value).__name__}")


def item(of: Any, key: Any) -> Any:
    """A key of a mapping or a place of a list; nothing else of an object can be reached."""
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, list) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"{type(of).__name__} has no items")


_OPERATORS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda a, b: a in b, "not": operator.not_, "+": operator.add, "-": operator.sub, "~": lambda a, b: shown(a) + shown(b),
}

Filters = Mapping[str, Callable[[Any], Any]]
FILTERS: Filters = {
    "trim": lambda s: shown(s).strip(), "upper": lambda s: shown(s).upper(), "lower": lambda s: shown(s).lower(),
    "length": len, "string": shown,
}


def meaning(name: str, filters: Filters) -> Callable:
    return filters[name[1:]] if name.startswith("|") else _OPERATORS[name]


def fold(node: Any, filters: Filters) -> Any:
    """The same tree with constant parts worked out: expressions, conditions and neighbouring texts."""
    if isinstance(node, tuple):
        out: list[Any] = []
        for child in node:
            child = fold(child, filters)
            if isinstance(child, If) and isinstance(child.test, Const):
                new = list(child.yes if child.test.value else child.no)
            else:
                new = [child]
            for n in new:
                if isinstance(n, Output) and isinstance(n.value, Const):
                    n = Output(Const(shown(n.value.value)))
                    if n.value.value == "":
                        continue
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                        n = Output(Const(out.pop().value.value + n.value.value))
                out.append(n)
        return tuple(out)
    if isinstance(node, Const | Name):
        return node
    if isinstance(node, Apply):
        args = fold_all(node.args, filters)
        if all(isinstance(a, Const) for a in args):
            return Const(meaning(node.name, filters)(*[a.value for a in args]))
        return Apply(node.name, args)
    if isinstance(node, Choice):
        test = fold(node.test, filters)
        if isinstance(test, Const):
            return fold(node.yes if test.value else node.no, filters)
        return Choice(test, fold(node.yes, filters), fold(node.no, filters))
    if isinstance(node, Logic):
        left, right = fold(node.left, filters), fold(node.right, filters)
        if isinstance(left, Const):
            return left if bool(left.value) == node.decided_by else right
        return Logic(node.decided_by, left, right)
    parts = {k: fold(v, filters) if isinstance(v, tuple) or hasattr(v, "__dataclass_fields__") else v for k, v in vars(node).items()}
    return type(node)(**parts)


def fold_all(nodes: Iterable[Any], filters: Filters) -> tuple:
    return tuple(fold(n, filters) for n in nodes)


# --- closures ------------------------------------------------------------------------------------


class Sink:
    """Text written so far, its length, and the spans written by the model, in code points."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    def text(self) -> str:
        return "".join(self.parts)


Env = dict[str, Any]
Value = Callable[[Env], Any]
Step = Callable[[Env, Sink], None]


def value_of(node: Any, filters: Filters) -> Value:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        return lambda env, n=node.name: env.get(n)
    if isinstance(node, Item):
        of, key = value_of(node.of, filters), value_of(node.key, filters)
        return lambda env: item(of(env), key(env))
    if isinstance(node, Choice):
        test, yes, no = (value_of(n, filters) for n in (node.test, node.yes, node.no))
        return lambda env: yes(env) if test(env) else no(env)
    if isinstance(node, Logic):
        left, right = value_of(node.left, filters), value_of(node.right, filters)

        def decide(env: Env, by: bool = node.decided_by) -> Any:
            value = left(env)
            return value if bool(value) == by else right(env)

        return decide
    act, args = meaning(node.name, filters), [value_of(a, filters) for a in node.args]
    if len(args) == 1:
        return lambda env, a=args[0]: act(a(env))
    return lambda env, a=args[0], b=args[1]: act(a(env), b(env))


def step_of(node: Any, filters: Filters) -> Step:
    if isinstance(node, tuple):
        steps = [step_of(n, filters) for n in node]

        def run_all(env: Env, sink: Sink) -> None:
            for step in steps:
                step(env, sink)

        return steps[0] if len(steps) == 1 else run_all
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            return lambda env, sink, t=shown(node.value.value): sink.write(t)
        value = value_of(node.value, filters)
        return lambda env, sink: sink.write(shown(value(env)))
    if isinstance(node, If):
        test, yes, no = value_of(node.test, filters), step_of(node.yes, filters), step_of(node.no, filters)
        return lambda env, sink: yes(env, sink) if test(env) else no(env, sink)
    if isinstance(node, Set):
        value = value_of(node.value, filters)
        return lambda env, sink, n=node.name: env.__setitem__(n, value(env))
    if isinstance(node, Generation):
        inner = step_of(node.body, filters)

        def mark(env: Env, sink: Sink) -> None:
            start = sink.length
            inner(env, sink)
            sink.spans.append((start, sink.length))

        return mark
    over, body = value_of(node.over, filters), step_of(node.body, filters)

    def loop(env: Env, sink: Sink) -> None:
        rows = over(env)
        if not isinstance(rows, list):
            raise TemplateError("loops go over lists only")
        for i, row in enumerate(rows):
            around = {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(rows) - 1}
            # What a round sets is gone after it.
            body({**env, node.name: row, "loop": around}, sink)

    return loop


class Template:
    """A compiled template. ``render`` takes the variables and returns the text and the spans written by the model.

    A template that has one loop over ``turns`` at its top, whose body reads only its own turn and what was set before, can be
    applied turn by turn: ``head``, ``turn`` and ``tail`` give the same text in parts. ``by_turn`` says so.
    """

    def __init__(self, source: str, turns: str = "messages", filters: Filters = FILTERS):
        self.tree = fold(parse(source, filters), filters)
        self._all = step_of(self.tree, filters)
        loops = [i for i, n in enumerate(self.tree) if isinstance(n, For) and n.over == Name(turns)]
        self.by_turn = False
        if len(loops) == 1:
            before, loop, after = self.tree[: loops[0]], self.tree[loops[0]], self.tree[loops[0] + 1 :]
            used = names_in(before) | names_in(loop.body) | names_in(after)
            self.by_turn = turns not in used and "loop" not in used
            self._head, self._body, self._tail = (step_of(n, filters) for n in (before, loop.body, after))
            self._name = loop.name

    def render(self, variables: Mapping[str, Any]) -> tuple[str, list[tuple[int, int]]]:
        sink = Sink()
        self._all(dict(variables), sink)
        return sink.text(), sink.spans

    def parts(self, variables: Mapping[str, Any]) -> tuple[Sink, Callable[[Any, Sink], None], Sink]:
        """What comes before the turns, how to write a turn, and what comes after them."""
        if not self.by_turn:
            raise TemplateError("this template needs the whole conversation at once")
        env, head, tail = dict(variables), Sink(), Sink()
        self._head(env, head)
        self._tail(dict(env), tail)
        return head, lambda turn, sink: self._body({**env, self._name: turn}, sink), tail

