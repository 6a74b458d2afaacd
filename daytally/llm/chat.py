"""Chat formatting by a compiler for a small, sandboxed template language.

A template is text with ``{{ expression }}`` and ``{% statement %}``. Statements: ``for … in …``,
``if``/``elif``/``else``, ``set``, ``generation`` (what it renders is marked for the loss), each
closed by its ``end…`` but ``set``. Expressions: literals, names, ``a.b`` and ``a['b']`` (keys of
mappings only), comparison, ``in``, ``and``, ``or``, ``not``, ``+``, ``~`` and ``| filter``.
There are no calls and no attributes of Python objects, so a template reaches its messages only.

The source is parsed into a syntax tree, constant parts are folded, and the tree becomes Python
closures. Rendering gives the text and the ranges that generation markers enclose.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TemplateError(ValueError):
    """The template's source is wrong, or it uses what a message does not have."""


# --- control strings inside texts ---


def escape(text: str) -> str:
    """Text in which no control string can stand: backslashes are doubled, ``<|`` becomes ``<\\|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """The same for one line: line breaks become backslash and n."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL) if "\\" in text else text


FILTERS: dict[str, Callable] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
    "length": len,
}

# --- syntax tree ---


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
    """An operator or filter with its operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    body: tuple
    other: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple




OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "~": lambda a, b: _shown(a) + _shown(b),
    "not": lambda a: not a,
}


def _shown(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- parsing ---

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+~|.()\[\]=]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(found.groups())
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        if self.at == len(self.tokens):
            return None
        text, number, name, sign = self.tokens[self.at]
        return name or sign or (number and "0") or '"'

    def take(self, *allowed: str) -> bool:
        if self.peek() in allowed:
            self.at += 1
            return True
        return False

    def need(self, sign: str) -> None:
        if not self.take(sign):
            raise TemplateError(f"expected {sign!r}")

    def name(self) -> str:
        found = self.tokens[self.at][2] if self.at < len(self.tokens) else None
        if not found or found in ("in", "and", "or", "not"):
            raise TemplateError("expected a name")
        self.at += 1
        return found

    def end(self) -> None:
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()!r}")

    def any(self):
        left = self.all()
        while self.take("or"):
            left = Apply("or", (left, self.all()))
        return left

    def all(self):
        left = self.negated()
        while self.take("and"):
            left = Apply("and", (left, self.negated()))
        return left

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        left = self.joined()
        while self.peek() in ("==", "!=", "<", "<=", ">", ">=", "in"):
            sign = self.peek()
            self.at += 1
            left = Apply(sign, (left, self.joined()))
        return left

    def joined(self):
        left = self.filtered()
        while self.peek() in ("+", "~"):
            sign = self.peek()
            self.at += 1
            left = Apply(sign, (left, self.filtered()))
        return left

    def filtered(self):
        left = self.single()
        while True:
            if self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                left = Apply("|" + name, (left,))
            elif self.take("."):
                left = Item(left, Const(self.name()))
            elif self.take("["):
                left = Item(left, self.any())
                self.need("]")
            else:
                return left

    def single(self):
        if self.take("("):
            inner = self.any()
            self.need(")")
            return inner
        if self.at == len(self.tokens):
            raise TemplateError("expected an expression")
        text, number, name, _ = self.tokens[self.at]
        if text:
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.DOTALL))
        if number:
            self.at += 1
            return Const(int(number))
        known = {"true": True, "false": False, "none": None}
        name = self.name()
        return Const(known[name]) if name in known else Name(name)


def parse(source: str) -> tuple:
    """Syntax tree of a template."""
    stack: list[tuple[str, list, object]] = [("", [], None)]

    def add(node) -> None:
        stack[-1][1].append(node)

    def close(kind: str) -> tuple[tuple, object]:
        if stack[-1][0] != kind:
            raise TemplateError(f"{kind!r} is not open here")
        _, body, extra = stack.pop()
        return tuple(body), extra

    at, strip = 0, False
    for tag in _TAG.finditer(source):
        text = source[at : tag.start()]
        text = text.lstrip() if strip else text
        text = text.rstrip() if tag[1] == "-" or tag[4] == "-" else text
        if text:
            add(Output(Const(text)))
        at, strip = tag.end(), tag[3] == "-" or tag[6] == "-"
        if tag[2] is not None:
            e = _Expression(tag[2])
            add(Output(e.any()))
            e.end()
        elif tag[5] is not None:
            e = _Expression(tag[5])
            word = e.name()
            if word == "for":
                name = e.name()
                e.need("in")
                stack.append(("for", [], (name, e.any())))
            elif word == "if":
                stack.append(("if", [], [(e.any(), None)]))
            elif word in ("elif", "else"):
                body, tests = close("if")
                tests[-1] = (tests[-1][0], body)
                tests.append((e.any() if word == "elif" else Const(True), None))
                stack.append(("if", [], tests))
            elif word == "set":
                name = e.name()
                e.need("=")
                add(Set(name, e.any()))
            elif word == "generation":
                stack.append(("generation", [], None))
            elif word == "endfor":
                body, (name, over) = close("for")
                add(For(name, over, body))
            elif word == "endif":
                body, tests = close("if")
                tests[-1] = (tests[-1][0], body)
                node: tuple = ()
                for test, inner in reversed(tests):
                    node = (If(test, inner, node),)
                add(node[0])
            elif word == "endgeneration":
                add(Generation(close("generation")[0]))
            else:
                raise TemplateError(f"no statement {word!r}")
            e.end()
    rest = source[at:].lstrip() if strip else source[at:]
    if rest:
        add(Output(Const(rest)))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} is not closed")
    return tuple(stack[0][1])


# --- folding ---


def fold_value(node):
    if isinstance(node, Item):
        return Item(fold_value(node.of), fold_value(node.key))
    if not isinstance(node, Apply):
        return node
    args = tuple(map(fold_value, node.args))
    if node.name in ("and", "or"):
        if isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
    elif all(isinstance(a, Const) for a in args):
        return Const(_function(node.name)(*(a.value for a in args)))
    return Apply(node.name, args)


def fold(body: tuple) -> tuple:
    """The same program with constants computed, dead branches removed and texts merged."""
    out: list = []
    for node in body:
        if isinstance(node, Output):
            found = [Output(fold_value(node.value))]
        elif isinstance(node, For):
            found = [For(node.name, fold_value(node.over), fold(node.body))]
        elif isinstance(node, If):
            test = fold_value(node.test)
            if isinstance(test, Const):
                found = list(fold(node.body if test.value else node.other))
            else:
                found = [If(test, fold(node.body), fold(node.other))]
        elif isinstance(node, Set):
            found = [Set(node.name, fold_value(node.value))]
        else:
            found = [Generation(fold(node.body))]
        for one in found:
            last = out[-1] if out else None
            both = (last, one)
            if all(isinstance(x, Output) and isinstance(x.value, Const) for x in both):
                out[-1] = Output(Const(_shown(last.value.value) + _shown(one.value.value)))
            else:
                out.append(one)
    return tuple(out)


# --- closures ---


def _function(name: str) -> Callable:
    return FILTERS[name[1:]] if name[0] == "|" else OPERATORS[name]


def compile_value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda names: value
    if isinstance(node, Name):
        name = node.name

        def look(names: dict):
            if name not in names:
                raise TemplateError(f"no name {name!r}")
            return names[name]

        return look
    if isinstance(node, Item):
        of, key = compile_value(node.of), compile_value(node.key)

        def item(names: dict):
            found, wanted = of(names), key(names)
            if not isinstance(found, dict) or wanted not in found:
                raise TemplateError(f"no item {wanted!r}")
            return found[wanted]

        return item
    args = [compile_value(a) for a in node.args]
    if node.name == "and":
        return lambda names: args[0](names) and args[1](names)
    if node.name == "or":
        return lambda names: args[0](names) or args[1](names)
    function = _function(node.name)
    if len(args) == 1:
        only = args[0]
        return lambda names: function(only(names))
    left, right = args
    return lambda names: function(left(names), right(names))


def compile_body(body: tuple) -> Callable[[dict, Sink], None]:
    steps = [compile_node(n) for n in body]
    if len(steps) == 1:
        return steps[0]

    def run(names: dict, out: Sink) -> None:
        for step in steps:
            step(names, out)

    return run


def compile_node(node) -> Callable[[dict, Sink], None]:
    if isinstance(node, Output):
        value = compile_value(node.value)
        return lambda names, out: out.write(_shown(value(names)))
    if isinstance(node, Set):
        name, value = node.name, compile_value(node.value)

        def put(names: dict, out: Sink) -> None:
            names[name] = value(names)

        return put
    if isinstance(node, If):
        test, body, other = compile_value(node.test), compile_body(node.body), compile_body(node.other)
        return lambda names, out: (body if test(names) else other)(names, out)
    if isinstance(node, Generation):
        inner = compile_body(node.body)

        def marked(names: dict, out: Sink) -> None:
            start = out.length
            inner(names, out)
            out.spans.append((start, out.length))

        return marked
    over, body, name = compile_value(node.over), compile_body(node.body), node.name

    def loop(names: dict, out: Sink) -> None:
        rows = over(names)
        if not isinstance(rows, list):
            raise TemplateError("only lists can be looped over")
        inside = dict(names)
        for i, row in enumerate(rows):
            inside[name] = row
            inside["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(rows) - 1}
            body(inside, out)

    return loop


class Sink:
    """Output under way: its parts, their length, and the marked ranges."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


class Template:
    """A compiled template. ``render`` gives the text and the ranges under generation markers."""

    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self.run = compile_body(self.tree)

    def render(self, **names) -> tuple[str, list[tuple[int, int]]]:
        out = Sink()
        self.run(dict(names), out)
        return "".join(out.parts), out.spans


# The control strings that mark turns.
START, END = "<|im_start|>", "<|im_end|>"
CHATML = (
    "{% for m in messages %}{{ '<|im_start|>' ~ (m.role | escape_line) ~ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '<|im_end|>' ~ '\\n' }}{% endfor %}"
)
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn, read back from formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def format_conversations(rows: DataFrame, template: str = CHATML) -> DataFrame:
    """conv_id, formatted text and the ranges of it under the loss mask, one row per conversation.

    Turns go by ``turn`` (null first), ties by role and text; a repeated row is a turn of its own.
    Null roles and texts are empty. A null conv_id is one conversation. A conversation is one
    value, so it has to fit in a task; nothing else is gathered.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))

    def render(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = Template(template)
        for column in columns:
            done = [compiled.render(messages=turns) for turns in column.to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.StructArray.from_arrays([pa.array([t for t, _ in done], pa.string()), pa.array(spans, kind)], names=["text", "loss"])

    made = F.arrow_udf(render, "text string, loss array<struct<start:long,end:long>>")("_turns")
    return whole.select("conv_id", made.alias("_made")).select("conv_id", "_made.text", "_made.loss")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of turns and loss text, both read back from the formatted text."""

    def digest(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, losses in columns:
            out = []
            for text, loss in zip(texts.to_pylist(), losses.to_pylist(), strict=True):
                turns = read_turns(text)
                learned = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                all_turns = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append({"n_turns": len(turns), "turns_sha256": _sha(all_turns), "loss_chars": len(learned), "loss_sha256": _sha(learned), "formatted_chars": len(text)})
            kind = pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            yield pa.array(out, kind)

    kind = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", F.arrow_udf(digest, kind)("text", "loss").alias("_d")).select("conv_id", "_d.*")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
