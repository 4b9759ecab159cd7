"""Chat formatting: a compiler for a small sandboxed template language.

``{{ expression }}`` writes a value, ``{% for x in list %}``, ``{% if %}``/``{% elif %}``/``{% else %}``
and ``{% generation %}`` ... ``{% endgeneration %}`` nest. Expressions have names, fields
(``turn.role``), text and number literals, ``==``, ``!=``, ``and``, ``or``, ``not``, ``+``, brackets
and filters (``| escape``, ``| trim``, ``| upper``, ``| lower``). No attribute of a Python object, no call
and no index can be written, so a template reaches nothing but its data. The source is parsed into a
syntax tree, constants are folded (neighbouring texts joined, branches on constants decided), and each
node becomes a Python closure. Rendering gives the text and the character spans written under
``generation``, which are the loss mask.

``escape`` makes control strings inside a text harmless and can be undone: behind the first character of
a control string, with any number of backslashes already there, one more backslash is put; reading back
takes one away.

Rows of a conversation are ordered by turn, then role, then text (nulls first). Null texts and roles are
empty. All rows without conv_id are one conversation. A conversation is one output row by its nature; no
other group is gathered. Repeated rows are turns of their own; further columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import arrow_pass

CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
CHAT = (
    "{% for turn in turns %}<|im_start|>{{ turn.role | escape }}\n"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)


class TemplateError(ValueError):
    """The template isn't in the language."""


# --- escaping -------------------------------------------------------------------------------


@functools.lru_cache(maxsize=16)
def _patterns(control: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    ordered = sorted(control, key=len, reverse=True)
    raw = "|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in ordered)
    marked = "|".join(rf"{re.escape(c[0])}\\(?=\\*{re.escape(c[1:])})" for c in ordered)
    return re.compile(raw), re.compile(marked)


def escape(text: str, control: tuple[str, ...] = CONTROL) -> str:
    return _patterns(control)[0].sub(lambda m: m[0] + "\\", text)


def unescape(text: str, control: tuple[str, ...] = CONTROL) -> str:
    return _patterns(control)[1].sub(lambda m: m[0][0], text)


# --- syntax tree ----------------------------------------------------------------------------


@dataclass
class Const:
    value: object


@dataclass
class Name:
    path: tuple[str, ...]


@dataclass
class Apply:
    what: str
    args: list


@dataclass
class Write:
    value: object


@dataclass
class For:
    name: str
    over: object
    body: list = field(default_factory=list)


@dataclass
class If:
    branches: list  # (condition, body)


@dataclass
class Generation:
    body: list = field(default_factory=list)


TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[().|+]))")
PARTS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
FILTERS = ("escape", "trim", "upper", "lower")


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected text in expression: {source[at:at + 20]!r}")
        quoted, number, name, sign = m.groups()
        if quoted is not None:
            value = re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[0]), quoted[1:-1], flags=re.S)
            out.append(("const", value))
        elif number is not None:
            out.append(("const", int(number)))
        else:
            out.append(("name", name) if name else ("sign", sign))
        at = m.end()
    return out


class Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens, self.at = _tokens(source), 0

    def tree(self):
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def accept(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, part: Callable, *signs: str):
        left = part()
        while sign := self.accept(*signs):
            left = Apply(sign, [left, part()])
        return left

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.negated, "and")

    def negated(self):
        return Apply("not", [self.negated()]) if self.accept("not") else self.chain(self.added, "==", "!=")

    def added(self):
        return self.chain(self.filtered, "+")

    def filtered(self):
        value = self.primary()
        while self.accept("|"):
            name = self.accept(*FILTERS)
            if not name:
                raise TemplateError("unknown filter")
            value = Apply(name, [value])
        return value

    def primary(self):
        if self.accept("("):
            inner = self.either()
            if not self.accept(")"):
                raise TemplateError("missing )")
            return inner
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "const":
            return Const(value)
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false"):
            return Const(value == "true")
        path = [value]
        while self.accept("."):
            if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
                raise TemplateError("a field name must follow the dot")
            path.append(self.tokens[self.at][1])
            self.at += 1
        return Name(tuple(path))


def parse(source: str) -> list:
    """Syntax tree of a template."""
    root: list = []
    bodies, opened = [root], []
    for part in PARTS.split(source):
        if part.startswith("{{"):
            bodies[-1].append(Write(Expression(part[2:-2]).tree()))
        elif not part.startswith("{%"):
            if part:
                bodies[-1].append(Write(Const(part)))
        else:
            word, _, rest = part[2:-2].strip().partition(" ")
            if word == "for":
                name, sep, over = rest.partition(" in ")
                if not sep or not name.strip().isidentifier():
                    raise TemplateError(f"for needs a name and a list: {rest!r}")
                node = For(name.strip(), Expression(over).tree())
                body = node.body
            elif word == "if":
                body = []
                node = If([(Expression(rest).tree(), body)])
            elif word == "generation":
                node = Generation()
                body = node.body
            elif word in ("elif", "else"):
                if not opened or not isinstance(opened[-1], If):
                    raise TemplateError(f"{word} without if")
                body = []
                opened[-1].branches.append((Expression(rest).tree() if word == "elif" else Const(True), body))
                bodies[-1] = body
                continue
            elif word in ("endfor", "endif", "endgeneration"):
                kind = {"endfor": For, "endif": If, "endgeneration": Generation}[word]
                if not opened or not isinstance(opened[-1], kind):
                    raise TemplateError(f"{word} without its start")
                opened.pop()
                bodies.pop()
                continue
            else:
                raise TemplateError(f"unknown statement: {word!r}")
            bodies[-1].append(node)
            opened.append(node)
            bodies.append(body)
    if opened:
        raise TemplateError("a statement is not closed")
    return root


# --- folding --------------------------------------------------------------------------------


def _apply(what: str, args: list, control: tuple[str, ...]):
    if what == "escape":
        return escape(_shown(args[0]), control)
    if what in ("trim", "upper", "lower"):
        return getattr(_shown(args[0]), {"trim": "strip"}.get(what, what))()
    if what == "+":
        numbers = all(isinstance(a, int) and not isinstance(a, bool) for a in args)
        return args[0] + args[1] if numbers else _shown(args[0]) + _shown(args[1])
    return {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "not": lambda a: not a,
            "and": lambda a, b: a and b, "or": lambda a, b: a or b}[what](*args)


def _shown(value: object) -> str:
    if isinstance(value, (dict, list)):
        raise TemplateError("only texts and numbers can be written")
    return "" if value is None else str(value)


def fold(node, control: tuple[str, ...] = CONTROL):
    """The same tree with everything computed that needs no data."""
    if isinstance(node, list):
        out: list = []
        for x in (fold(x, control) for x in node):
            for y in x if isinstance(x, list) else [x]:
                both = out and isinstance(y, Write) and isinstance(out[-1], Write)
                if both and isinstance(y.value, Const) and isinstance(out[-1].value, Const):
                    out[-1] = Write(Const(_shown(out[-1].value.value) + _shown(y.value.value)))
                else:
                    out.append(y)
        return out
    if isinstance(node, Apply):
        args = [fold(a, control) for a in node.args]
        if all(isinstance(a, Const) for a in args):
            return Const(_apply(node.what, [a.value for a in args], control))
        return Apply(node.what, args)
    if isinstance(node, Write):
        return Write(fold(node.value, control))
    if isinstance(node, For):
        return For(node.name, fold(node.over, control), fold(node.body, control))
    if isinstance(node, Generation):
        return Generation(fold(node.body, control))
    if isinstance(node, If):
        kept = []
        for condition, body in node.branches:
            condition = fold(condition, control)
            if isinstance(condition, Const) and not condition.value:
                continue
            kept.append((condition, fold(body, control)))
            if isinstance(condition, Const):
                break
        if not kept:
            return []
        return kept[0][1] if isinstance(kept[0][0], Const) else If(kept)
    return node


# --- closures -------------------------------------------------------------------------------


def _value(node, control) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda data, v=node.value: v
    if isinstance(node, Name):

        def look(data, path=node.path):
            for key in path:
                if not isinstance(data, dict):
                    raise TemplateError(f"{'.'.join(path)}: nothing below a plain value")
                data = data.get(key)
            return data

        return look
    args = [_value(a, control) for a in node.args]
    if node.what in ("and", "or"):
        first, second = args
        if node.what == "and":
            return lambda data: first(data) and second(data)
        return lambda data: first(data) or second(data)
    return lambda data, what=node.what: _apply(what, [a(data) for a in args], control)


class Output:
    """Text so far, its length in characters, and the spans under the loss mask."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _writer(node, control) -> Callable[[dict, Output], None]:
    if isinstance(node, list):
        steps = [_writer(x, control) for x in node]

        def run(data, out):
            for step in steps:
                step(data, out)

        return run
    if isinstance(node, Write):
        if isinstance(node.value, Const):
            return lambda data, out, text=_shown(node.value.value): out.write(text)
        value = _value(node.value, control)
        return lambda data, out: out.write(_shown(value(data)))
    body = _writer(node.body, control) if not isinstance(node, If) else None
    if isinstance(node, For):
        over = _value(node.over, control)

        def loop(data, out, name=node.name):
            items = over(data) or []
            if not isinstance(items, list):
                raise TemplateError("only lists can be walked")
            for item in items:
                body({**data, name: item}, out)

        return loop
    if isinstance(node, Generation):

        def marked(data, out):
            start = out.length
            body(data, out)
            out.spans.append((start, out.length))

        return marked
    branches = [(_value(c, control), _writer(b, control)) for c, b in node.branches]

    def choose(data, out):
        for condition, run in branches:
            if condition(data):
                run(data, out)
                return

    return choose


@functools.lru_cache(maxsize=16)
def compile_template(source: str, control: tuple[str, ...] = CONTROL):
    """Function from turns to the formatted text and its loss spans."""
    run = _writer(fold(parse(source), control), control)

    def render(turns: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run({"turns": turns}, out)
        return "".join(out.parts), out.spans

    return render


TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(formatted: str, control: tuple[str, ...] = CONTROL) -> list[tuple[str, str]]:
    """Role and text of every turn, parsed from text that ``CHAT`` formatted.

    Control strings occur in it only as marks, as those inside texts are escaped, and line feeds of roles
    are written as ``line_role`` does.
    """
    return [(role_of_line(unescape(r, control)), unescape(t, control)) for r, t in TURN.findall(formatted)]


def line_role(role: str) -> str:
    """A role on one line: line feeds as ``\\n``, backslashes doubled."""
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def role_of_line(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def format_conversations(turns: DataFrame, template: str = CHAT, control: tuple[str, ...] = CONTROL) -> DataFrame:
    """Formatted text and loss spans (characters, end excluded) per conversation."""
    compile_template(template, control)  # errors show on the driver
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), "text")
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))

    def make(batch):
        render = compile_template(template, control)
        found = []
        for rows in batch.column(1).to_pylist():
            data = [{"role": line_role(r["role"]), "text": r["text"] or "", "turn": r["turn"]} for r in rows]
            found.append(render(data))
        spans = [[{"start": a, "end": b} for a, b in s] for _, s in found]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield {
            "conv_id": batch.column(0),
            "formatted": pa.array([t for t, _ in found], pa.string()),
            "loss_spans": pa.array(spans, kind),
        }

    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, formatted string, loss_spans array<struct<start:long,end:long>>"
    return arrow_pass(gathered, make, schema)
