"""Chat formatting: a small sandboxed template language compiled to Python closures.

A template is parsed into a syntax tree, constant parts of the tree are folded, and every node
becomes a closure; nothing is evaluated as Python and an expression can reach nothing but the names
handed in. Rendering is a stream: a conversation is read message by message and comes out as pieces,
each marked as inside or outside of ``{% generation %}``, so its length never matters.

    {{ expression }}                    output
    {% for m in messages %}..{% endfor %}   with loop.first, loop.last, loop.index
    {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% set name = e %}                  {% generation %}..{% endgeneration %}

Expressions: strings, whole numbers, true, false, none, names, fields of a message (m.role, m.text),
+ and ~ (text joined), == and !=, not, and, or, parentheses, and the filters escape, trim, upper and
lower.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmatch.llm.common import arrow_settings, in_batches, rows_in_order, text_or_empty

#: Strings that mean something in the formatted text; inside role and text they are escaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}"
    "{{ '<s>[INST] ' + (m.role | escape) + ' [/INST] ' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '</s>' }}"
    "{% endfor %}"
)
#: Code points of one row of formatted text; a longer conversation is several rows.
PART_CHARS = 1 << 16

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|[()+~|.=]))")
_FIELDS = {"loop": ("first", "last", "index"), None: ("role", "text")}


class TemplateError(ValueError):
    pass


# ---- escaping -----------------------------------------------------------------------------------


@lru_cache(maxsize=8)
def _inside(controls: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls)]))


def escape(text: str, controls: tuple[str, ...] = CONTROLS) -> str:
    """No control string is left: a backslash is doubled, and one is put after the first character of each control string."""
    return _inside(controls).sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


# ---- syntax tree --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str
    field: str | None = None


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: str
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append(next((kind, v) for kind, v in zip(("number", "string", "name", "sign"), m.groups(), strict=True) if v is not None))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] in ("name", "sign") else None

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted:
            self.at += 1
            return True
        return False

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> object:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"left over: {self.tokens[self.at:]}")
        return tree

    def either(self) -> object:
        tree = self.both()
        while self.take("or"):
            tree = Op("or", (tree, self.both()))
        return tree

    def both(self) -> object:
        tree = self.negation()
        while self.take("and"):
            tree = Op("and", (tree, self.negation()))
        return tree

    def negation(self) -> object:
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> object:
        tree = self.joined()
        if (sign := self.peek()) in ("==", "!="):
            self.at += 1
            tree = Op(sign, (tree, self.joined()))
        return tree

    def joined(self) -> object:
        tree = self.filtered()
        while self.take("+", "~"):
            tree = Op("join", (tree, self.filtered()))
        return tree

    def filtered(self) -> object:
        tree = self.atom()
        while self.take("|"):
            if (name := self.name()) not in _FILTERS:
                raise TemplateError(f"no filter {name}")
            tree = Op(name, (tree,))
        return tree

    def atom(self) -> object:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        if kind == "sign":
            raise TemplateError(f"unexpected {value}")
        self.at += 1
        if kind == "number":
            return Const(int(value))
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.S))
        if value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        if self.take("."):
            field = self.name()
            if field not in _FIELDS.get(value, _FIELDS[None]):
                raise TemplateError(f"no field {value}.{field}")
            return Name(value, field)
        return Name(value)


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        parts += [("text", source[at : m.start()])] if m.start() > at else []
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", source[at:])] if at < len(source) else []
    body, end, rest = _body(parts, 0, ())
    return body


def _body(parts: list, at: int, ends: tuple[str, ...]) -> tuple[tuple, str | None, int]:
    nodes = []
    while at < len(parts):
        kind, value = parts[at]
        at += 1
        if kind == "text":
            nodes.append(Output(Const(value)))
        elif kind == "out":
            nodes.append(Output(_Expression(value).whole()))
        else:
            word, _, rest = value.partition(" ")
            if word in ends:
                return tuple(nodes), value, at
            if word == "for" and (m := re.fullmatch(r"(\w+)\s+in\s+(\w+)", rest.strip())):
                body, _, at = _body(parts, at, ("endfor",))
                nodes.append(For(m[1], m[2], body))
            elif word == "if":
                branches, condition = [], _Expression(rest).whole()
                while True:
                    body, end, at = _body(parts, at, ("elif", "else", "endif"))
                    branches.append((condition, body))
                    if end == "endif":
                        break
                    condition = Const(True) if end == "else" else _Expression(end[4:]).whole()
                nodes.append(If(tuple(branches)))
            elif word == "set" and (m := re.fullmatch(r"(\w+)\s*=(.*)", rest, re.S)):
                nodes.append(Set(m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                body, _, at = _body(parts, at, ("endgeneration",))
                nodes.append(Generation(body))
            else:
                raise TemplateError(f"unknown tag {value!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return tuple(nodes), None, at


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


_FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)),
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
}
_STRICT: dict[str, Callable] = _FILTERS | {
    "join": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "not": lambda a: not a,
}


# ---- folding ------------------------------------------------------------------------------------


def fold(node: object) -> object:
    """The tree with constant expressions computed, constant conditions decided and neighbouring constant output joined."""
    if isinstance(node, tuple):
        out: list = []
        for child in map(fold, node):
            if isinstance(child, tuple):  # a decided if
                out.extend(child)
            else:
                out.append(child)
        joined: list = []
        for child in out:
            const = isinstance(child, Output) and isinstance(child.value, Const)
            if const and joined and isinstance(joined[-1], Output) and isinstance(joined[-1].value, Const):
                joined[-1] = Output(Const(joined[-1].value.value + _text(child.value.value)))
            else:
                joined.append(Output(Const(_text(child.value.value))) if const else child)
        return tuple(joined)
    if isinstance(node, Op):
        args = tuple(map(fold, node.args))
        if node.kind in ("and", "or"):
            if isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (node.kind == "and") else args[0]
        elif all(isinstance(a, Const) for a in args):
            return Const(_STRICT[node.kind](*(a.value for a in args)))
        return Op(node.kind, args)
    if isinstance(node, (Output, Set)):
        return Output(fold(node.value)) if isinstance(node, Output) else Set(node.name, fold(node.value))
    if isinstance(node, For):
        return For(node.name, node.over, fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        branches = []
        for condition, body in node.branches:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            branches.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if not branches:
            return ()
        return branches[0][1] if isinstance(branches[0][0], Const) else If(tuple(branches))
    return node


# ---- closures -----------------------------------------------------------------------------------


def _value(node: object) -> Callable[[dict], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name, field = node.name, node.field
        return (lambda env: env.get(name)) if field is None else (lambda env: (env.get(name) or {}).get(field))
    args = [_value(a) for a in node.args]
    if node.kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.kind == "or":
        return lambda env: args[0](env) or args[1](env)
    function = _STRICT[node.kind]
    if len(args) == 1:
        only = args[0]
        return lambda env: function(only(env))
    left, right = args
    return lambda env: function(left(env), right(env))


def _emit(node: object, marked: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    if isinstance(node, tuple):
        children = [_emit(child, marked) for child in node]

        def body(env: dict) -> Iterator[tuple[str, bool]]:
            for child in children:
                yield from child(env)

        return body
    if isinstance(node, Output):
        value = _value(node.value)
        return lambda env: iter(((_text(value(env)), marked),))
    if isinstance(node, Set):
        name, value = node.name, _value(node.value)

        def put(env: dict) -> Iterator[tuple[str, bool]]:
            env[name] = value(env)
            return iter(())

        return put
    if isinstance(node, Generation):
        return _emit(node.body, True)
    if isinstance(node, If):
        branches = [(_value(condition), _emit(body, marked)) for condition, body in node.branches]

        def choose(env: dict) -> Iterator[tuple[str, bool]]:
            for condition, then in branches:
                if condition(env):
                    return then(env)
            return iter(())

        return choose
    name, over, inner = node.name, node.over, _emit(node.body, marked)

    def loop(env: dict) -> Iterator[tuple[str, bool]]:
        rows, outer = iter(env.get(over) or ()), (env.get(name), env.get("loop"))
        now, index = next(rows, None), 0
        while now is not None:
            following = next(rows, None)
            index += 1
            env[name], env["loop"] = now, {"first": index == 1, "last": following is None, "index": index}
            yield from inner(env)
            now = following
        env[name], env["loop"] = outer

    return loop


def compile_template(source: str) -> Callable[[Iterator[dict]], Iterator[tuple[str, bool]]]:
    """A function from messages ({role, text}) to pieces (text, whether inside a generation block)."""
    emit = _emit(fold(parse(source)), False)
    return lambda messages: emit({"messages": messages})


# ---- on Spark -----------------------------------------------------------------------------------


def render(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, formatted, loss) of ``conversations`` (conv_id, turn, role, text, ...).

    A conversation's formatted text is its parts one after another; ``loss`` holds the spans (begin,
    end, in code points of the part, ordered, adjacent ones not joined) under the loss mask, a span
    that goes on in the next part with ``open`` set. Turns come by number (null first), ties by role
    and text; repeated rows are repeated turns. Null role or text is empty; rows with a null conv_id
    are one conversation. Extra columns are ignored; an empty table gives an empty result.

    The parts of a conversation are neighbours, in order, in one partition. Its task streams, holding
    a message and a part at a time, so one conversation may be most of the table.
    """
    compile_template(template)  # errors show here, not in a task
    arrow_settings(conversations.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = compile_template(template)

        def parts() -> Iterator[tuple]:
            for conv_id, rows in groupby(rows_in_order(batches), key=lambda r: r[0]):
                pieces = function({"role": role, "text": text} for _, role, text in rows)
                yield from ((conv_id, *part) for part in _parts(pieces))

        yield from in_batches(parts(), _FIELDS_OUT, 200)

    slim = conversations.select("conv_id", "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    ordered = slim.withColumn("conv_id", F.col("conv_id").cast("long")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, part long, formatted string, loss array<struct<begin:bigint,end:bigint,open:boolean>>"
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema)


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("open", pa.bool_())])
_FIELDS_OUT = [("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(_SPAN))]


def _parts(pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[int, str, list[dict]]]:
    number, texts, spans, size = 0, [], [], 0
    for text, marked in pieces:
        while True:
            now, text = text[: PART_CHARS - size], text[PART_CHARS - size :]
            if marked:
                spans.append({"begin": size, "end": size + len(now), "open": bool(text)})
            texts.append(now)
            size += len(now)
            if size == PART_CHARS:
                yield number, "".join(texts), spans
                number, texts, spans, size = number + 1, [], [], 0
            if not text:
                break
    if size or not number:
        yield number, "".join(texts), spans


def messages_of(parts: Iterator[str], controls: tuple[str, ...] = CONTROLS) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read back from text in the form of ``TEMPLATE``; one turn is held at a time."""
    begin, end, before_role, after_role = controls
    head, mid = f"{begin}{before_role} ", f" {after_role} "
    held: list[str] = []
    tail = ""
    for part in parts:
        tail_and = tail + part
        if end not in tail_and:
            held.append(part)
            tail = (tail + part)[-len(end) :]
            continue
        whole = "".join(held) + part
        *turns, rest = whole.split(end)
        for turn in turns:
            role, _, text = turn.removeprefix(head).partition(mid)
            yield unescape(role), unescape(text)
        held, tail = [rest], rest[-len(end) :]
    if "".join(held):
        raise ValueError("the formatted text ends inside a turn")


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation what reading ``render``'s parts back gives: turns, text under the loss mask, and sizes.

    Works on the partitions of ``render`` as they are and streams: only one turn is held.
    """

    def digest(conv_id: int | None, rows: Iterator[tuple]) -> tuple:
        turns, loss, n_turns, loss_chars, size = sha256(), sha256(), 0, 0, 0

        def read() -> Iterator[str]:
            nonlocal loss_chars, size
            going = ""
            for _, _, text, spans in rows:
                size += len(text)
                for span in spans:
                    going += text[span["begin"] : span["end"]]
                    if not span["open"]:
                        plain, going = unescape(going), ""
                        loss_chars += len(plain)
                        loss.update(plain.encode())
                yield text

        for role, text in messages_of(read()):
            n_turns += 1
            turns.update(f"{role}\n{text}\n".encode())
        return conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches((digest(c, rows) for c, rows in groupby(rows_in_order(batches), key=lambda r: r[0])), fields)

    long, string = pa.int64(), pa.string()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    fields = list(zip(names, (long, long, string, long, string, long), strict=True))
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return parts.mapInArrow(run, schema)
