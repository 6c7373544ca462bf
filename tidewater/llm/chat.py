"""Chat formatting by compiled templates.

A template is text with `{{ expression }}` and the tags `{% for x in list %}`, `{% if %}`/`{% elif %}`/`{% else %}`, `{% set x = ... %}`
and `{% generation %}`, which marks what a model is to learn.  It is parsed into a syntax tree, constants are folded (with tests
on constants decided and neighbouring texts joined), and the tree becomes Python closures.  The language is a sandbox: names, keys of
dictionaries, operators and a fixed list of filters; no calls, no attributes of Python objects, no loop but over a given list.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE = (
    "{% for m in messages %}{{ '<|' + m.role + '|>' + '\\n' }}{% if m.role == 'assistant' %}{% generation %}{{ m.text }}<|end|>{% endgeneration %}"
    "{% else %}{{ m.text }}<|end|>{% endif %}{{ '\\n' }}{% endfor %}"
)

RESULT = "conv_id long, text string, n_messages long, spans array<struct<start:long,end:long>>"


class TemplateError(ValueError):
    pass


# Syntax trees are tuples: (kind, ...).
_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>()\[\].|,=*%]))""", re.S)
_WORDS = {"and", "or", "not", "in", "if", "else", "is"}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _text(x) -> str:
    return "" if x is None else "true" if x is True else "false" if x is False else str(x)


def _plus(a, b):
    return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)


def _compare(op):
    def run(a, b):
        try:
            return op(a, b)
        except TypeError:
            return False

    return run


def _numbers(op):
    def run(a, b):
        if not (isinstance(a, int) and isinstance(b, int)):
            raise TemplateError("arithmetic needs numbers")
        try:
            return op(a, b)
        except ZeroDivisionError:
            raise TemplateError("division by zero") from None

    return run


_BINARY = {
    "+": _plus, "-": _numbers(operator.sub), "~": lambda a, b: _text(a) + _text(b), "%": _numbers(operator.mod), "==": operator.eq, "!=": operator.ne,
    "<": _compare(operator.lt), "<=": _compare(operator.le), ">": _compare(operator.gt), ">=": _compare(operator.ge), "in": _compare(lambda a, b: a in b),
}
_FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": lambda x: len(x) if x is not None else 0,
    "default": lambda x, other="": other if x is None else x, "string": _text, "replace": lambda x, old, new: _text(x).replace(_text(old), _text(new)), "first": lambda x: x[0] if x else None, "last": lambda x: x[-1] if x else None,
}


class _Expression:
    """A parser of one expression by descent."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            kind = "number" if m[1] else "string" if m[2] else "name" if m[3] else "op"
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        token = self.peek()
        if value is not None and token[1] != value or token[0] == "end":
            raise TemplateError(f"expected {value or 'more'}, found {token[1] or 'the end'}")
        self.at += 1
        return token

    def has(self, *values: str) -> bool:
        kind, value = self.peek()
        return kind in ("op", "name") and value in values

    def whole(self) -> tuple:
        out = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return out

    def either(self) -> tuple:
        left = self.any_of()
        if self.has("if"):
            self.take()
            test = self.any_of()
            other: tuple = ("const", None)
            if self.has("else"):
                self.take()
                other = self.either()
            return ("choose", test, left, other)
        return left

    def any_of(self) -> tuple:
        left = self.all_of()
        while self.has("or"):
            self.take()
            left = ("or", left, self.all_of())
        return left

    def all_of(self) -> tuple:
        left = self.negated()
        while self.has("and"):
            self.take()
            left = ("and", left, self.negated())
        return left

    def negated(self) -> tuple:
        if self.has("not"):
            self.take()
            return ("not", self.negated())
        left = self.sum()
        while self.has("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            op = self.take()[1]
            if op == "not":
                self.take("in")
                left = ("not", ("binary", "in", left, self.sum()))
            else:
                left = ("binary", op, left, self.sum())
        return left

    def sum(self) -> tuple:
        left = self.filtered()
        while self.has("+", "-", "~", "%"):
            left = ("binary", self.take()[1], left, self.filtered())
        return left

    def filtered(self) -> tuple:
        left = self.keyed()
        while self.has("|"):
            self.take()
            name, args = self.take()[1], []
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.has("("):
                self.take()
                while not self.has(")"):
                    args.append(self.either())
                    if not self.has(")"):
                        self.take(",")
                self.take(")")
            left = ("filter", name, left, *args)
        return left

    def keyed(self) -> tuple:
        left = self.atom()
        while self.has(".", "["):
            if self.take()[1] == ".":
                kind, name = self.take()
                if kind != "name":
                    raise TemplateError(f"{name!r} is no key")
                left = ("key", left, ("const", name))
            else:
                left = ("key", left, self.either())
                self.take("]")
        return left

    def atom(self) -> tuple:
        kind, value = self.take()
        if kind == "number":
            return ("const", int(value))
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "name" and value in _CONSTANTS:
            return ("const", _CONSTANTS[value])
        if kind == "name" and value not in _WORDS and not value.startswith("_"):
            return ("name", value)
        if value == "(":
            out = self.either()
            self.take(")")
            return out
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str) -> list[tuple]:
    """The syntax tree of a template: a list of nodes."""
    parts: list[tuple[str, str]] = []
    at, cut = 0, False
    for m in _TAG.finditer(template):
        text = template[at : m.start()]
        text = text.lstrip() if cut else text
        parts.append(("text", text.rstrip() if m[1] or m[4] else text))
        cut, at = bool(m[3] or m[6]), m.end()
        if m[2] is not None:
            parts.append(("value", m[2]))
        elif m[5] is not None:
            parts.append(("tag", m[5].strip()))
    parts.append(("text", template[at:].lstrip() if cut else template[at:]))
    place = 0

    def body(*ends: str) -> tuple[list[tuple], str]:
        nonlocal place
        out: list[tuple] = []
        while place < len(parts):
            kind, source = parts[place]
            place += 1
            word, _, rest = source.partition(" ")
            if kind == "text":
                out.append(("text", source))
            elif kind == "value":
                out.append(("value", _Expression(source).whole()))
            elif word in ends:
                return out, source
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {source!r}")
                inner, _ = body("endfor")
                out.append(("for", m[1], _Expression(m[2]).whole(), inner))
            elif word == "if":
                arms, other, test = [], [], _Expression(rest).whole()
                while True:
                    inner, end = body("elif", "else", "endif")
                    arms.append((test, inner))
                    if not end.startswith("elif"):
                        break
                    test = _Expression(end[4:]).whole()
                if end == "else":
                    other, _ = body("endif")
                out.append(("if", arms, other))
            elif word == "set":
                m = re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read {source!r}")
                out.append(("set", m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                inner, _ = body("endgeneration")
                out.append(("generation", inner))
            else:
                raise TemplateError(f"no tag {word!r} here")
        if ends:
            raise TemplateError(f"no {' or '.join(ends)}")
        return out, ""

    return body()[0]


def fold(node: tuple) -> tuple:
    """An expression with its constant parts worked out."""
    if node[0] in ("const", "name"):
        return node
    node = tuple(fold(x) if isinstance(x, tuple) else x for x in node)
    kids = [x for x in node if isinstance(x, tuple)]
    if node[0] in ("and", "or", "choose") and kids[0][0] == "const":
        truth = bool(kids[0][1])
        if node[0] == "choose":
            return kids[1] if truth else kids[2]
        return kids[1] if truth == (node[0] == "and") else kids[0]
    if all(k[0] == "const" for k in kids):
        return ("const", _closure(node)({}))
    return node


def folded(nodes: list[tuple]) -> list[tuple]:
    """A tree with constants folded, dead arms dropped and texts joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            node = ("text", out.pop()[1] + node[1])
        if node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "value":
            value = fold(node[1])
            add(("text", _text(value[1])) if value[0] == "const" else ("value", value))
        elif node[0] == "for":
            add(("for", node[1], fold(node[2]), folded(node[3])))
        elif node[0] == "set":
            add(("set", node[1], fold(node[2])))
        elif node[0] == "generation":
            add(("generation", folded(node[1])))
        elif node[0] == "if":
            arms, other = [], folded(node[2])
            for test, inner in node[1]:
                test = fold(test)
                if test[0] != "const":
                    arms.append((test, folded(inner)))
                elif test[1]:
                    other = folded(inner)
                    break
            if arms:
                add(("if", arms, other))
            else:
                for x in other:
                    add(x)
        else:
            add(node)
    return out


def _closure(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "key":
        thing, key = _closure(node[1]), _closure(node[2])

        def look(env: dict) -> object:
            x, k = thing(env), key(env)
            if isinstance(x, dict):
                return x.get(k)
            return x[k] if isinstance(x, list | str) and isinstance(k, int) and -len(x) <= k < len(x) else None

        return look
    if kind == "binary":
        op, a, b = _BINARY[node[1]], _closure(node[2]), _closure(node[3])
        return lambda env: op(a(env), b(env))
    if kind == "filter":
        apply, args = _FILTERS[node[1]], [_closure(x) for x in node[2:]]

        def filtered(env):
            values = [x(env) for x in args]
            try:
                return apply(*values)
            except (TypeError, KeyError):
                raise TemplateError(f"{node[1]} can't be applied to this") from None

        return filtered
    if kind == "not":
        a = _closure(node[1])
        return lambda env: not a(env)
    a, b = _closure(node[1]), _closure(node[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    c = _closure(node[3])
    return lambda env: b(env) if a(env) else c(env)


class _Out:
    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _statement(node: tuple) -> Callable[[dict, _Out], None]:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.add(text)
    if kind == "value":
        value = _closure(node[1])
        return lambda env, out: out.add(_text(value(env)))
    if kind == "set":
        name, new = node[1], _closure(node[2])

        def assign(env: dict, out: _Out) -> None:
            env[name] = new(env)

        return assign
    if kind == "generation":
        inner = _block(node[1])

        def mark(env: dict, out: _Out) -> None:
            start = out.size
            inner(env, out)
            out.spans.append((start, out.size))

        return mark
    if kind == "for":
        var, listed, each = node[1], _closure(node[2]), _block(node[3])

        def loop(env: dict, out: _Out) -> None:
            items = listed(env)
            items = items if isinstance(items, list) else []
            inner = dict(env)
            for i, item in enumerate(items):
                inner[var], inner["loop"] = item, {"index": i + 1, "index0": i, "first": not i, "last": i + 1 == len(items), "length": len(items)}
                each(inner, out)

        return loop
    arms, other = [(_closure(t), _block(x)) for t, x in node[1]], _block(node[2])

    def branch(env: dict, out: _Out) -> None:
        for test, inner in arms:
            if test(env):
                return inner(env, out)
        return other(env, out)

    return branch


def _block(nodes: list[tuple]) -> Callable[[dict, _Out], None]:
    steps = [_statement(n) for n in nodes]

    def run(env: dict, out: _Out) -> None:
        for step in steps:
            step(env, out)

    return run


def compiled(template: str) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of names (messages=[{...}], ...) that gives the text and the spans of its generation marks, in characters."""
    run = _block(folded(parse(template)))

    def render(**names) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        run(names, out)
        return "".join(out.parts), out.spans

    return render


def _renderer(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        for batch in batches:
            texts, spans = [], []
            for messages in batch.column("messages").to_pylist():
                try:
                    text, marks = render(messages=messages)
                except TemplateError:
                    text, marks = None, None
                texts.append(text)
                spans.append(marks if marks is None else [{"start": a, "end": b} for a, b in marks])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(texts, pa.string()), batch.column("n_messages"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["conv_id", "text", "n_messages", "spans"]
            )

    return run


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, text, n_messages and spans (of the generation marks, in characters) for every conversation.

    Messages are ordered by turn, then role, then text, nulls first, so ties have an order; rows that repeat are messages of their own.
    A null role or text is none, which renders as nothing.  Rows of a null conv_id belong to no conversation and are left out.  Other
    columns are ignored.  Texts may have any length.  A template that can't be read raises TemplateError on the driver; a conversation in
    which it asks for what can't be done (the length of a number) has a null text and null spans.
    """
    compiled(template)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), "role", "text").alias("m")).where("conv_id is not null")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("messages"), F.count(F.lit(1)).alias("n_messages"))
    return whole.mapInArrow(_renderer(template), RESULT)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`formatted` for all conversations, the spans as text."""
    out = formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), " ")
    return out.select("conv_id", "text", "n_messages", spans.alias("spans"))


OP2_SQL = """
WITH m AS (
  SELECT conv_id, coalesce(role, '') AS role, '<|' || coalesce(role, '') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, CAST(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id ORDER BY k) AS BIGINT) - length(body) - 1 AS place FROM m)
SELECT conv_id, string_agg(head || body || chr(10), '' ORDER BY k) AS text, count(*) AS n_messages,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN place || '-' || (place + length(body)) END, ' ' ORDER BY k), '') AS spans
FROM p GROUP BY conv_id
"""
