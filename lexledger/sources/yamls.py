"""Nested YAML documents as rows of JSON, by an indentation stack; a table function over texts in one Arrow pass.

Read are the forms of rule files and registries: mappings and lists in each other at any depth, lists at their key's own
indentation, block scalars (| and >, with - or +), plain scalars over several lines, quotes with their escapes, [..] and {..},
comments, and --- between documents. Scalars follow the core schema: null, booleans, whole numbers, floats, text; dates stay
text. Anchors, tags, tabs for indentation and complex keys are errors, and so is a key given twice."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s\-\[\]{}"'#&*!|>%@`,?:][^#:]*?(?:(?::(?!\s|$)|(?<!\s)#)[^#:]*?)*|-[^\s:][^:#]*?)\s*:(?=\s|$)""")
ESCAPED = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", '"': '"', "\\": "\\", "/": "/", "e": "\x1b", "a": "\a", "b": "\b", "f": "\f", "v": "\v", " ": " ", "_": "\u00a0", "N": "\u0085"}
WORDS = {"": None, "~": None, "null": None, "Null": None, "NULL": None, "true": True, "True": True, "TRUE": True, "false": False, "False": False, "FALSE": False}


@dataclass
class Line:
    indent: int
    text: str
    number: int


def scalar(text: str):
    """The value of a plain scalar."""
    if text in WORDS:
        return WORDS[text]
    if re.fullmatch(r"[-+]?[0-9]+", text):
        return int(text)
    if re.fullmatch(r"[-+]?(\.[0-9]+|[0-9]+(\.[0-9]*)?)([eE][-+]?[0-9]+)?", text):
        return float(text)
    return text


def quoted(text: str) -> str:
    if text[0] == "'":
        return text[1:-1].replace("''", "'")

    def one(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1][1:], 16))
        if m[2] not in ESCAPED:
            raise ValueError(f"escape \\{m[2]}")
        return ESCAPED[m[2]]

    return re.sub(r"\\(?:(x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})|(.))", one, text[1:-1])


def without_comment(text: str) -> str:
    """The text up to a comment; quotes protect a #."""
    at, quote = 0, ""
    while at < len(text):
        c = text[at]
        if quote:
            at += c == "\\" and quote == '"'
            quote = "" if c == quote else quote
        elif c in "\"'" and (at == 0 or text[at - 1] in " [{,:"):
            quote = c
        elif c == "#" and (at == 0 or text[at - 1] in " \t"):
            return text[:at].rstrip()
        at += 1
    return text.rstrip()


def flow(text: str):
    """[..] and {..}."""
    at = 0

    def blank() -> None:
        nonlocal at
        while at < len(text) and text[at].isspace():
            at += 1

    def value(ends: str):
        nonlocal at
        blank()
        if at < len(text) and text[at] in "[{":
            return group()
        m = re.compile(r""""(?:[^"\\]|\\.)*"|'(?:[^']|'')*'""").match(text, at)
        if m:
            at = m.end()
            return quoted(m[0])
        m = re.compile(rf"(?:[^{re.escape(ends)},:]|:(?=[^\s{re.escape(ends)},]))*").match(text, at)
        at = m.end()
        return scalar(m[0].strip())

    def group():
        nonlocal at
        end = "]" if text[at] == "[" else "}"
        out: list | dict = [] if end == "]" else {}
        at += 1
        while True:
            blank()
            if at >= len(text):
                raise ValueError("a flow collection without an end")
            if text[at] == end:
                at += 1
                return out
            v = value(end)
            blank()
            if isinstance(out, dict):
                if v in out:
                    raise ValueError(f"key twice: {v}")
                if at < len(text) and text[at] == ":":
                    at += 1
                    out[str(v)] = value(end)
                    blank()
                else:
                    out[str(v)] = None
            else:
                out.append(v)
            if at < len(text) and text[at] == ",":
                at += 1
            elif at >= len(text) or text[at] != end:
                raise ValueError("a flow collection that is broken")

    out = group()
    blank()
    if at != len(text):
        raise ValueError("text after a flow collection")
    return out


class Parser:
    def __init__(self, text: str):
        self.raw = text.split("\n")
        self.at = 0

    def peek(self) -> Line | None:
        """The next line with content."""
        while self.at < len(self.raw):
            raw = self.raw[self.at]
            body = raw.lstrip(" ")
            if without_comment(body):
                if body[0] == "\t":
                    raise ValueError(f"line {self.at + 1}: a tab as indentation")
                return Line(len(raw) - len(body), without_comment(body), self.at)
            self.at += 1
        return None

    def node(self, least: int):
        """The node that starts at the next line, which is indented by ``least`` or more; null if none is."""
        line = self.peek()
        if line is None or line.indent < least:
            return None
        if line.text == "-" or line.text.startswith("- "):
            return self.sequence(line.indent)
        if KEY.match(line.text):
            return self.mapping(line.indent)
        self.at += 1
        return self.value(line.text, least)

    def sequence(self, indent: int) -> list:
        out = []
        while (line := self.peek()) and line.indent == indent and (line.text == "-" or line.text.startswith("- ")):
            rest = line.text[1:].lstrip()
            if not rest:
                self.at += 1
                out.append(self.node(indent + 1))
            elif rest == "-" or rest.startswith("- ") or KEY.match(rest):
                # A collection on the dash's own line is indented as if the dash were blank.
                raw = self.raw[self.at]
                self.raw[self.at] = raw[:indent] + " " + raw[indent + 1 :]
                out.append(self.node(indent + 1))
            else:
                self.at += 1
                out.append(self.value(rest, indent + 1))
        return out

    def mapping(self, indent: int) -> dict:
        out: dict = {}
        while (line := self.peek()) and line.indent == indent and (m := KEY.match(line.text)):
            key = quoted(m[1]) if m[1][0] in "\"'" else m[1]
            if key in out:
                raise ValueError(f"line {line.number + 1}: key twice: {key}")
            rest = line.text[m.end() :].strip()
            self.at += 1
            if rest:
                out[key] = self.value(rest, indent + 1)
            else:
                after = self.peek()
                dash = after is not None and after.indent == indent and (after.text == "-" or after.text.startswith("- "))
                out[key] = self.sequence(indent) if dash else self.node(indent + 1)
        if (line := self.peek()) and line.indent > indent:
            raise ValueError(f"line {line.number + 1}: indentation")
        return out

    def value(self, text: str, least: int):
        """A scalar or flow collection that begins with ``text`` and may go on over lines indented by ``least``."""
        if text[0] in "&*!%@`":
            raise ValueError(f"not read: {text[0]}")
        if m := re.fullmatch(r"([|>])(?:([1-9])([-+]?)|([-+]?)([1-9]?))", text):
            return self.block(m[1], m[3] or m[4] or "", least, int(m[2] or m[5] or 0))
        if text[0] in "\"'":
            whole = re.compile(r'"(?:[^"\\]|\\.)*"' if text[0] == '"' else r"'(?:[^']|'')*'")
            while not whole.fullmatch(text):
                if self.at >= len(self.raw) or whole.match(text):
                    raise ValueError("a quoted text that is broken")
                more = self.raw[self.at].strip()
                self.at += 1
                text = text + "\n" if not more else text + more if text.endswith("\n") else f"{text} {more}"
            return quoted(text)
        lines = [text]
        closed = self._closed(text) if text[0] in "[{" else None
        while (line := self.peek()) and line.indent >= least and closed is not True:
            if closed is None and KEY.match(line.text):
                raise ValueError(f"line {line.number + 1}: a key inside a text")
            lines.append(line.text)
            self.at += 1
            closed = self._closed(" ".join(lines)) if closed is not None else None
        return flow(" ".join(lines)) if text[0] in "[{" else scalar(" ".join(lines))

    @staticmethod
    def _closed(text: str) -> bool:
        bare = re.sub(r"""(?<=[\s\[{,:])("(?:[^"\\]|\\.)*"|'(?:[^']|'')*')""", "", text)
        return bare.count("[") + bare.count("{") <= bare.count("]") + bare.count("}")

    def block(self, style: str, chomp: str, least: int, given: int) -> str:
        lines, indent = [], least - 1 + given if given else 0
        while self.at < len(self.raw):
            raw = self.raw[self.at]
            own = len(raw) - len(raw.lstrip(" "))
            if raw.strip(" "):
                indent = indent or max(own, least)
                if own < indent:
                    break
            lines.append(raw[indent:] if indent else "")
            self.at += 1
        end = len(lines)
        while end and not lines[end - 1].strip(" "):
            end -= 1
        kept, empty = lines[:end], len(lines) - end
        cut = self.at == len(self.raw) and not empty  # the text ends without a line break
        if style == ">":
            out = ""
            for i, x in enumerate(kept):
                before = kept[i - 1] if i else None
                if before is None:
                    out = x
                elif not x:
                    out += "\n"
                elif before and not before.startswith(" ") and not x.startswith(" "):
                    out += " " + x
                else:  # after an empty line, which has its break already; more indented lines keep theirs
                    out += x if not before and not x.startswith(" ") else "\n" + x
            text = out
        else:
            text = "\n".join(kept)
        return text if chomp == "-" or cut else text + "\n" * empty if chomp == "+" and not kept else text + "\n" + "\n" * (empty if chomp == "+" else 0) if kept else ""


def documents(text: str) -> Iterator[object]:
    """The documents of a text."""
    text = text.replace("\r\n", "\n")
    for part in re.split(r"(?m)^---[ \t]*$", text) if re.search(r"(?m)^---[ \t]*$", text) else [text]:
        p = Parser(re.sub(r"(?m)^\.\.\.[ \t]*$", "", part))
        if p.peek() is None:
            continue
        out = p.node(0)
        if (line := p.peek()) is not None:
            raise ValueError(f"line {line.number + 1}: not read")
        yield out


def yaml_rows(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, at, record, error): a row for each element of a document that is a list, one for any other document; record is
    JSON, for parse_json, from_json or get_json_object. A text that can't be read gives one row with its error."""
    from pyspark.sql.pandas.types import to_arrow_schema

    base = df.select(*keys, text)
    kinds = to_arrow_schema(base.select(*keys).schema)
    schema = pa.schema([*kinds, ("at", pa.int32()), ("record", pa.string()), ("error", pa.string())])

    def each(raw: str | None) -> list[tuple]:
        try:
            found = [x for doc in documents(raw or "") for x in (doc if isinstance(doc, list) else [doc])]
            return [(i, json.dumps(x, ensure_ascii=False), None) for i, x in enumerate(found)]
        except (ValueError, RecursionError) as e:
            return [(None, None, str(e)[:200] or type(e).__name__)]

    def run(batches):
        for b in batches:
            rows = [{**{k: r[k] for k in keys}, "at": at, "record": record, "error": error} for r in b.to_pylist() for at, record, error in each(r[text])]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.select(*keys).schema.fields)
    return base.mapInArrow(run, f"{columns}at int, record string, error string")
