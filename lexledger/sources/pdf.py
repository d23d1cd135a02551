"""Page texts from the bytes of PDF documents, one row a page, in one Arrow pass; unreadable documents are error rows.

Reads what text needs: objects by their own markers (later ones win, so updated files and files with a broken table read too),
object streams, Flate, the page tree with inherited resources, text operators, simple fonts and fonts with a ToUnicode map.
Encrypted documents, and filters other than Flate and hexadecimal, are errors. ``write_pdf`` makes documents of plain pages."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Largest size of an inflated stream; pages of a document.
MOST_BYTES, MOST_PAGES = 64 << 20, 100_000
TOKEN = re.compile(rb"%[^\r\n]*|<<|>>|\[|\]|\(|<[0-9A-Fa-f\s]*>|/[^\x00\x09\x0a\x0c\x0d ()<>\[\]{}/%]*|[^\x00\x09\x0a\x0c\x0d ()<>\[\]{}/%]+")
OBJECT = re.compile(rb"(?<![0-9])(\d{1,10})\s+(\d{1,5})\s+obj\b")
ESCAPES = {ord("n"): 10, ord("r"): 13, ord("t"): 9, ord("b"): 8, ord("f"): 12}
CLOSE = object()


class Name(str):
    pass


class Ref(int):
    pass


class Word(bytes):
    """An operator or keyword."""


def _literal(data: bytes, at: int) -> tuple[bytes, int]:
    """A string in parentheses; ``at`` is behind the first."""
    out, depth = bytearray(), 1
    while at < len(data):
        c = data[at]
        at += 1
        if c == 0x5C and at < len(data):
            c = data[at]
            at += 1
            if 0x30 <= c <= 0x37:
                digits = re.compile(rb"[0-7]{1,3}").match(data, at - 1)[0]
                out.append(int(digits, 8) & 255)
                at += len(digits) - 1
            elif c not in (10, 13):
                out.append(ESCAPES.get(c, c))
            continue
        depth += (c == 0x28) - (c == 0x29)
        if not depth:
            return bytes(out), at
        out.append(c)
    raise ValueError("a string without an end")


def values(data: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """Values and where each ends: numbers, names, strings, lists, dictionaries, references, words."""
    stack: list[list] = []
    kinds: list[bytes] = []
    while m := TOKEN.search(data, at):
        t, at = m[0], m.end()
        if t[:1] == b"%":
            continue
        if t in (b"<<", b"["):
            stack.append([])
            kinds.append(t)
            continue
        if t in (b">>", b"]"):
            if not stack:
                continue
            items = stack.pop()
            v: object = items if kinds.pop() == b"[" else {k: x for k, x in zip(items[::2], items[1::2]) if isinstance(k, Name)}
        elif t == b"(":
            v, at = _literal(data, at)
        elif t[:1] == b"<":
            digits = re.sub(rb"\s", b"", t[1:-1])
            v = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        elif t[:1] == b"/":
            v = Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda x: bytes([int(x[1], 16)]), t[1:]).decode("latin-1"))
        elif re.fullmatch(rb"[+-]?\d+", t):
            v = int(t)
        elif re.fullmatch(rb"[+-]?(\d+\.?\d*|\.\d+)", t):
            v = float(t)
        elif t == b"R" and stack and len(stack[-1]) >= 2:
            stack[-1][-2:] = [Ref(stack[-1][-2])]
            continue
        else:
            v = {b"true": True, b"false": False, b"null": None}.get(t, Word(t))
        if stack:
            stack[-1].append(v)
        else:
            yield v, at


class Document:
    def __init__(self, data: bytes):
        if b"%PDF-" not in data[:1024]:
            raise ValueError("no PDF")
        self.data, self.at, self.held = data, {}, {}
        for m in OBJECT.finditer(data):
            self.at[int(m[1])] = m.end()
        if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", data):
            raise ValueError("encrypted")
        for n in list(self.at):
            # Objects inside streams; those with a marker of their own win.
            if b"/ObjStm" in data[self.at[n] : self.at[n] + 512] and self._type(n) == "ObjStm":
                d, body = self.stream(Ref(n))
                heads = [v for v, _ in values(body[: d["First"]])]
                for k, off in zip(heads[::2], heads[1::2]):
                    if k not in self.at:
                        self.held[k] = next(values(body, d["First"] + off), (None, 0))[0]

    def _type(self, n: int):
        d = next(values(self.data, self.at[n]), (None, 0))[0]
        return d.get("Type") if isinstance(d, dict) else None

    def get(self, v):
        """What a reference stands for."""
        seen = set()
        while isinstance(v, Ref) and v not in seen:
            seen.add(v)
            if v not in self.held and v in self.at:
                self.held[int(v)] = next(values(self.data, self.at[v]), (None, 0))[0]
            v = self.held.get(int(v))
        return None if isinstance(v, Ref) else v

    def stream(self, ref) -> tuple[dict, bytes]:
        if not isinstance(ref, Ref) or ref not in self.at:
            return {}, b""
        d, end = next(values(self.data, self.at[ref]), (None, 0))
        m = re.compile(rb"\s*stream(\r\n|\n|\r)").match(self.data, end)
        if not isinstance(d, dict) or not m:
            return {}, b""
        size = self.get(d.get("Length"))
        stop = m.end() + size if isinstance(size, int) and re.compile(rb"\s*endstream").match(self.data, m.end() + size) else self.data.find(b"endstream", m.end())
        body = self.data[m.end() : stop if stop >= 0 else None]
        filters = self.get(d.get("Filter")) or []
        for f in filters if isinstance(filters, list) else [filters]:
            if self.get(f) == "FlateDecode":
                z = zlib.decompressobj()
                body = z.decompress(body, MOST_BYTES)
                if z.unconsumed_tail:
                    raise ValueError("a stream too large")
            elif self.get(f) == "ASCIIHexDecode":
                digits = re.sub(rb"\s", b"", body.split(b">")[0])
                body = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
            else:
                raise ValueError(f"filter {f}")
        return d, body

    def pages(self) -> Iterator[dict]:
        """Leaves of the page tree, with the resources they inherit."""
        roots = [v for v in map(self.get, map(Ref, [*self.at, *self.held])) if isinstance(v, dict) and v.get("Type") == "Catalog"]
        stack, seen, n = [(roots[-1].get("Pages"), None)] if roots else [], set(), 0
        while stack:
            ref, inherited = stack.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or ref in seen:
                continue
            seen.add(ref)
            own = node.get("Resources", inherited)
            if "Kids" in node:
                stack += [(k, own) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                n += 1
                if n > MOST_PAGES:
                    raise ValueError("too many pages")
                yield {**node, "Resources": own}

    def text(self, page: dict) -> str:
        content = page.get("Contents")
        parts = content if isinstance(content, Ref) and not isinstance(self.get(content), list) else self.get(content)
        body = b"\n".join(self.stream(c)[1] for c in (parts if isinstance(parts, list) else [parts]))
        fonts = self.get((self.get(page.get("Resources")) or {}).get("Font")) or {}
        maps, decode, out, args = {}, _plain, [], []

        def line() -> None:
            if out and out[-1] != "\n":
                out.append("\n")

        for v, _ in values(body):
            if not isinstance(v, Word):
                args.append(v)
                continue
            if v == b"Tf" and len(args) >= 2:
                name = args[-2]
                if name not in maps:
                    maps[name] = self._font(self.get(fonts.get(name)))
                decode = maps[name]
            elif v in (b"Tj", b"'", b'"') and args and isinstance(args[-1], bytes):
                if v != b"Tj":
                    line()
                out.append(decode(args[-1]))
            elif v == b"TJ" and args and isinstance(args[-1], list):
                for x in args[-1]:
                    if isinstance(x, bytes):
                        out.append(decode(x))
                    elif isinstance(x, (int, float)) and x < -200 and out and not out[-1].endswith((" ", "\n")):
                        out.append(" ")  # a gap as wide as a blank
            elif v == b"T*" or v in (b"Td", b"TD") and len(args) >= 2 and args[-1] != 0 or v in (b"Tm", b"ET"):
                line()
            elif v in (b"Td", b"TD") and out and not out[-1].endswith((" ", "\n")):
                out.append(" ")
            args = []
        return "".join(out).strip("\n")

    def _font(self, font):
        if not isinstance(font, dict) or "ToUnicode" not in font:
            return _plain
        return _mapped(self.stream(font["ToUnicode"])[1])


def _plain(s: bytes) -> str:
    return s.decode("cp1252", "replace")


def _mapped(cmap: bytes):
    """Decoder of a ToUnicode map."""
    table, width, args = {}, 1, []
    text = lambda b: b.decode("utf-16-be", "surrogatepass" if len(b) == 2 else "replace")
    for v, _ in values(cmap):
        if not isinstance(v, Word):
            args.append(v)
            continue
        if v == b"endcodespacerange" and args:
            width = max(len(a) for a in args if isinstance(a, bytes))
        elif v == b"endbfchar":
            table.update({a: text(b) for a, b in zip(args[::2], args[1::2])})
        elif v == b"endbfrange":
            for lo, hi, to in zip(args[::3], args[1::3], args[2::3]):
                first, size = int.from_bytes(lo, "big"), len(lo)
                for i in range(min(65_536, int.from_bytes(hi, "big") - first + 1)):
                    table[(first + i).to_bytes(size, "big")] = (text(to[i]) if i < len(to) else "") if isinstance(to, list) else text(to[:-2] + ((int.from_bytes(to[-2:], "big") + i) & 0xFFFF).to_bytes(2, "big"))
        args = []
    # Codes can stand for halves of a pair.
    return lambda s: "".join(table.get(s[i : i + width], "�") for i in range(0, len(s), width)).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def page_texts(data: bytes | None) -> Iterator[tuple[int | None, str | None, str | None]]:
    """(page from 1, text, error) of a document; an error ends it."""
    n = 0
    try:
        doc = Document(data or b"")
        for n, page in enumerate(doc.pages(), 1):
            yield n, doc.text(page), None
        if not n:
            yield None, None, "no pages"
    except Exception as e:  # noqa: BLE001  any damage of the file
        yield n + 1 if n else None, None, f"{type(e).__name__}: {e}"[:200]


def pdf_pages(docs: DataFrame, keys: list[str], content: str = "content", rows: int = 1000) -> DataFrame:
    """(keys, page, text, error): a row for each page, or for what could not be read."""
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.select(*keys, content)
    kinds = to_arrow_schema(base.select(*keys).schema)
    out = pa.schema([*kinds, ("page", pa.int32()), ("text", pa.string()), ("error", pa.string())])

    def run(batches):
        for b in batches:
            held, size = [], 0
            for r in b.to_pylist():
                own = {k: r[k] for k in keys}
                for page, text, error in page_texts(r[content]):
                    held.append({**own, "page": page, "text": text, "error": error})
                    size += len(text or "")
                    if len(held) >= rows or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=out)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=out)

    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.select(*keys).schema.fields)
    return base.mapInArrow(run, f"{columns}page int, text string, error string")


def write_pdf(pages: list[str], unicode: bool = False, packed: bool = False) -> bytes:
    """A document with the pages' lines. ``unicode``: 16-bit codes with a ToUnicode map, for any text, instead of Windows-1252;
    ``packed``: the page objects inside an object stream."""
    text = (lambda s: b"<" + s.encode("utf-16-be").hex().encode() + b">") if unicode else (lambda s: b"(" + re.sub(rb"([()\\])", rb"\\\1", s.encode("cp1252", "replace")) + b")")
    n, font = len(pages), 3 + 2 * len(pages)
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Resources << /Font << /F1 %d 0 R >> >> /Count %d /Kids [%s] >>" % (font, n, b" ".join(b"%d 0 R" % (3 + 2 * i) for i in range(n)))}
    streams = {}
    for i, page in enumerate(pages):
        objects[3 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (4 + 2 * i)
        streams[4 + 2 * i] = b"BT /F1 11 Tf 14 TL 50 800 Td\n" + b"\n".join(text(line) + b" Tj T*" for line in page.split("\n")) + b"\nET"
    objects[font] = b"<< /Type /Font /Subtype /Type0 /ToUnicode %d 0 R >>" % (font + 1) if unicode else b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>"
    if unicode:
        units = sorted({u for p in pages for u in memoryview(p.encode("utf-16-le")).cast("H")})
        rows = [b"<%04x> <%04x>" % (u, u) for u in units]
        streams[font + 1] = b"1 begincodespacerange <0000> <ffff> endcodespacerange\n" + b"\n".join(b"%d beginbfchar\n%s\nendbfchar" % (len(rows[i : i + 100]), b"\n".join(rows[i : i + 100])) for i in range(0, len(rows), 100))
    if packed:
        own, objects = objects, {}
        heads, at = [], 0
        for k, v in own.items():
            heads.append(b"%d %d" % (k, at))
            at += len(v) + 1
        head = b" ".join(heads) + b"\n"
        streams[font + 2] = (b"/Type /ObjStm /N %d /First %d" % (len(own), len(head)), head + b"\n".join(own.values()))
    for k, v in streams.items():
        more, body = v if isinstance(v, tuple) else (b"", v)
        z = zlib.compress(body)
        objects[k] = b"<< %s /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (more, len(z), z)
    return b"%PDF-1.7\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % x for x in sorted(objects.items())) + b"\ntrailer << /Root 1 0 R >>\n%%EOF\n"
