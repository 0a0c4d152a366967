"""Error-recovering recursive-descent grammars for JSON objects (RFC 8259) and delimited records (RFC 4180).

A parser reads records from a text of any number of records. Where a record breaks the grammar it gives a located
error and goes on at the next anchor, a place where a record can start and where the start of one really parses: for
JSON a brace with a string and a colon behind it, for delimited text the begin of a line or text whose first field is
whole. So one broken quote costs its own record, not those behind it. Nesting is kept on an own stack: depth is bounded
by memory only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

BLANKS = re.compile(r"[ \t\n\r]*")
STRING = re.compile(r'"((?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*)"')
OPEN_STRING = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*')
NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
WORD = re.compile(r"true|false|null")
ESCAPE = re.compile(r'\\(?:u([0-9a-fA-F]{4})|(.))')
PLAIN_INTEGER = re.compile(r"-?[0-9]+")
ANCHOR = re.compile(r'\{[ \t\n\r]*"(?:[^"\\\x00-\x1f]|\\.)*"[ \t\n\r]*:')
SHORT = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}


@dataclass
class Fault:
    """Where a record breaks the grammar, and what should have stood there."""

    offset: int
    expected: str


@dataclass
class Record:
    """One record: its place in the text, its members in order (of a broken one: those before the fault)."""

    start: int
    end: int
    members: dict[str, tuple[str, str]] | list[str] = field(default_factory=dict)
    fault: Fault | None = None


def unescape(body: str) -> str:
    """The text of a JSON string's body; halves of surrogate pairs that stand alone become U+FFFD."""
    if "\\" not in body:
        return body
    text = ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else SHORT.get(m[2], m[2]), body)
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


class Json:
    """Parser of JSON objects. A member is (kind, text); kind is string, number, word (true, false, null) or nested.

    The text of a string is its content, that of any other value its source.
    """

    def __init__(self, text: str):
        self.text = text

    def blanks(self, at: int) -> int:
        return BLANKS.match(self.text, at).end()

    def value(self, at: int) -> tuple[str, str, int]:
        """kind, text and end of the value at a place; raises SyntaxError with its offset."""
        t = self.text
        c = t[at : at + 1]
        if c == '"':
            m = STRING.match(t, at)
            if not m:
                raise _error(self.broken_string(at), "end of string")
            return "string", unescape(m[1]), m.end()
        if c in "{[" and c:
            end = self.nested(at)
            return "nested", t[at:end], end
        m = WORD.match(t, at)
        if m:
            return "word", m[0], m.end()
        m = NUMBER.match(t, at)
        if m and m[0]:
            return "number", m[0], m.end()
        raise _error(at, "value")

    def broken_string(self, at: int) -> int:
        return OPEN_STRING.match(self.text, at).end()

    def key(self, at: int) -> tuple[str, int]:
        m = STRING.match(self.text, at)
        if not m:
            raise _error(at, "name in quotes")
        end = self.blanks(m.end())
        if self.text[end : end + 1] != ":":
            raise _error(end, "colon")
        return unescape(m[1]), self.blanks(end + 1)

    def nested(self, at: int) -> int:
        """End of the object or array at a place. The open brackets stand on a stack, not in Python's frames."""
        t, stack = self.text, [self.text[at]]
        at = self.blanks(at + 1)
        fresh = True
        while stack:
            closing = "}" if stack[-1] == "{" else "]"
            if t[at : at + 1] == closing:
                stack.pop()
                at += 1
                if stack:
                    at = self.blanks(at)
                fresh = False
                continue
            if not fresh:
                if t[at : at + 1] != ",":
                    raise _error(at, f"comma or {closing}")
                at = self.blanks(at + 1)
            if stack[-1] == "{":
                _, at = self.key(at)
            if t[at : at + 1] in ("{", "["):
                stack.append(t[at])
                at, fresh = self.blanks(at + 1), True
                continue
            _, _, at = self.value(at)
            at, fresh = self.blanks(at), False
            if t[at : at + 1] == "," and t[self.blanks(at + 1) : self.blanks(at + 1) + 1] in ("}", "]"):
                raise _error(self.blanks(at + 1), "value")
        return at

    def object(self, at: int) -> Record:
        record = Record(at, at)
        try:
            if self.text[at : at + 1] != "{":
                raise _error(at, "object")
            at = self.blanks(at + 1)
            if self.text[at : at + 1] == "}":
                record.end = at + 1
                return record
            while True:
                name, at = self.key(at)
                kind, value, at = self.value(at)
                record.members[name] = (kind, value)  # of a name that stands there twice the last value counts
                at = self.blanks(at)
                c = self.text[at : at + 1]
                if c == "}":
                    record.end = at + 1
                    return record
                if c != ",":
                    raise _error(at, "comma or }")
                at = self.blanks(at + 1)
        except SyntaxError as e:
            record.fault, record.end = Fault(e.offset, e.msg), e.offset
            return record

    def anchor(self, at: int) -> int:
        """The next place from `at` on where an object starts and its first member parses; the text's end if none.

        Of a nested first value only the bracket is looked at, so that many anchors within each other stay cheap.
        """
        for m in ANCHOR.finditer(self.text, at):
            begin = self.blanks(m.end())
            if self.text[begin : begin + 1] in ("{", "["):
                return m.start()
            try:
                self.value(begin)
            except SyntaxError:
                continue
            return m.start()
        return len(self.text)

    def records(self) -> list[Record]:
        """All records of the text; what stands between records is a record with a fault and no members."""
        out, at = [], self.blanks(0)
        while at < len(self.text):
            record = self.object(at)
            out.append(record)
            if record.fault:
                at = self.anchor(max(record.fault.offset, at + 1))
                record.end = at
            else:
                at = record.end
            at = self.blanks(at)
        return out


def _error(offset: int, expected: str) -> SyntaxError:
    e = SyntaxError(expected)
    e.offset = offset
    return e


QUOTED = re.compile(r'"((?:[^"]|"")*)"')
RUN = re.compile(r'"+')
UNQUOTED = re.compile(r'[^",\r\n]*')
LINE = re.compile(r"\r\n|\n|\r")


class Delimited:
    """Parser of comma-separated records with a fixed number of fields; members are the fields' texts."""

    def __init__(self, text: str, fields: int):
        self.text, self.fields = text, fields
        self.open_from: int | None = None  # the first quote known not to close

    def closes(self, at: int) -> bool:
        """Whether a quote at a place may close. Behind one that doesn't, all quotes stand in pairs; a quote there
        closes only within the run of quotes it begins, so nothing is scanned to the text's end again."""
        if self.open_from is None or at <= self.open_from:
            return True
        return len(RUN.match(self.text, at)[0]) % 2 == 0

    def field_at(self, at: int) -> tuple[str, int]:
        if self.text[at : at + 1] == '"':
            m = QUOTED.match(self.text, at) if self.closes(at) else None
            if not m:
                self.open_from = at if self.open_from is None else min(at, self.open_from)
                raise _error(len(self.text), "closing quote")
            return m[1].replace('""', '"'), m.end()
        m = UNQUOTED.match(self.text, at)
        return m[0], m.end()

    def record(self, at: int) -> Record:
        r = Record(at, at, [])
        try:
            while True:
                value, at = self.field_at(at)
                c = self.text[at : at + 1]
                if c and c not in ",\r\n":
                    raise _error(at, "comma or end of record")
                r.members.append(value)
                if c != ",":
                    break
                at += 1
            if len(r.members) != self.fields:
                raise _error(at, f"{self.fields} fields, not {len(r.members)}")
        except SyntaxError as e:
            r.fault, at = Fault(e.offset, e.msg), e.offset
        r.end = at
        return r

    def anchor(self, at: int) -> int:
        """The begin of the next line from `at` on that is a whole record; the text's end if there is none."""
        for m in LINE.finditer(self.text, at):
            if m.end() < len(self.text) and self.record(m.end()).fault is None:
                return m.end()
        return len(self.text)

    def records(self) -> list[Record]:
        out, at = [], 0
        while at < len(self.text) or not out:
            r = self.record(at)
            out.append(r)
            if r.fault:
                # A quote that never closes swallows what follows: look for anchors from the record's first line on.
                r.end = at = self.anchor(r.start)
            else:
                m = LINE.match(self.text, r.end)
                at = m.end() if m else r.end
            if at >= len(self.text):
                break
        return out
