"""Personal data with offset-preserving deobfuscation.

A chain of transducers runs over every whole text. The first replaces homoglyphs one for one, so offsets stay.
The others record their edits: one rewrites disguised characters (invisible ones, character references,
bracketed at and dot, letters that stand for digits between digits), one spelled digits and the dots between
numbers, one the words at and dot of addresses. The identifiers found in what the last one writes are mapped
back through all edits to source characters. The plain patterns run on the source itself, too; their spans
always stay, and a mapped span is added unless a plain one of its kind covers it.

Whether the words at and dot disguise an address is decided by what stands around them, see `addressed`. All
searches are linear: patterns don't backtrack over long runs, and no part of an identifier has a longest length.

Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from curaloom.llm import runtime

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str):
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The plain patterns' spans by kind, each kind leftmost and non-overlapping."""
    out = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p[-4:]) < 256 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


# Look-alikes of ASCII characters, one for one. Fullwidth forms follow a rule.
_LOOKALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɡ": "g", "ℓ": "l", "﹫": "@", "․": ".", "。": ".", "｡": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-", "﹢": "+", " ": " ", " ": " ", " ": " ", "　": " ",
}
_FOLD = {ord(k): v for k, v in _LOOKALIKES.items()} | {0xFEE0 + c: chr(c) for c in range(0x21, 0x7F)}
#: Digits of other scripts, by their first code points.
_FOLD |= {z + d: str(d) for z in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
_FOLDED = re.compile("[" + "".join(map(chr, sorted(_FOLD))) + "]")

# Spelled digits of the corpus's languages.
_SPELLED = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_NUMBER = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_DOT_WORD = "(?:dot|punkt|punto|point)"
_CHARACTERS = re.compile(
    rf"(?P<zero>[\u00ad\u200b-\u200d\u2060\ufeff]+)"
    rf"|(?P<at>[ ]?[\[({{<][ ]?(?:at|arroba|@)[ ]?[\])}}>][ ]?|&(?:\#0*64|\#x0*40|commat);)"
    rf"|(?P<dot>[ ]?[\[({{<][ ]?(?:{_DOT_WORD}|\.)[ ]?[\])}}>][ ]?|&(?:\#0*46|\#x0*2e|period);)"
    rf"|(?P<letters>(?<=[0-9])[OoIl]+(?=[0-9]))",
    re.IGNORECASE,
)
_PLAIN = {"zero": "", "at": "@", "dot": "."}
_AS_DIGITS = str.maketrans("OoIl", "0011")
_MAY_BE_CHARACTERS = re.compile(r"&(?:\#|commat;|period;)|[0-9][OoIl]+[0-9]|[\u00ad\u200b-\u200d\u2060\ufeff\[({<]", re.IGNORECASE)
_NUMERAL = re.compile(rf"(?<!\w)(?:plus|{_NUMBER}|[0-9]+)(?!\w)", re.IGNORECASE)
_GAP = re.compile(rf"[ ,-]{{1,2}}|[ ]?\.[ ]?|[ ]+(?P<dot>{_DOT_WORD})[ ]+", re.IGNORECASE)
_MAY_BE_NUMBERS = re.compile(rf"(?<!\w){_NUMBER}(?:[ ,.-]{{1,2}}|[ ]+{_DOT_WORD}[ ]+)(?:{_NUMBER}|[0-9])|[0-9](?:[ ,.-]{{1,2}}{_NUMBER}(?!\w)|[ ]+{_DOT_WORD}[ ]+(?:[0-9]|{_NUMBER}))", re.IGNORECASE)
_AT = re.compile(rf"(?:(?<=[A-Za-z0-9_%+-])[ ](?:at|arroba)[ ]|[ ]?@[ ]?)(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9]|[ ]{_DOT_WORD}[ ]|[ ]\.[ ]))", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_NEXT_DOT = re.compile(rf"\.(?=[A-Za-z0-9-])|(?P<dot>[ ]dot[ ](?=[A-Za-z0-9-]))|(?P<word>[ ]{_DOT_WORD}[ ](?=[A-Za-z0-9-]))|(?P<wide>[ ]\.[ ](?=[a-z0-9-]))", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf"[ ]{_DOT_WORD}[ ]\Z", re.IGNORECASE)
# Frequent last labels, and words that announce an address, each one kind of evidence among others.
_ENDING = re.compile("(?:com|org|net|edu|gov|mil|int|info|biz|name|io|ai|app|dev|co|me|eu|uk|us|ca|au|de|at|ch|fr|be|es|mx|it|nl|pt|br|pl|se|jp|cn|in|ru)", re.IGNORECASE)
_CUE = re.compile(r"(?<!\w)(?:e-?mails?|mails?|contact|write|reach|send|address|adresse|courriel|contacte|écri[a-z]+|kontakt|schreib\w*|correo|escrib\w*|contactar)(?!\w)", re.IGNORECASE)
_CUE_REACH = 48


class Edits:
    """A transducer's output with its edits: (source start, source end, output start, output end), in order."""

    def __init__(self, text: str, found: list[tuple[int, int, str]]):
        parts, self.edits, at, out = [], [], 0, 0
        for a, b, new in found:
            parts += [text[at:a], new]
            out += a - at
            self.edits.append((a, b, out, out + len(new)))
            out += len(new)
            at = b
        self.text = "".join([*parts, text[at:]])
        self._starts = [e[2] for e in self.edits]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """Source offsets of an output span; a span that cuts into an edit takes in the whole of it."""
        return self._back(start, 0), self._back(end, 1)

    def _back(self, at: int, last: int) -> int:
        i = bisect_right(self._starts, at - last) - 1
        if i < 0:
            return at
        a, b, x, y = self.edits[i]
        if at - last < y:
            return b if last else a
        return at - y + b


def _characters(text: str) -> Edits:
    return Edits(text, [(*m.span(), _PLAIN.get(m.lastgroup, m[0].translate(_AS_DIGITS))) for m in _CHARACTERS.finditer(text)])


def _numbers(text: str) -> Edits:
    """Runs of numerals of which one or a dot between two is spelled, as digits and dots; single numerals stay."""
    found, run = [], []

    def close():
        if len(run) > 1 and any(not new.isascii() or new != text[a:b] for a, b, new in run):
            found.append((run[0][0], run[-1][1], "".join(new for _, _, new in run)))
        run.clear()

    for m in _NUMERAL.finditer(text):
        word = m[0].lower()
        new = "+" if word == "plus" else str(_SPELLED.get(word, m[0]))
        gap = _GAP.fullmatch(text, run[-1][1], m.start()) if run else None
        if gap is None or new == "+":
            close()
        elif gap["dot"] or "." in gap[0]:
            run.append((*gap.span(), "."))
        run.append((*m.span(), new))
    close()
    return Edits(text, found)


def addressed(text: str, start: int, at: int, end: int, sign: str, dots: set[str], last: str) -> bool:
    """Whether text[start:end], with sign at `at`, is taken for an address whose at or dots are words or stand apart.

    A plain @ is enough where dots are words, and an @ that stands apart where they are plain. Otherwise it takes
    evidence: a cue word before, a sign or digit in the local part, or, where dots are words or stand apart, that the
    phrase stands alone between ends of lines or marks, or "dot" before a frequent last label. A last label has two
    letters or more.
    """
    if not (len(last) > 1 and last.isalpha()):
        return False
    if (sign == "@" and "wide" not in dots) or ("@" in sign and dots == {"plain"}):
        return True
    local = text[start:at]
    if any(c in "._%+-" or c.isdigit() for c in local.strip(".-")) or _CUE.search(text, max(0, start - _CUE_REACH), start):
        return True
    if dots == {"plain"}:
        return False
    before, after = text[max(0, start - 2) : start].rstrip(" "), text[end : end + 1]
    alone = (not before or not before[-1].isalnum()) and (not after or not (after.isalnum() or after == " "))
    return alone or ("word" not in dots and bool(_ENDING.fullmatch(last)))


def _addresses(text: str) -> Edits:
    """at and dot of addresses, where they are words or stand apart, as @ and '.'."""
    found, floor = [], 0
    for m in _AT.finditer(text):
        if m.start() < floor:
            continue
        start, seps = m.start(), []
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start == m.start():
            continue
        while (dot := _DOT_BEFORE.search(text, max(floor, start - 8), start)) and dot.start() > floor and text[dot.start() - 1] in _LOCAL:
            seps.append((*dot.span(), "."))
            start = dot.start()
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
        label = _LABEL.match(text, m.end())
        dots, before = {"dot"} if seps else set(), len(seps)
        while (dot := _NEXT_DOT.match(text, label.end())) and (after := _LABEL.match(text, dot.end())):
            kind = dot.lastgroup or "plain"
            if kind == "wide" and after[0][0].isupper():
                break
            dots.add(kind)
            if kind != "plain":
                seps.append((*dot.span(), "."))
            label = after
        if (m[0] == "@" and len(seps) == before == 0) or not addressed(text, start, m.start(), label.end(), m[0], dots, label[0]):
            continue
        if m[0] != "@":
            seps.append((*m.span(), "@"))
        found += sorted(seps)
        floor = label.end()
    return Edits(text, found)


def undisguised(text: str) -> list[Edits]:
    """What the transducers with edits did, in order; those that find nothing are left out."""
    chain = []
    for may, run in ((_MAY_BE_CHARACTERS.search, _characters), (_MAY_BE_NUMBERS.search, _numbers), (_AT.search, _addresses)):
        if may(text):
            edits = run(text)
            if edits.edits:
                chain.append(edits)
                text = edits.text
    return chain


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The plain spans, and all spans; both by start, then kind."""
    base = base_spans(text)
    spans = list(base)
    folded = text.translate(_FOLD) if _FOLDED.search(text) else text
    chain = undisguised(folded)
    if chain or folded is not text:
        for kind, a, b in base_spans(chain[-1].text if chain else folded):
            for edits in reversed(chain):
                a, b = edits.source(a, b)
            if not any(k == kind and x <= a and b <= y for k, x, y in base):
                spans.append((kind, a, b))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(base, key=order), sorted(set(spans), key=order)


def redact(text: str) -> str:
    """Every span, overlapping ones together, replaced by the kind of its first."""
    out, at = [], 0
    end, kind = -1, ""
    begin = 0
    for k, a, b in [*all_spans(text)[1], ("", len(text) + 1, len(text) + 1)]:
        if a < end:
            end = max(end, b)
            continue
        if end >= 0:
            out += [text[at:begin], f"<{kind.upper()}>"]
            at = end
        begin, end, kind = a, b, k
    return "".join([*out, text[at:]])


def _line(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _found(batches):
    for batch in batches:
        rows = [all_spans((t or b"").decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS]
        digest = [hashlib.sha256(_line(base).encode()).hexdigest() for base, _ in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()), pa.array([_line(s) for _, s in rows], pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (plain spans), base_sha256, spans for every row of docs.

    Null text counts as empty; ill-formed UTF-8 is read with replacement characters.
    """
    runtime.bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_found, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span of its texts replaced by <EMAIL>, <IP>, <CARD> or <PHONE>; n_chars, if there, follows. Null texts stay null."""
    runtime.bound_batches(docs.sparkSession)

    at = docs.columns.index("text")

    def run(columns):
        columns[at] = pa.array([None if t is None else redact(t.decode("utf-8", "replace")) for t in columns[at].to_pylist()], pa.string())
        return columns

    rows = docs.withColumn("text", F.col("text").cast("string").cast("binary"))
    schema = StructType([StructField(f.name, StringType()) if f.name == "text" else f for f in docs.schema.fields])
    out = runtime.map_in_arrow(rows, run, schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
