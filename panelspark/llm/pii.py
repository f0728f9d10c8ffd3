"""Personal data in whole texts, plain and disguised, with offsets into the source.

Plain identifiers are found as they stand. Then transducers rewrite the text -
homoglyphs to their ASCII letters, spelled digits to digits, disguised "at" and
"dot" to @ and . - and remember for every written character the source characters
it stands for. The same detectors read the rewritten text and their spans are
mapped back. Texts without anything to rewrite are not rewritten.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm import tokens
from panelspark.llm.stage import packed, refuse_clash, unpacked

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like ASCII letters, by the letter they stand for.
HOMOGLYPHS = {
    "a": "аαɑ", "b": "Ьь", "c": "сϲ", "d": "ԁ", "e": "еєҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "јϳ",
    "k": "кκ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "тτ", "u": "սυ", "v": "νѵ",
    "w": "ԝѡ", "x": "хχ", "y": "уүγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "УΥ", "Z": "Ζ",
    ".": "。｡․", "@": "﹫", "-": "‐‑‒–−", "+": "﹢", " ": "    ",
}
# Characters that show nothing.
INVISIBLE = "​‌‍⁠﻿­"
# Names of the digits.
DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_LOOKS = {ord(c): a for a, cs in HOMOGLYPHS.items() for c in cs} | {ord(c): "" for c in INVISIBLE}
_FOREIGN = re.compile("[" + "".join(sorted({chr(c) for c in _LOOKS})) + "٠-٩۰-۹०-९！-～\U0001d400-\U0001d7ff]")
_SPELLED = re.compile(r"(?i)(?<![a-z0-9])(?:" + "|".join(DIGIT_WORDS) + r"|oh)(?:(?:[\x20-]|,\x20)?(?:" + "|".join(DIGIT_WORDS) + r"|oh)(?![a-z]))+(?![a-z0-9])")
_WORD = re.compile(r"(?i)" + "|".join(DIGIT_WORDS) + "|oh")
_PART = r"(?:[0-9]{1,3}|(?:" + "|".join(DIGIT_WORDS) + r")(?:[\x20-](?:" + "|".join(DIGIT_WORDS) + r")){0,2})"
_SPELLED_IP = re.compile(rf"(?i)(?<![a-z0-9]){_PART}(?:\x20(?:dot|point)\x20{_PART}){{3}}(?![a-z0-9])")
_PLUS = re.compile(r"(?i)(?<![a-z0-9])plus\x20*(?=[0-9])")
_DOT_NUMBER = re.compile(r"(?i)(?<=[0-9])\s*(?:[\[({<]\s*(?:dot|\.)\s*[\])}>]|\x20(?:dot|point)\x20)\s*(?=[0-9])")
_NAME = r"[A-Za-z0-9_%+-]+"
_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+(?:at|@)\s+|\s+@|@\s+|[_-]at[_-]|@)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|[_-]dot[_-]|\s+\.\s+|\.)"
_ADDRESS = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-]){_NAME}(?:{_DOT}{_NAME}){{0,4}}?(?P<at>{_AT})[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+){{1,5}}")
_AT_ONLY, _DOT_ONLY = re.compile(rf"(?i){_AT}"), re.compile(rf"(?i){_DOT}")
_HINT = re.compile(r"\sdot\s|[_-]dot[_-]|[\[({<]\s*(?:dot|at|\.|@)\s*[\])}>]|\s@|@\s|[_-]at[_-]|\s\.\s|\s+at\s+[a-z0-9-]+\.[a-z0-9-]")
_VISIBLE_DOT = re.compile(r"(?i)[\[({<]|[_-]dot[_-]")
# Endings of domain names that are accepted where every disguise is a bare word or a space. All endings of
# countries, and general ones in use; a text with a bracketed or joined at or dot may have any ending of two or more letters.
ENDINGS = frozenset("com org net edu gov mil int info biz name io dev app ai co tv example test invalid uk de fr es eu us ca au jp cn ru br nl pl se ch".split())
MORE_ENDINGS = frozenset((
    "ac ad ae af ag al am ao aq ar as at aw ax az ba bb bd be bf bg bh bi bj bm bn bo bs bt bw by bz cc cd cf cg ci ck cl cm cr cu cv cw cx cy cz "
    "dj dk dm do dz ec ee eg er et fi fj fk fm fo ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in iq ir is it "
    "je jm jo ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz "
    "na nc ne nf ng ni no np nr nu nz om pa pe pf pg ph pk pm pn pr ps pt pw py qa re ro rs rw sa sb sc sd sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz "
    "tc td tf tg th tj tk tl tm tn to tr tt tw tz ua ug uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw aero agency arpa art asia bank bar berlin best "
    "bio blog cafe cat center chat city click cloud club coop company consulting cool design digital email energy events expert express "
    "family fashion finance fit foundation fun fund gallery games global group guide guru health help host house inc ink institute jobs "
    "land law legal life link live llc local localhost london ltd market marketing media mobi money museum network news ngo nyc one onion online page paris partners "
    "photo photography photos pizza plus post press pro productions pub rocks sale school science security services shop site social software solutions space "
    "store studio style support systems team tech technology tel tips today tools top tours town toys trade training travel university video vip "
    "website wiki win wine work works world wtf xxx xyz zone"
).split())
# Words that are no domain before a bare "dot" and an ending that is a word itself: "looked at the dot in it".
_ARTICLES = frozenset("a an the this that these those his her its my your our their each every one some any no at dot".split())


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = at + 1
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _count(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(digits := _count(m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _PHONE.finditer(text) if 9 <= len(_count(m[0])) <= 15)


_FIND = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def plain(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of identifiers as they stand, by kind and start."""
    kinds = ([0] if "@" in text else []) + ([1, 2, 3] if _DIGIT.search(text) else [])
    return [(k, a, b) for k in kinds for a, b in _FIND[KINDS[k]](text)]


class Rewritten:
    """A text and, for each of its characters, where its source characters begin and end."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, None, None

    def rewrite(self, edits: Iterator[tuple[int, int, str]]) -> None:
        """Replace [a, b) by new text, for edits in order that do not overlap; new characters stand for all of [a, b)."""
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            if b <= a:
                continue
            if self.start is None:
                self.start, self.end = np.arange(len(self.text)), np.arange(1, len(self.text) + 1)
            texts += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        if at:
            self.text = "".join([*texts, self.text[at:]])
            self.start, self.end = np.concatenate([*starts, self.start[at:]]), np.concatenate([*ends, self.end[at:]])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


def _ascii(c: str) -> str:
    if ord(c) in _LOOKS:
        return _LOOKS[ord(c)]
    digit = unicodedata.digit(c, None)
    return str(digit) if digit is not None else unicodedata.normalize("NFKC", c)


def _homoglyphs(text: str) -> Iterator[tuple[int, int, str]]:
    return ((m.start(), m.end(), _ascii(m[0])) for m in _FOREIGN.finditer(text))


def _spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of three or more spelled digits; one number each. The word oh counts only inside a run."""
    for m in _SPELLED.finditer(text):
        words = [w.lower() for w in _WORD.findall(m[0])]
        if len(words) - words.count("oh") < 3:
            continue
        at = m.start()
        for w in _WORD.finditer(m[0]):
            yield at, m.start() + w.end(), DIGIT_WORDS.get(w[0].lower(), "0")
            at = m.start() + w.end()


def _spelled_ips(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SPELLED_IP.finditer(text):
        parts = re.split(r"(?i)\x20(?:dot|point)\x20", m[0])
        digits = ["".join(DIGIT_WORDS.get(w.lower(), w) for w in re.split(r"[\x20-]", p)) for p in parts]
        yield m.start(), m.end(), ".".join(digits)


def _accepted(at: str, local: str, labels: list[str], dots: list[str]) -> bool:
    """Whether local, at and these labels with these dots between them are an address in disguise.

    A bare word "at" with plain dots counts only if the local part has marks of
    an address: "look at example.com" is left alone.
    """
    ending, visible = labels[-1].lower(), _VISIBLE_DOT.search("".join(dots)) is not None
    if re.search(r"[\[({<]", at):
        return True
    if not (len(ending) >= 2 and ending.isalpha()) and not ending.startswith("xn--"):
        return False
    disguised = any(d != "." for d in dots)
    bare = at.strip().lower() == "at"
    if bare and not disguised and not re.search(r"[0-9._+]", local):
        return False
    spoken = any(d.strip().lower() == "dot" for d in dots)
    if visible or "_" in at or (at == "@" and (spoken or not disguised)) or (bare and disguised and re.search(r"(?i)\sdot\s|[0-9._+]", local)):
        return True
    return ending in ENDINGS or (ending in MORE_ENDINGS and not (bare and labels[0].lower() in _ARTICLES))


def _addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """@ and . for their disguises where a whole address stands, with as many labels as its ending allows."""
    for m in _ADDRESS.finditer(text):
        local, domain_from = text[m.start() : m.start("at")], m.end("at")
        between = list(_DOT_ONLY.finditer(text[domain_from : m.end()]))
        edges = [0, *(x for d in between for x in d.span()), m.end() - domain_from]
        labels = [text[domain_from + a : domain_from + b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
        n = next((n for n in range(len(between), 0, -1) if _accepted(m["at"], local, labels[: n + 1], [d[0] for d in between[:n]])), 0)
        if not n:
            continue
        disguised_local = re.search(r"(?i)[\[({<]|[_-]dot[_-]|\sdot\s", local)
        if m["at"] == "@" and all(d[0] == "." for d in between[:n]) and not disguised_local:
            continue
        if disguised_local:
            yield from ((m.start() + d.start(), m.start() + d.end(), ".") for d in _DOT_ONLY.finditer(local))
        yield m.start("at"), domain_from, "@"
        for d in between[:n]:
            yield domain_from + d.start(), domain_from + d.end(), "."


def disguised(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in `text` of identifiers that show after rewriting."""
    foreign = not text.isascii() and _FOREIGN.search(text) is not None
    out = Rewritten(text)
    if foreign:
        out.rewrite(_homoglyphs(out.text))
    low = out.text.lower()
    if low.count(" dot ") + low.count(" point ") >= 3:
        out.rewrite(_spelled_ips(out.text))
    if sum(low.count(w) for w in DIGIT_WORDS) >= 3:
        out.rewrite(_spelled_digits(out.text))
    if "plus" in low:
        out.rewrite((m.start(), m.end(), "+") for m in _PLUS.finditer(out.text))
    if _HINT.search(low) or _DOT_NUMBER.search(out.text):
        out.rewrite((m.start(), m.end(), ".") for m in _DOT_NUMBER.finditer(out.text))
        out.rewrite(_addresses(out.text))
    if out.start is None:
        return []
    return [(k, *out.source(a, b)) for k, a, b in plain(out.text)]


def spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, plain) by kind, start and end; a rewritten span that equals a plain one is left out."""
    base = plain(text)
    more = set(disguised(text)) - set(base)
    return sorted([(k, a, b, True) for k, a, b in base] + [(k, a, b, False) for k, a, b in more])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))
    for batch, _, _ in tokens.blocks(batches, "_text"):
        at = batch.schema.get_field_index("_text")
        found = [[{"kind": KINDS[k], "start": a, "end": b, "plain": p} for k, a, b, p in spans(t)] if t else [] for t in batch.column(at).to_pylist()]
        columns = [pa.array(found, kind) if i == at else batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(columns, names=["spans" if n == "_text" else n for n in batch.schema.names])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, the columns in `keep`, and spans (kind, start, end in code points, plain).

    NULL or empty text has no spans; repeated rows are each reported; a long text
    is one row of one task; an empty table gives an empty result.
    """
    names = list(dict.fromkeys([id_col, *keep]))
    refuse_clash(names, ("spans", "_text"))
    base = docs.select(*names, F.col(text_col).alias("_text"))
    schema = T.StructType(base.schema.fields[:-1]).add("spans", T.ArrayType(T.StructType.fromDDL("kind string, start bigint, end bigint, plain boolean")))
    return base.mapInArrow(_find, schema)


def digest(spans_col: Column) -> Column:
    """kind:start:end of spans, comma-joined, in their order."""
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans are one.

    All own columns stay, whatever their names; NULL or empty text and rows
    without spans are as before; repeated rows are each redacted; an empty table
    stays empty.
    """
    found = find(packed(docs, _doc=text_col), "_row", "_doc", keep=("_doc",))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        put = F.when(fresh, F.concat(acc["out"], F.substring(acc["text"], acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"])
        return F.struct(put.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"), acc["text"].alias("text"))

    ordered = F.array_sort("spans", lambda x, y: F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(y["end"] - x["end"])).cast("int"))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"), F.col("_doc").alias("text"))
    text = F.aggregate(ordered, begin, step, lambda a: F.concat(a["out"], F.substring(a["text"], a["at"] + 1, F.length(a["text"]))))
    return unpacked(found.withColumn("_row", F.col("_row").withField(f"`{text_col}`", text)), docs)
