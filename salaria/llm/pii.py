"""Personal data, also disguised, with offsets of the source text.

Base detectors run on the text as it is. Then transducers rewrite disguises
(homoglyphs and other digits, "(at)" and "dot", spelled digits, zero-width
characters) and record for every rewritten place where it came from. The same
detectors run on the rewritten text; a span that holds a rewritten place is mapped
back to source characters and added, unless it overlaps a base span of its kind.

One pass without a shuffle; a text without any trigger of a transducer costs only
the base detectors. All detectors are linear in the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salaria.llm.rows import documents, small_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits matches from its start or not at all, so a start within a run need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        else:
            done = max(done, at + 1)  # no local part reaches over an @
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _is_ip(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def _is_card(s: str) -> bool:
    d = _NO_DIGIT.sub("", s)
    return 13 <= len(d) <= 19 and luhn(d)


def _is_phone(s: str) -> bool:
    return 9 <= len(_NO_DIGIT.sub("", s)) <= 15


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in ``text``, in order."""
    def of(pattern, holds):
        return [m.span() for m in pattern.finditer(text) if holds(m.group())]

    some = _DIGIT.search(text) is not None
    return {"email": emails(text) if "@" in text else [], "ip": of(_IP, _is_ip) if some else [],
            "card": of(_CARD, _is_card) if some else [], "phone": of(_PHONE, _is_phone) if some and "+" in text else []}


#: Letters of other scripts that look like a Latin letter, next to the letter; full stops of other scripts.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁӏһԛԝѵкАВЕКМНОРСТХУІЈЅαοινρκΑΒΕΖΗΙΚΜΝΟΡΤΥΧɑɡոսօհզ。｡۔", "aeopcyxijsdlhqwvkABEKMHOPCTXYIJSaoivpkABEZHIKMNOPTYXagnuohq..."))
_ZERO_WIDTH = "​‌‍⁠﻿­"
#: Characters from here on are looked at; those before are common letters of clean texts.
_FIRST_ODD = 0x250


def _looks() -> dict[int, str]:
    """Single characters and the ASCII character they stand for: homoglyphs, compatibility forms (full-width, mathematical,
    circled and the like, from the Unicode database), decimal digits of all scripts."""
    table = {ord(k): v for k, v in HOMOGLYPHS.items()}
    for c in range(_FIRST_ODD, 0x20000):
        form = str(unicodedata.digit(chr(c))) if unicodedata.category(chr(c)) == "Nd" else unicodedata.normalize("NFKC", chr(c))
        if len(form) == 1 and "!" <= form <= "~":
            table.setdefault(c, form)
    return table


_LOOKS = _looks()
_ODD = re.compile(f"[{''.join(map(re.escape, map(chr, _LOOKS)))}{_ZERO_WIDTH}]")
#: A quick test: all of them lie here.
_FAR = re.compile("[\u00ad\u0250-\U0001ffff]")

#: Words for digits.
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_TIMES = r"(?:double|triple)\s{1,3}"
_NUMBER = rf"(?:{_TIMES})?(?:[0-9]|\b(?:{_WORD})\b)"
#: Digits of which some are spelled, a plus sign or the word before them; "dot" or "point" may stand between.
_SPELLED = re.compile(rf"(?:\bplus[\s,-]+)?\b(?:{_TIMES})?(?:{_WORD})\b(?:(?:[\s,.()-]{{1,3}}|\s(?:dot|point)\s)?{_NUMBER}){{3,}}", re.I)
_SPELLED_PART = re.compile(rf"\b(?P<times>double|triple)\s{{1,3}}(?P<digit>[0-9]|(?:{_WORD})\b)|\b(?:plus|dot|point|{_WORD})\b", re.I)
_BRACKET_AT = re.compile(r"\s{0,3}[(\[{<]\s{0,3}(?:at|ät|@|arroba)\s{0,3}[)\]}>]\s{0,3}", re.I)
_BRACKET_DOT = re.compile(r"\s{0,3}[(\[{<]\s{0,3}(?:dot|\.|punkt|punto|point)\s{0,3}[)\]}>]\s{0,3}", re.I)
#: "name at host dot ending", the dot spelled: every country's ending and common others (fixed values) count anywhere, any
#: ending of 2 to 24 letters behind an @ or where no word follows it ("he sat at home dot matrix printers" is no address).
_TLD = (
    "com|org|net|edu|gov|mil|int|info|biz|name|pro|mobi|jobs|travel|museum|aero|coop|cat|asia|tel|arpa|onion|example|test|invalid|localhost|local|"
    "dev|app|xyz|online|site|tech|store|shop|cloud|blog|email|mail|live|club|agency|company|digital|design|network|software|systems|solutions|services|"
    "academy|consulting|foundation|institute|university|berlin|wien|london|paris|nyc|tokyo|moscow|"
    "ac|ad|ae|af|ag|ai|al|am|ao|aq|ar|as|at|au|aw|ax|az|ba|bb|bd|be|bf|bg|bh|bi|bj|bm|bn|bo|br|bs|bt|bv|bw|by|bz|ca|cc|cd|cf|cg|ch|ci|ck|cl|cm|cn|co|cr|cu|"
    "cv|cw|cx|cy|cz|de|dj|dk|dm|do|dz|ec|ee|eg|er|es|et|eu|fi|fj|fk|fm|fo|fr|ga|gb|gd|ge|gf|gg|gh|gi|gl|gm|gn|gp|gq|gr|gs|gt|gu|gw|gy|hk|hm|hn|hr|ht|hu|id|"
    "ie|il|im|in|io|iq|ir|is|it|je|jm|jo|jp|ke|kg|kh|ki|km|kn|kp|kr|kw|ky|kz|la|lb|lc|li|lk|lr|ls|lt|lu|lv|ly|ma|mc|md|me|mg|mh|mk|ml|mm|mn|mo|mp|mq|mr|ms|"
    "mt|mu|mv|mw|mx|my|mz|na|nc|ne|nf|ng|ni|nl|no|np|nr|nu|nz|om|pa|pe|pf|pg|ph|pk|pl|pm|pn|pr|ps|pt|pw|py|qa|re|ro|rs|ru|rw|sa|sb|sc|sd|se|sg|sh|si|sj|sk|"
    "sl|sm|sn|so|sr|ss|st|su|sv|sx|sy|sz|tc|td|tf|tg|th|tj|tk|tl|tm|tn|to|tr|tt|tv|tw|tz|ua|ug|uk|us|uy|uz|va|vc|ve|vg|vi|vn|vu|wf|ws|ye|yt|za|zm|zw"
)
_DOT = r"(?:\s{1,3}(?:dot|punto|punkt)\s{1,3}|\.)"
_HOST = rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{0,7}}{_DOT}"
#: A host after a spelled "at" is no article or the like.
_BARE = re.compile(rf"(?<=[A-Za-z0-9._%+-])(?:(?P<at>\s{{1,3}}(?:at|ät|arroba)\s{{1,3}})(?!(?:the|a|an|this|that|each|every|his|her|its|my|our|your|their|one)\s){_HOST}"
                   rf"(?:(?:{_TLD})\b|[A-Za-z]{{2,24}}(?![A-Za-z0-9-])(?!\s{{1,3}}[^\W_]))|@{_HOST}[A-Za-z]{{2,24}}(?![A-Za-z0-9-]))", re.I)
_BARE_PART = re.compile(r"\s{1,3}(?:(?P<at>at|ät|arroba)|dot|punto|punkt)\s{1,3}", re.I)
_SPELLED_DOT = re.compile(r"\s(?:dot|punto|punkt)\s", re.I)


class Rewriting:
    """A rewritten text and the way back: ``edits`` are (start, end, replacement) of the text before, in order."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, self.before, self.after, self.ends, pos, size = [], [], [], [], 0, 0
        for start, end, new in edits:
            parts += (text[pos:start], new)
            size += start - pos
            self.after.append(size)
            self.before.append(start)
            size += len(new)
            self.ends.append((size, end))
            pos = end
        self.text = "".join([*parts, text[pos:]])

    def back(self, span: Span) -> Span:
        """The source span of a span of the rewritten text; a place within a replacement stands for all of it."""
        return self._at(span[0], 0), self._at(span[1] - 1, 1)

    def _at(self, p: int, last: int) -> int:
        k = bisect_right(self.after, p) - 1
        if k >= 0:
            new_end, old_end = self.ends[k]
            if p < new_end:
                return old_end if last else self.before[k]
            return p - new_end + old_end + last
        return p + last


def _edits(pattern: re.Pattern, text: str, new) -> list[tuple[int, int, str]]:
    return [(*m.span(), new(m) if callable(new) else new) for m in pattern.finditer(text)]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Words to digits; the separators between two spelled digits, or round a spelled dot, go with them."""
    out: list[tuple[int, int, str]] = []
    for run in _SPELLED.finditer(text):
        for m in _SPELLED_PART.finditer(text, *run.span()):
            w = (m["digit"] or m.group()).lower()
            new = {"plus": "+", "dot": ".", "point": "."}.get(w) or str(DIGIT_WORDS.get(w, w))
            if m["times"]:
                new *= 2 if m["times"].lower() == "double" else 3
            start, last = m.start(), out[-1] if out and out[-1][0] >= run.start() else None
            if last and not text[last[1]:start].strip(" \t\r\n,-"):
                start = last[1]
            elif new == "." and text[start - 1].isspace():
                start -= 1
            end = m.end()
            if new == "." and end < run.end() and text[end].isspace():
                end += 1
            out.append((start, end, new))
    return out


def _spells_digits(low: str) -> bool:
    """Whether digit words may stand in a run (a cheap test that misses none)."""
    flat = low.replace("-", " ").replace(",", " ").replace("(", " ").replace(")", " ").replace(".", " ")
    found = DIGIT_WORDS.keys() & flat.split()
    return bool(found) and (found != {"un"} or "un un" in " ".join(flat.split()))


def _bare(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _BARE.finditer(text):
        if _SPELLED_DOT.search(m.group()):
            out += [(*p.span(), "@" if p["at"] else ".") for p in _BARE_PART.finditer(text, *m.span())]
    return out


def rewritings(text: str) -> list[Rewriting]:
    """The chain of transducers that change ``text``, in order."""
    out: list[Rewriting] = []

    def apply(edits):
        nonlocal text
        if edits:
            out.append(Rewriting(text, edits))
            text = out[-1].text

    if not text.isascii() and _FAR.search(text) and _ODD.search(text):
        apply([(*m.span(), _LOOKS.get(ord(m.group()), "")) for m in _ODD.finditer(text)])
    low = text.lower()
    if any(x in low for x in ("(at", "[at", "{at", "<at", "( at", "[ at", "{ at", "< at", "ät", "(@", "[@", "{@", "<@", "arroba")):
        apply(_edits(_BRACKET_AT, text, "@"))
    if any(x in low for x in ("(dot", "[dot", "{dot", "<dot", "( dot", "[ dot", "{ dot", "< dot", "(.)", "[.]", "{.}", "<.>", "punkt", "punto", "(point", "[point")):
        apply(_edits(_BRACKET_DOT, text, "."))
    if _spells_digits(low):
        apply(_spelled(text))
    if ("dot" in low or "punto" in low or "punkt" in low) and _SPELLED_DOT.search(text):
        apply(_bare(text))
    return out


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, all spans) of ``text``, by kind, in source characters."""
    base = base_spans(text)
    chain = rewritings(text)
    if not chain:
        return base, base
    full = {k: list(v) for k, v in base.items()}
    for kind, spans in base_spans(chain[-1].text).items():
        for span in spans:
            new = chain[-1].text[slice(*span)]
            for step in reversed(chain):
                span = step.back(span)
            if text[slice(*span)] != new and not any(s <= span[0] and span[1] <= e for s, e in base[kind]):
                full[kind].append(span)
    return base, {k: sorted(set(v)) for k, v in full.items()}


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])


def find_pii(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), n_added, base_sha256, spans.

    ``spans`` holds kind:start:end of base and added spans, by kind (email, ip, card,
    phone) and start; offsets are code points, ends exclusive; ``base_sha256`` is the
    digest of the same string of base spans. Null texts count as empty and have none.
    Repeated rows come out alike; an empty table gives an empty result. Other columns
    are ignored.
    """
    small_batches(docs.sparkSession)
    kind = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,n_added:long,base_sha256:string,spans:string>"

    @F.pandas_udf(kind)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"]
        for texts in batches:
            rows = []
            for t in texts:
                base, full = all_spans(t or "")
                rows.append((*(len(base[k]) for k in KINDS), sum(map(len, full.values())) - sum(map(len, base.values())),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(full)))
            yield pd.DataFrame(rows, columns=names)

    return docs.select(docs["doc_id"].alias("doc_id"), found(docs["text"]).alias("_found")).select("doc_id", "_found.*")


def op7_pii_spans(spark, sf_dir):
    """Personal data in all documents."""
    return find_pii(documents(spark, sf_dir))
