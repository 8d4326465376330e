"""Personal data, also in disguise, with offsets into the source text.

Base patterns run on the text itself.  Then transducers rewrite disguises and
keep, for every character they write, the span of the source it came from:
look-alike characters become ASCII, spelled digits become digits, "(at)" and
"dot" become signs.  The patterns run once more on what was written, and matches
that rest on a rewriting are mapped back to spans of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from rivulet.llm.common import table

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match starts where its run of digits starts; saying so keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Local part, @, domain; searched from each @, so long words stay linear."""
    found, free, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, sign + 1) if start < sign else None
        if m:
            found.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, start)
        sign = text.find("@", max(free, sign + 1))
    return found


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _parts_ok(ip: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in ip.split("."))


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in order of start, then kind;
    per kind leftmost and non-overlapping, failing matches dropped."""
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _parts_ok(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


# ---------------------------------------------------------------- transducers
class Written:
    """A text written by transducers over a source, with the way back: layers of
    replacements, each a few numbers, so memory grows with what was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self._layers: list[tuple[list[int], list[int], list[int], list[int]]] = []

    def rewrite(self, changes: list[tuple[int, int, str]]) -> Written:
        """Each (start, end, new) in order: ``new``, whose characters all stand for the
        whole of start..end, in place of what is there."""
        if not changes:
            return self
        out, at, n = [], 0, 0
        place, size, start, end = [], [], [], []  # of what is written, and of its source
        for s, e, new in changes:
            out += (self.text[at:s], new)
            n += s - at
            place.append(n)
            size.append(len(new))
            start.append(s)
            end.append(e)
            n += len(new)
            at = e
        out.append(self.text[at:])
        w = Written("".join(out))
        w._layers = [*self._layers, (place, size, start, end)]
        return w

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of start..end (end exclusive, not empty)."""
        for place, size, was, until in reversed(self._layers):
            i = bisect_right(place, start) - 1
            if i >= 0:
                inside = start < place[i] + size[i]
                begin = was[i] if inside else until[i] + start - place[i] - size[i]
            else:
                begin = start
            i = bisect_right(place, end - 1) - 1
            if i >= 0:
                inside = end - 1 < place[i] + size[i]
                last = until[i] if inside else until[i] + end - place[i] - size[i]
            else:
                last = end
            start, end = begin, last
        return start, end


# --- look-alikes: character to character
# Letters of other scripts that look like ASCII ones, by script, and
# marks that look like signs.  Everything else follows from Unicode's own data (see
# _plain): digits of all scripts, wide, styled, circled and small-capital letters,
# letters with accents, dashes, blanks, and what is not seen.
_ALIKE = dict(
    zip(
        "аеорсухіјѕԁһԛԝвкмнтгиѵґӏ" + "АВЕЅІЈКМНОРСТУХԌԚԜ" + "αβγικνορτυχωϲϳ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ" + "օսոհցզլյ" + "ƍɑɡɩʋ" + "ᎪᏴᏟᎠᎬᏀᎻᎥᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ",
        "aeopcyxijsdhqwbkmhtruvrl" + "ABESIJKMHOPCTYXGQW" + "aByiKvopTuxwcj" + "ABEZHIKMNOPTYXC" + "ounhgqlj" + "gagiu" + "ABCDEGHiJKLMPRSTVWZ",
    )
)
_SIGNS = dict.fromkeys("。․‧•∙⋅·｡", ".") | {"➕": "+", "⁺": "+", "−": "-"}
_STYLED = re.compile(r"(?:LATIN (?:SMALL|CAPITAL) LETTER|LATIN LETTER SMALL CAPITAL|REGIONAL INDICATOR SYMBOL LETTER)(?: DOTLESS| SCRIPT)? ([A-Z])$")


def _plain(c: str) -> str:
    """The ASCII character that ``c`` stands for; "" if unseen; ``c`` if none."""
    if c in _ALIKE:
        return _ALIKE[c]
    if c in _SIGNS:
        return _SIGNS[c]
    kind = unicodedata.category(c)
    if kind in ("Cf", "Mn", "Me"):
        return ""
    if kind == "Pd":
        return "-"
    if kind == "Zs":
        return " "
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    wide = [x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)]
    if len(wide) == 1 and wide[0].isascii():
        return wide[0]
    name = _STYLED.search(unicodedata.name(c, ""))
    return (name[1] if "CAPITAL LETTER" in unicodedata.name(c) else name[1].lower()) if name else c


_PLAIN: dict[str, str] = {}


def _lookalikes(text: str) -> Written:
    odd = {c for c in set(text) if not c.isascii()}
    for c in odd:
        if c not in _PLAIN:
            _PLAIN[c] = _plain(c)
    w = Written(text)
    unseen = "".join(c for c in odd if not _PLAIN[c])
    change = {ord(c): _PLAIN[c] for c in odd if _PLAIN[c] and _PLAIN[c] != c}
    # letters alone matter in addresses only
    if change and ("@" in text or any(not x.isalpha() for x in change.values()) or unseen or _may_hide(text)):  # one for one: every place stays
        w.text = text.translate(change)
    if unseen:
        w = w.rewrite([(m.start(), m.end(), "") for m in re.finditer(f"[{re.escape(unseen)}]+", w.text)])
    return w


# --- spelled digits: words of a run to digits and signs
# Names of the digits in the languages of the corpus, further English
# number words, signs, and letters that stand for digits.
_DIGIT_NAMES = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
}
_TEENS = "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen"
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety"
_TIMES = {"double": 2, "triple": 3}
_SIGN_NAMES = {"plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": ".", "dash": "-", "hyphen": "-"}
_LETTER_DIGITS = str.maketrans("OoIl|", "00111")
_DIGITS_ONLY = frozenset("0123456789OoIl|")

_UNIT = {_fold: str(v) for names in _DIGIT_NAMES.values() for v, name in enumerate(names.split()) for _fold in (name, name.translate({0xFC: "u", 0xE9: "e"}))}
_UNIT |= {"oh": "0", "zwo": "2", "une": "1"}
_VALUE = _UNIT | {name: str(10 + i) for i, name in enumerate(_TEENS.split())} | {name: str(10 * i) for i, name in enumerate(_TENS.split(), 2)}


def _any_of(words) -> str:
    """A pattern of the words (a letter's words share its branch, longer ones first)."""
    heads: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        heads.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{h}(?:{'|'.join(map(re.escape, tails))})" for h, tails in sorted(heads.items())) + ")"


# these patterns read the text in small letters
_NUMBER_WORDS = frozenset(w.encode() for w in (*_VALUE, *_TIMES))
_APART = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_SIGN_BY_DIGIT = re.compile(rf"[0-9]{{1,3}} {_any_of(_SIGN_NAMES)} [0-9]|\bplus [0-9]")
_ODD_NUMBER = re.compile(r"[0-9](?:[oil|]|(?<=[oil|][0-9]))")
_TOKEN = re.compile(rf"\b(?P<name>{_any_of([*_VALUE, *_TIMES, *_SIGN_NAMES])})\b|(?<![a-z0-9])(?P<digits>[0-9oil|]*[0-9][0-9oil|]*)(?![a-z0-9])")
_BETWEEN = re.compile(r"[ \t\-.,()/]{0,3}$")
_LEAST_DIGITS = 4


def _run_changes(text: str, run: list[re.Match]) -> list[tuple[int, int, str]]:
    """The digits and signs that the tokens of a run spell; nothing if there are few."""
    while run and run[-1]["name"] and run[-1]["name"].lower() in (*_SIGN_NAMES, *_TIMES):
        run.pop()
    while run and run[0]["name"] and run[0]["name"].lower() in _SIGN_NAMES and run[0]["name"].lower() != "plus":
        run.pop(0)
    out: list[tuple[int, int, str]] = []
    digits, spelled, i = 0, False, 0
    while i < len(run):
        m = run[i]
        start, end = m.span()
        if m["digits"]:
            new = text[start:end].translate(_LETTER_DIGITS)
            spelled |= new != text[start:end]
        else:
            spelled, name = True, m["name"].lower()
            after = run[i + 1]["name"].lower() if i + 1 < len(run) and run[i + 1]["name"] else ""
            if name in _TIMES:
                if after not in _UNIT:
                    return []
                new, end, i = _UNIT[after] * _TIMES[name], run[i + 1].end(), i + 1
            elif name in _SIGN_NAMES:
                new = _SIGN_NAMES[name]
                if new == "+" and i:
                    return []
            else:
                new = _VALUE[name]
                if name in _TENS and after in _UNIT and _UNIT[after] != "0" and "." not in text[end : run[i + 1].start()]:
                    new, end, i = new[0] + _UNIT[after], run[i + 1].end(), i + 1
        if out:  # what stands between: a full stop stays, blanks and the like go
            gap = text[out[-1][1] : start]
            if gap:
                out.append((out[-1][1], start, "." if "." in gap else ""))
        out.append((start, end, new))
        digits += sum(c.isdigit() for c in new)
        i += 1
    return [c for c in out if text[c[0] : c[1]] != c[2]] if spelled and digits >= _LEAST_DIGITS else []


def _small(text: str) -> str:
    """Small letters, place for place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _numbers_meet(low: str) -> bool:
    """Whether a spelled number stands beside another number; most texts have none."""
    words = low.encode("utf-8", "surrogatepass").translate(_APART).split()
    if _NUMBER_WORDS.isdisjoint(words):
        return False
    numbers = [w in _NUMBER_WORDS or 48 <= w[0] <= 57 for w in words]
    return any(a and b for a, b in zip(numbers, numbers[1:]))


def _spelled_digits(w: Written) -> Written:
    text, low = w.text, _small(w.text)
    if not _numbers_meet(low):
        if not _DIGIT.search(low):
            return w
        if not _ODD_NUMBER.search(low) and not (any(name in low for name in _SIGN_NAMES) and _SIGN_BY_DIGIT.search(low)):
            return w
    changes: list[tuple[int, int, str]] = []
    run: list[re.Match] = []
    for m in _TOKEN.finditer(low):
        plus = m["name"] == "plus"
        odd = m["digits"] and not _DIGITS_ONLY.issuperset(text[m.start() : m.end()])  # "i" is no 1
        if run and (plus or odd or m.start() - run[-1].end() > 3 or not _BETWEEN.match(text[run[-1].end() : m.start()])):
            changes += _run_changes(text, run)
            run = []
        if not odd:
            run.append(m)
    changes += _run_changes(text, run)
    return w.rewrite(changes)


# --- at and dot: markers of an address to signs
# Words for the signs, endings of addresses that stand without
# brackets, those among them that are words of their own, and words that are no names.
_AT_WORDS = "at|arroba|arobase"
_DOT_WORDS = "dot|punkt|punto|point"
_SURE_AT = ("arroba", "arobase")
_ENDINGS = frozenset(
    "com net org edu gov info biz io co eu uk de fr es ch nl it me us at be no in is to ai dev app pl pt ru se dk fi cz "
    "ie ca au nz jp cn br mx ar tv cc xyz online site shop".split()
)
_WORD_ENDINGS = frozenset("it me us at be no in is to so my co de es online site shop app".split())
_NO_NAMES = frozenset(
    "a an the this that these those my your our his her its their one each every any some no look looks looked looking "
    "is are was were be been and or of in on".split()
)
_BLANK = r"[ \t]"
_MARKER = re.compile(
    rf"{_BLANK}{{0,3}}[\[({{<]{{1,2}}{_BLANK}{{0,3}}(?:(?P<at>{_AT_WORDS}|a|@)|(?P<dot>{_DOT_WORDS}|d0t|\.)){_BLANK}{{0,3}}[\])}}>]{{1,2}}{_BLANK}{{0,3}}"
    rf"|(?<=[A-Za-z0-9])(?P<edge>[-_*/])(?:(?P<at2>{_AT_WORDS})|(?P<dot2>{_DOT_WORDS}))(?P=edge)(?=[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9]){_BLANK}{{1,3}}(?:(?P<at3>{_AT_WORDS}|@)|(?P<dot3>{_DOT_WORDS})){_BLANK}{{1,3}}(?=[A-Za-z0-9])"
    r"|(?<=[A-Za-z0-9])(?:(?P<at4>@)|(?P<dot4>\.))(?=[A-Za-z0-9])",
    re.I,
)
_DISGUISED = re.compile(
    rf"[\[({{<]{_BLANK}{{0,3}}(?:{_AT_WORDS}|a|@|{_DOT_WORDS}|d0t|\.){_BLANK}{{0,3}}[\])}}>]|[-_*/](?:{_AT_WORDS})[-_*/]"
    rf"|{_BLANK}(?:{_DOT_WORDS}|arroba|arobase|@){_BLANK}",
    re.I,
)
_OPEN_AT = re.compile(rf"[\[({{<]{_BLANK}{{0,3}}(?:{_AT_WORDS}|a|@){_BLANK}{{0,3}}[\])}}>]")
_ANY_AT = re.compile(rf"@|(?<![A-Za-z0-9])(?:{_AT_WORDS}|a)(?![A-Za-z0-9])", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}$")
_LOCAL_WORD = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_FIRST_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")
_ENDING = re.compile(r"[A-Za-z]{2,24}(?![A-Za-z0-9_-])")
_CLAUSE_END = re.compile(r"[ \t]*(?:[.,;:!?)\]>\"'\r\n]|$)")


@dataclass
class _Marker:
    start: int
    end: int
    sign: str
    how: str  # bracket, bare or plain

    @staticmethod
    def of(m: re.Match) -> _Marker:
        kind = m.lastgroup if m.lastgroup != "edge" else None
        kind = next(k for k in ("at", "dot", "at2", "dot2", "at3", "dot3", "at4", "dot4") if m[k] is not None)
        how = {"3": "bare", "4": "plain"}.get(kind[-1], "bracket")
        if how == "bare" and m[kind].lower() in (*_SURE_AT, "@"):
            how = "bracket"
        return _Marker(m.start(), m.end(), "@" if kind.startswith("at") else ".", how)


def _address_changes(text: str, marks: list[_Marker], j: int) -> list[tuple[int, int, str]]:
    """The signs of the address around the at of marker ``j``, if it is one."""
    at = marks[j]
    lo = j
    while lo and marks[lo - 1].sign == "." and marks[lo].start - marks[lo - 1].end <= 64 and _LOCAL_WORD.match(text[marks[lo - 1].end : marks[lo].start]):
        lo -= 1
    name = _LOCAL_WORD.search(text[max(0, marks[lo].start - 64) : marks[lo].start])
    if not name:
        return []
    hi = j
    while hi + 1 < len(marks) and marks[hi + 1].sign == "." and marks[hi + 1].start - marks[hi].end <= 63 and _LABEL.match(text[marks[hi].end : marks[hi + 1].start]):
        hi += 1
    label = _FIRST_LABEL.match(text, at.end)
    bare = at.how == "bare"
    if bare and (not label or label[0].lower() in _NO_NAMES or name[0].lower() in _NO_NAMES):
        return []
    while hi > j:
        ending = _ENDING.match(text, marks[hi].end)
        dots = {m.how for m in marks[j + 1 : hi + 1]}
        if ending and _ending_fits(text, ending, bare, dots):
            return [(m.start, m.end, m.sign) for m in marks[lo : hi + 1] if m.how != "plain"]
        hi -= 1
    return []


def _ending_fits(text: str, ending: re.Match, bare: bool, dots: set[str]) -> bool:
    word = ending[0].lower()
    if "bracket" in dots or (not bare and dots == {"plain"}):
        return True
    if bare and "bare" not in dots:
        return False  # "meet at place.com" is prose
    if word in _WORD_ENDINGS:
        return bool(_CLAUSE_END.match(text, ending.end()))
    return word in _ENDINGS or (not bare and word not in _NO_NAMES)


def _may_hide(text: str) -> bool:
    """Whether any disguise of a sign can stand in the text; by plain searches."""
    low = text.lower()
    if "@" in low or "dot" in low or any(x in low for x in _SURE_AT):
        return True
    if any(x in low for x in "[({<") and _OPEN_AT.search(low):
        return True
    return "at" in low and any(x in low for x in ("punkt", "punto", "point", "d0t"))


def _addresses(w: Written) -> Written:
    text = w.text
    if not _may_hide(text) or not _DISGUISED.search(text) or not _ANY_AT.search(text):
        return w
    marks = [_Marker.of(m) for m in _MARKER.finditer(text)]
    changes: list[tuple[int, int, str]] = []
    for j, m in enumerate(marks):
        if m.sign == "@" and (not changes or changes[-1][1] <= m.start):
            found = _address_changes(text, marks, j)
            changes += [c for c in found if not changes or c[0] >= changes[-1][1]]
    return w.rewrite(changes)


def deobfuscate(text: str) -> Written | None:
    """The text with disguises undone, or None if it has none.  Every transducer reads
    the text once and looks a bounded number of characters ahead."""
    w = Written(text) if text.isascii() else _lookalikes(text)
    w = _addresses(_spelled_digits(w))
    return None if w.text == text else w


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """``(base, added)`` spans as (start, kind, end).  Added ones come from undone
    disguises and touch no base span."""
    base = identifiers(text)
    w = deobfuscate(text)
    if w is None:
        return base, []
    covered = bytearray(len(text))
    for s, _, e in base:
        covered[s:e] = b"\1" * (e - s)
    added = []
    for s, kind, e in identifiers(w.text):
        start, end = w.source(s, e)
        if text[start:end] != w.text[s:e] and not any(covered[start:end]):
            added.append((start, kind, end))
    return base, added


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[] for _ in range(7)]
        for t in b.column(1):
            base, added = find(t.as_py() or "")
            for k in range(4):
                out[k].append(sum(x[1] == k for x in base))
            out[4].append(hashlib.sha256(spell(base).encode()).hexdigest())
            out[5].append(spell(base + added))
            out[6].append(len(added))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(v, k) for v, k in zip(out, kinds))], ["doc_id", *_COLUMNS]
        )


_COLUMNS = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]


def personal_data(docs: DataFrame) -> DataFrame:
    """A row per document row: counts of the base spans of each kind, the digest of
    their list, all spans, and how many were added by undoing disguises.
    Offsets are code points, end exclusive.  Null texts are empty; a text without
    spans has an empty list; other columns are ignored; no shuffle."""
    return docs.select("doc_id", "text").mapInArrow(
        _run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )


def op6_pii(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
