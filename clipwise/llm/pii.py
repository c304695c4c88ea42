"""Personal data: patterns, and a linear-chain CRF over word shapes that adds to them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import table, trimmed

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, made linear: none of them can begin within a run of its first class.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[Span]:
    """The contract's spans, by start, then kind."""
    out: list[Span] = []
    at, after = text.find("@"), 0
    while at >= 0:
        if found := _DOMAIN.match(text, at):
            start = at
            while start > after and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                out.append((start, 0, found.end()))
                after = found.end()
        at = text.find("@", max(at + 1, after))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


#: The small labelled table: words in braces are personal data of the kind before the colon.
LABELLED = """
write to {email:jane.doe@example.com} before friday
contact {email:rené.müller7@mail.example.org} or call the desk
mail {email:łukasz.w@poczta.example.pl} for the notes
ask {email:zoë@example.net} , she knows
his address is {email:k99@mail9.example.com} since may
send it to {email:élise.4821@mail3.example.com} today
die adresse ist {email:jürgen.12@post.example.de} geblieben
el correo es {email:peña.77@correo.example.es} desde ayer
follow @jane on the site and like it
the price @ 20 each is fine
see section 3@left of the page
the host {ip:192.168.0.17} did not answer
from {ip:10.0.254.3} to {ip:172.16.31.200} in one hop
ping {ip:8.8.8.8} again
server {ip:203.0.113.54} is down
version 1.2.3.4000 was released in 2019
release 10.300.2.999 fixes it
section 1.2.3 of the manual
the date 12.05.2021 was a wednesday
chapter 4.1.2.7.9 is long
pay with {card:4111111111111111} or cash
card {card:5500 0000 0000 0004} expires soon
number {card:4012-8888-8888-1881} was charged
both {card:4111111111111111} {card:5555555555554444} were stolen
cards {card:378282246310005} {card:6011111111111117} {card:30569309025904} are tests
karte {card:3530111333300000} gesperrt
order 1234567890123456 was shipped
tracking 9999888877776666 is late
serial 2020202020202020 on the label
id 8273645519283745 in the log
call {phone:+1 (212) 555-0147} after nine
phone {phone:+49 30 901820} office
ring {phone:+44 20 7946 0958} please
tel {phone:+33 1 70 18 99 00} le matin
llame al {phone:+34 912 345 678} hoy
the {phone:+1 (415) 555-2671} line is open
call {phone:(212) 555-0147} after nine
desk {phone:(030) 901-8200} is closed
fax {phone:(415) 555-2671} works
scores were 21-19 and 21-17 again
in 2019-2021 we sold 300 units
pages 100-199 are missing
1 (one) or 2 (two) items
at 10:30 on 2024-01-15 it began
about 3.14 or 2.718 in maths
a total of 1,234,567.89 was paid
token = b99e99e99fd999c9cf9999b99d9a9
key a8f5f167f44f4964e6c998dee827110c is secret
licensed under cc by-nc 4.0 there
the gnu general public license , version 3.
room 4021 on floor 12 is free
we had 99 problems and 2000 answers
call me in 5 minutes or 10
from 1999 to 2005 he lived there
flight 447 left gate 12 late
the year 1984 was cold
question 7 of 30 , please
isbn 9780306406157 is a book
it costs $45.00 plus 8% tax
http://example.com/a/12345?id=678 is the link
the 3rd and the 22nd were best
0 1 2 3 4 5 6 7 8 9 10
reach me at {email:jane (at) example (dot) com} any day
write {email:bob (at) mail.example.org} to join
it is {email:k.lee [at] example [dot] net} , she says
ask {email:ana [at] correo.example.es} for more
send to {email:tom at example dot com} before noon
mail {email:rita dot b at example dot org} please
contact {email:lars(at)example.com} or come by
der kontakt ist {email:uwe (at) beispiel (punkt) de} heute
escribe a {email:eva (arroba) ejemplo (punto) es} hoy
mail {email:jo_7 (at) mail2 (dot) example (dot) com} now
we met at the station and left
look at the dot on the map
a dot at the end of line 3
she was at home (at last) with us
stay at example street 12 until may
put the dot com bubble behind you
meet me at noon , dot the i
an error [at line 12] was raised
pay by {card:4111.1111.1111.1111} at once
card {card:4012/8888/8888/1881} was used
visa {card:5500_0000_0000_0004} is blocked
amex {card:3782.822463.10005} has expired
nummer {card:4532.0151.1283.0366} gesperrt
the sum 4111.1111.1111.1112 is wrong
part 1234.5678.9012.3456 is out of stock
file 2019_0412_1530_0001 was lost
call {phone:212-555-0147} after nine
desk {phone:(212) 555-0147} is open
ring {phone:020 7946 0958} please
tel {phone:030/901820} im haus
telefon {phone:0171 2345678} ab acht
phone {phone:0049 30 901820} office
call {phone:555-0147} now
cell {phone:415.555.2671} only
fax {phone:089 / 636 480} works
tel {phone:01 70 18 99 00} le matin
llame {phone:912 345 678} hoy
number {phone:415-555-2671} or come
the score was 212-555 at the end
in 2019 7946 people came
from 10 to 20 , 30 at most
rooms 020 and 7946 are free
size 30/90 fits best
dates 01.05.2019 and 03/04/2021 are free
it was 1984-12-31 or 31-12-1984
ratio 16/9 or 4/3 , not 21/9
ids 4021-77 and 99-1203 are old
between 100-200 and 300-400 units
route 66 and 101 , exit 25
the years 2001 2002 2003 2004 were dry
"""

TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_MARK = re.compile(r"\{(\w+):([^}]*)\}")
_WORD = re.compile(r"\S+")
_EDGE = re.compile(r"^[^\w+(]+|[^\w)]+$")
#: Words that stand for @ and . in a mail address that is spelled out.
_AT, _DOT = frozenset(("at", "arroba", "chez")), frozenset(("dot", "punto", "punkt", "point"))
_OF = str.maketrans({**{c: "9" for c in "0123456789"}, **{chr(c): "x" for c in range(97, 123)}, **{chr(c): "X" for c in range(65, 91)}})
_RUN = re.compile(r"(.)\1+")


_ALTERNATE = re.compile(r"(?:9x){2,}|(?:x9){2,}|(?:9X){2,}|(?:X9){2,}")


def _shape(word: str) -> str:
    if (bare := word.lower().strip("()[]{}")) in _AT or bare in _DOT:
        return ("AT" if bare in _AT else "DOT") + ("()" if bare != word.lower() else "")
    s = "".join(c if c < "\x80" else "x" if c.isalnum() else "#" for c in word.translate(_OF))
    return _ALTERNATE.sub(lambda m: m[0][:2], _RUN.sub(r"\1", s))


_kept_shape = lru_cache(maxsize=100_000)(_shape)


def shape(word: str) -> str:
    """Letters x or X, digits 9, other letters x, other marks as they are; runs once, and so letters that alternate with digits.

    Words for @ and . in spelled-out addresses are shapes of their own, AT and DOT, with () in brackets.
    """
    return _kept_shape(word) if len(word) <= 64 else _shape(word)


def _one(word: str) -> list[str]:
    digits = _digits(word)
    s = shape(word)
    groups = "-".join(str(len(g)) for g in re.findall("[0-9]+", word)) if len(word) <= 64 else "long"
    out = [f"s={s}", f"n={len(digits)}", f"k={'9' in s}{'x' in s.lower()}", f"g={s}|{groups}", f"z={s}|{word[:1] == '0'}"]
    if "@" in word:
        user, _, host = word.partition("@")
        out.append(f"at={bool(user)}{bool(re.fullmatch(r'[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+', host))}")
    if s == "9.9.9.9":
        out.append(f"ip={all(len(p) <= 3 and int(p) <= 255 for p in word.split('.'))}")
    if 12 <= len(digits) <= 19 and set(s) <= set("9-./_"):
        out.append(f"luhn={luhn(digits)}")
    return out


def features(words: list[str]) -> list[list[str]]:
    """Shape features of each word, and the shapes around it."""
    own = [_one(w) for w in words]
    shapes = ["<", *(shape(w) for w in words), ">"]
    digits = ["", *(str(len(_digits(w))) for w in words), ""]
    return [
        [*f, f"p={shapes[i]}", f"q={shapes[i + 2]}", f"ps={shapes[i]}|{shapes[i + 1]}", f"sq={shapes[i + 1]}|{shapes[i + 2]}", f"dq={digits[i + 1]}|{digits[i + 2]}|{shapes[i + 1]}"]
        for i, f in enumerate(own)
    ]


def examples(lines: str = LABELLED) -> list[tuple[list[str], list[int]]]:
    out = []
    for line in filter(None, map(str.strip, lines.splitlines())):
        words, tags, at = [], [], 0
        for m in [*_MARK.finditer(line), None]:
            plain = line[at : m.start() if m else len(line)].split()
            words += plain
            tags += [0] * len(plain)
            if m:
                part = m[2].split()
                words += part
                b = TAGS.index(f"B-{m[1]}")
                tags += [b] + [b + 1] * (len(part) - 1)
                at = m.end()
        out.append((words, tags))
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class CRF:
    """Weights of features by tag and of tag pairs; trained by forward-backward, decoded by Viterbi."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.emit = np.zeros((0, len(TAGS)))
        self.move = np.zeros((len(TAGS) + 1, len(TAGS)))  # the last row is the start

    def train(self, data: list[tuple[list[str], list[int]]], steps: int = 150, ridge: float = 0.02, rate: float = 0.3) -> CRF:
        """Full-batch AdaGrad on the penalised log-likelihood; the same data give the same weights."""
        feats = [features(w) for w, _ in data]
        self.index = {f: i for i, f in enumerate(sorted({f for s in feats for t in s for f in t}))}
        ids = [[[self.index[f] for f in t] for t in s] for s in feats]
        k = len(TAGS)
        self.emit = np.zeros((len(self.index), k))
        g_emit, g_move = np.full_like(self.emit, 1e-6), np.full_like(self.move, 1e-6)
        for _ in range(steps):
            d_emit, d_move = -ridge * self.emit, -ridge * self.move
            for rows, (_, tags) in zip(ids, data, strict=True):
                e = np.array([self.emit[r].sum(axis=0) for r in rows])
                n = len(e)
                a, b = np.zeros((n, k)), np.zeros((n, k))
                a[0] = self.move[k] + e[0]
                for t in range(1, n):
                    a[t] = _lse(a[t - 1][:, None] + self.move[:k], 0) + e[t]
                for t in range(n - 2, -1, -1):
                    b[t] = _lse(self.move[:k] + (e[t + 1] + b[t + 1])[None], 1)
                z = _lse(a[-1], 0)
                p = np.exp(a + b - z)
                for t in range(n):
                    grad = -p[t]
                    grad[tags[t]] += 1
                    np.add.at(d_emit, rows[t], grad)
                    if t:
                        pair = np.exp(a[t - 1][:, None] + self.move[:k] + (e[t] + b[t])[None] - z)
                        d_move[:k] -= pair
                        d_move[tags[t - 1], tags[t]] += 1
                    else:
                        d_move[k] += grad
            g_emit += d_emit**2
            g_move += d_move**2
            self.emit += rate * d_emit / np.sqrt(g_emit)
            self.move += rate * d_move / np.sqrt(g_move)
        for tag, name in enumerate(TAGS):  # an inside follows only its own kind
            if name[0] == "I":
                self.move[[i for i in range(k + 1) if i not in (tag, tag - 1)], tag] = -1e9
        return self

    def decode(self, sentences: list[list[str]]) -> list[np.ndarray]:
        """The best tags of every sentence, a batch at a time; sentences of like length share one."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(sentences)
        order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
        k, at = len(TAGS), 0
        while at < len(order):
            size = max(1, min(512, 400_000 // max(1, len(sentences[order[min(at + 511, len(order) - 1)]]))))
            batch, at = order[at : at + size], at + size
            longest = len(sentences[batch[-1]])
            if not longest:
                continue
            e = np.zeros((len(batch), longest, k))
            for row, i in enumerate(batch):
                for t, feats in enumerate(features(sentences[i])):
                    if known := [j for f in feats if (j := self.index.get(f)) is not None]:
                        e[row, t] = self.emit[known].sum(axis=0)
            lengths = np.array([len(sentences[i]) for i in batch])
            score = self.move[k] + e[:, 0]
            back = np.zeros((longest, len(batch), k), np.int8)
            for t in range(1, longest):
                ways = score[:, :, None] + self.move[None, :k]
                back[t] = ways.argmax(axis=1)
                score = np.where((t < lengths)[:, None], ways.max(axis=1) + e[:, t], score)
            tags = np.zeros((len(batch), longest), int)
            best = score.argmax(axis=1)
            for t in range(longest - 1, -1, -1):
                tags[:, t] = best
                best = np.where(t < lengths, back[t][np.arange(len(batch)), best], best) if t else best
            for row, i in enumerate(batch):
                out[i] = tags[row, : lengths[row]]
        return out


@lru_cache(maxsize=1)
def trained() -> CRF:
    return CRF().train(examples())


_SPECIAL = re.compile(r"[0-9@]|[(\[{](?:at|arroba|chez|dot|punto|punkt|point)[)\]}]|(?<!\S)dot(?!\S)", re.I)
AROUND = 5


def _windows(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words (start, end without outer marks) around words with a digit, an @ or a word for @ or a dot.

    Elsewhere every word is a plain one, whose best tag is O whatever stands AROUND words away.
    """
    out: list[list[tuple[int, int]]] = []
    done = 0
    for m in _SPECIAL.finditer(text):
        if m.start() < done:
            continue
        left: list[tuple[int, int]] = []
        a = m.start()
        while a > done and not text[a - 1].isspace():
            a -= 1
        first = a
        while a > done and len(left) < AROUND:
            b = a
            while b > done and text[b - 1].isspace():
                b -= 1
            a = b
            while a > done and not text[a - 1].isspace():
                a -= 1
            if a < b:
                left.append((a, b))
        words, quiet, at = left[::-1], 0, first
        while quiet < AROUND and (w := _WORD.search(text, at)):
            words.append(w.span())
            quiet = 0 if _SPECIAL.search(w[0]) else quiet + 1
            at = done = w.end()
        out.append(words)
    return out


def all_spans(texts: list[str], model: CRF) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and base with the model's spans, of every text."""
    base = [base_spans(t) for t in texts]
    whole = [(i, ws) for i, t in enumerate(texts) for ws in _windows(t)]
    trimmed = []
    for i, ws in whole:
        row = []
        for a, b in ws:
            word = texts[i][a:b]
            lead = _EDGE.match(word)
            a2 = a + (lead.end() if lead and lead.end() < len(word) else 0)
            tail = re.search(r"[^\w)]+$", texts[i][a2:b])
            row.append((a2, a2 + tail.start() if tail and tail.start() else b))
        trimmed.append(row)
    tags = model.decode([[texts[i][a:b] for a, b in row] for (i, _), row in zip(whole, trimmed, strict=True)])
    added: list[set[Span]] = [set() for _ in texts]
    for (i, _), row, seq in zip(whole, trimmed, tags, strict=True):
        t = 0
        while t < len(row):
            if seq[t] and TAGS[seq[t]][0] == "B":
                kind, end = (seq[t] - 1) // 2, t + 1
                while end < len(row) and seq[end] == seq[t] + 1:
                    end += 1
                span = (row[t][0], int(kind), row[end - 1][1])
                if _plausible(texts[i][span[0] : span[2]], span[1]):
                    added[i].add(span)
                t = end
            else:
                t += 1
    out = []
    for b, more in zip(base, added, strict=True):
        own = set(b)
        # A span within one of the same kind that is there already says nothing new.
        new = [s for s in more if not any(k == s[1] and a <= s[0] and s[2] <= e for a, k, e in own)]
        out.append((b, sorted([*b, *new])))
    return out


_SPELLED = re.compile(r"\S\s*(?:@|[(\[{](?:at|arroba|chez)[)\]}]|\s(?:at|arroba|chez)\s)\s*\S.*?(?:\.|[(\[{](?:dot|punto|punkt|point)[)\]}]|\s(?:dot|punto|punkt|point)\s)\s*\S", re.I | re.S)


def _plausible(s: str, kind: int) -> bool:
    """Whether a span could be of its kind at all: a mail address has an @ and a dot or words for them, others enough digits."""
    digits = len(_digits(s))
    return (bool(_SPELLED.search(s)), s.count(".") >= 3 and digits >= 4, 12 <= digits <= 19, 7 <= digits <= 15)[kind]


SPAN_TYPE = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans``, arrays of (kind, start, end), to every row.

    Offsets count code points, ends are exclusive, order is by start, then kind. ``base`` are the patterns'
    spans; ``spans`` are those and what the model adds: spelled-out mail addresses, local phone numbers, cards grouped by other
    marks. Whole texts are read, in one pass and without a shuffle; every step is linear in the text, also of a very long one.
    A null text is an empty one and has no spans. Repeated rows get equal results each, an empty table gives no rows.
    Columns named ``base`` or ``spans`` are replaced.
    """
    docs = docs.drop("base", "spans")
    schema = StructType([*docs.schema.fields, StructField("base", SPAN_TYPE), StructField("spans", SPAN_TYPE)])
    model = trained()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                both = all_spans([t or "" for t in batch.column(text_col).to_pylist()], model)
                named = [[[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in part] for part in zip(*both, strict=True)]
                yield batch.append_column("base", pa.array(named[0], kind)).append_column("spans", pa.array(named[1], kind))

    return docs.mapInArrow(trimmed(run), schema)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with its spans replaced by their kind in brackets; overlapping spans become one.

    Null stays null, empty stays empty, repeated rows are changed alike, an empty table gives no rows; whole texts are read,
    and the other columns, whatever their names, stay as they are.
    """
    model = trained()
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                texts = batch.column(text_col).to_pylist()
                clean = [t if t is None else _replace(t, s) for t, (_, s) in zip(texts, all_spans([t or "" for t in texts], model), strict=True)]
                yield batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(clean, pa.string()))

    return docs.mapInArrow(trimmed(run), schema)


def _replace(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest columns of ``find``; the counts are of base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, base, spans = (batch.column(c).to_pylist() for c in ("doc_id", "base", "spans"))
            tuples = lambda xs: [(x["start"], KINDS.index(x["kind"]), x["end"]) for x in xs]
            b = [tuples(x) for x in base]
            counts = [[sum(s[1] == k for s in x) for x in b] for k in range(4)]
            digests = [hashlib.sha256(_joined(x).encode()).hexdigest() for x in b]
            cols = [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in counts), digests, [_joined(tuples(x)) for x in spans]]
            yield pa.record_batch(cols, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "base", "spans")
    return found.mapInArrow(trimmed(run), schema)
