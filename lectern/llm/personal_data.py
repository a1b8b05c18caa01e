"""Personal data: four fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import textkit
from lectern.llm.staging import as_ddl, map_rows, prepare, table, whole_numbers

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    # as a scan from the left: each @ with the run of local characters before it, none of them in the last match
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        done = m.end() if m else done
        if m:
            yield start, done, "email"
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test, by start, then kind as listed."""
    found = list(_emails(text))
    found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups())]
    found += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]
    found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


#: The labelled table: entities in braces after their kind.
LABELLED = (
    "please write to {email ann.lee@mail.example.org} before noon",
    "contact {email j_smith42@example.com} for details",
    "sent from {email root@localhost} last night",
    "mail {email bob (at) example (dot) org} and wait",
    "ask {email maria [at] example [dot] net} about it",
    "her address is {email kim@intranet} they said",
    "{email info@example.org} answers within a day",
    "write to {email tom at example.org} for more",
    "mail {email jane.doe at mail.example.net} today",
    "send it to {email lee at example dot com} please",
    "her email is {email s.kim at post.example.edu} now",
    "email {email sales [at] example.com} with orders",
    "reach me on {email me(at)example.net} any time",
    "e-mail: {email old.man (at) sea.example.org}",
    "contact: {email help@support}",
    "the host {ip 10.0.0.12} was down again",
    "logged in from {ip 192.168.4.20} at night",
    "peer {ip fe80:0:0:0:202:b3ff:fe1e:8329} joined",
    "route via {ip 2001:db8:85a3:0:0:8a2e:370:7334} failed",
    "from {ip 2001:db8::ff00:42:8329} again",
    "server {ip fe80::1ff:fe23:4567:890a} is up",
    "address {ip ::1} is local",
    "ping {ip 2001:db8::1} twice",
    "pay with {card 4111 1111 1111 1111} today",
    "card {card 5500-0000-0000-0004} was refused",
    "number {card 4111.1111.1111.1111} on file",
    "charged {card 340000000000009} twice",
    "visa {card 4111-1111.1111 1111} expired",
    "card no {card 5105/1051/0510/5100} is hers",
    "billed to {card 6011.0009.9013.9424} in may",
    "credit card: {card 3566_0020_2036_0505}",
    "call {phone +1 (555) 010-9999} after six",
    "phone {phone +49 30 1234567} or come by",
    "dial {phone (030) 123-4567} for the desk",
    "ring {phone (212) 555-0147} and ask",
    "fax {phone 020 7946 0123} is old",
    "tel {phone 555-010-1234} works too",
    "mobile {phone 0171-555-0199} is off",
    "call {phone 030 1234567} now",
    "phone: {phone 089 98765432}",
    "telephone {phone 040-1234567} rings",
    "tel. {phone 0221/9876543} or mail",
    "call me at {phone 555.010.4321} tonight",
    "text {phone 07700 900123} if late",
    "whatsapp {phone 0044 7700 900456} works",
    "the number is {phone 01 42 68 53 00} in paris",
    "reach us on {phone (01) 4268 5300} daily",
    "hotline {phone 0800 1234567} is free",
    "cell {phone 917 555 0123} is new",
    "appelez le {phone 06 12 34 56 78} ce soir",
    "ring me on {phone 06 22 33 44 55} please",
    "son numero est {phone 05 61 22 33 44} je crois",
    "my phone is {phone 0151 23456789} these days",
    "our desk: {phone 0351 4567890}",
    "her card is {card 4000 1234-5678.9017} now",
    "my card {card 5200-8282 8282.8210} ends in may",
    "use card {card 4242-4242/4242-4242} instead",
    "ask {email pat at house.example.org} first",
    "{email ops at example.org} is on duty",
    "phone {phone 0421 3344556} at noon",
    "phone {phone 06131 998877} until five",
    "the phone is {phone 0911 223344} here",
    "ring {phone 02 41 12 13 14} at eight",
    "ring {phone 03 88 77 66 55} before two",
    "mail {email lisa at corp.example.com} again",
    "mail {email paul at town.example.edu} soon",
    "{email max at river.example.net}",
    "{email nina at lake.example.org} knows",
    "write {email otto at mail.example.org}",
    "from {ip fe80:0:0:0:9:8:7:6} we saw",
    "via {ip 2001:0:0:0:0:0:0:1} it went",
    "in 2019 there were 12 of them",
    "the steps are 10 100 1000 10000 and so on",
    "we saw 5 10 15 20 25 30 of them",
    "codes 2000 3000 4000 50000 are free",
    "look at example.org today",
    "see us at www.example.org or not",
    "more at shop.example.com every day",
    "meet at noon.then we go on",
    "room 101 102 103 104 is open",
    "numbers 2020 3030 4040 5050 were drawn",
    "sizes 300 000 000 and 400 000 000 of it",
    "chapter 3 verse 14 of the book",
    "page 120 to 145 and then 7",
    "they paid 1,200 or 3.50 for it",
    "version 2.0 of the text came out",
    "on 2024-01-15 we met at 10:30",
    "on 15.01.2024 we met again",
    "sold 500 000 copies in 1999",
    "order 884213 and item 77 shipped",
    "ratio 1:2 and 16:9 are common",
    "the twelve of us went home",
    "look @ this and @ that",
    "follow @someone for more",
    "hash 9f86d081884c7d65 was logged",
    "id 4785380592391135 is a row key",
    "token = abc123def456 and more",
    "Nobody was there when the bell rang.",
    "And of the others, none spoke again.",
    "section 1.2.3 of the guide",
    "numbers 10-12 and 14-16 are missing",
    "between 1914-1918 it was shut",
    "lines 100-200 were cut",
    "we met at example and left at noon",
    "he looked at 12 and at 15 of them",
    "at home.she waited at the door",
    "isbn 978 3 16 148410 0 of the book",
    "order no 4711 0815 1234 was sent",
    "population 12 345 678 in 2011",
    "it costs 1 250 000 or 1 300 000",
    "invoice 2023 000123 and 2023 000124",
    "from 10:15:30 to 11:20:45 it ran",
    "the sum 100 200 300 was wrong",
    "rows 1000000 to 2000000 are new",
    "built 123.456.789 of 2021",
    "a score of 10 20 30 40 50 60",
    "serial 12-345-678-90 is old",
    "std::vector and a::b are names",
    "time 12:30 and 4:5:6 of day",
)
LABELS = ("O", *KINDS)
_WORD = re.compile(r"\S+")
_CLASSES = (
    re.compile(r"[^0-9@]*$"), re.compile(r"[0-9]{1,2}\W*$"), re.compile(r"[0-9]{3,4}\W*$"), re.compile(r"[0-9]{5,8}\W*$"), re.compile(r"[0-9]{12,19}\W*$"),
    re.compile(r"[0-9]{9,}\W*$"), re.compile(r"\+[0-9]{1,3}$"), re.compile(r"\([0-9]{2,4}\)$"), re.compile(r"[0-9]{3}-[0-9]{4}\W*$"), re.compile(r"[0-9]{3,4}[./-][0-9]{3}[./-][0-9]{4}\W*$"),
    re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}\W*$"), re.compile(r"[0-9]{4}([./_-][0-9]{4})+\W*$"), re.compile(r"(?=.*[0-9a-fA-F])[0-9a-fA-F]{0,4}(:[0-9a-fA-F]{0,4}){2,7}\W*$"),
    re.compile(r"[^@\s]+@[^@\s]+$"), re.compile(r"\d{4}-\d\d-\d\d"), re.compile(r".*@"), re.compile(r"0[0-9]{2,4}[/-][0-9]{5,8}\W*$"),
)
_AT = re.compile(r"[(\[](at|dot)[)\]]$", re.IGNORECASE)
#: A word that itself looks like a domain, or like the local part of an address, and the words between the two.
_DOMAIN_WORD = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\W*$")
N_WORDS = 256
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


@lru_cache(maxsize=50_000)
def _word_features(word: str) -> tuple[int, int, int]:
    """The class of a word's shape, its shape with runs as one, and the word itself in small letters, the last two hashed."""
    if _AT.match(word):
        kind = len(_CLASSES) + 1
    elif _DOMAIN_WORD.match(word):
        kind = len(_CLASSES) + 2
    else:
        kind = next((i for i, p in enumerate(_CLASSES) if p.match(word)), len(_CLASSES))
    shape = _RUNS.sub(r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", word)))
    return kind, hash_text(shape) % N_SHAPES, hash_text(word.lower().strip(".,:;()")) % N_WORDS if word[0].isalpha() else N_WORDS


def hash_text(text: str) -> int:
    h = 2166136261
    for b in text.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h


N_CLASSES, N_SHAPES = len(_CLASSES) + 4, 256  # the last class, and the word after the last hash, stand outside a line


def features(words: list[str]) -> np.ndarray:
    """Seven features a word: its class, shape and letters, and the class and letters of the words before and after it."""
    own = [_word_features(w) for w in words]
    kinds = np.array([N_CLASSES - 1, *(k for k, _, _ in own), N_CLASSES - 1])
    letters = np.array([N_WORDS + 1, *(w for _, _, w in own), N_WORDS + 1])
    return np.stack([kinds[1:-1], np.array([s for _, s, _ in own], dtype=int), kinds[:-2], kinds[2:], letters[1:-1], letters[:-2], letters[2:]], axis=1)


class Crf:
    """Weights of emissions by feature and label, and of transitions between labels."""

    cards = (N_CLASSES, N_SHAPES, N_CLASSES, N_CLASSES, N_WORDS + 2, N_WORDS + 2, N_WORDS + 2)

    def __init__(self):
        n = len(LABELS)
        self.emit = [np.zeros((c, n)) for c in self.cards]
        self.move = np.zeros((n, n))

    def scores(self, feats: np.ndarray) -> np.ndarray:
        return sum(w[feats[..., i]] for i, w in enumerate(self.emit))

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 500, rate: float = 0.5, l2: float = 0.02) -> Crf:
        """Gradient ascent on the penalised likelihood, with expectations by forward and backward sums over all lines at once."""
        size = np.array([len(g) for _, g in rows])
        longest, many = int(size.max()), len(rows)
        feats, gold = np.zeros((longest, many, len(self.cards)), int), np.zeros((longest, many), int)
        for k, (f, g) in enumerate(rows):
            feats[:size[k], k], gold[:size[k], k] = f, g
        on = (np.arange(longest)[:, None] < size[None])[..., None]
        lines = np.arange(many)
        for _ in range(rounds):
            s = self.scores(feats)
            ahead, back = s.copy(), np.zeros_like(s)
            for t in range(1, longest):
                ahead[t] = np.where(on[t], s[t] + np.logaddexp.reduce(ahead[t - 1][:, :, None] + self.move, axis=1), ahead[t - 1])
            for t in range(longest - 2, -1, -1):
                back[t] = np.where(on[t + 1], np.logaddexp.reduce(self.move + (s[t + 1] + back[t + 1])[:, None, :], axis=2), 0)
            total = np.logaddexp.reduce(ahead[-1], axis=1)
            p = -np.exp(ahead + back - total[None, :, None]) * on
            for t in range(longest):
                p[t, lines, gold[t]] += on[t, :, 0]
            emit = [np.zeros_like(w) for w in self.emit]
            for i in range(len(emit)):
                np.add.at(emit[i], feats[..., i].ravel(), p.reshape(-1, len(LABELS)))
            move = np.zeros_like(self.move)
            for t in range(1, longest):
                np.add.at(move, (gold[t - 1][on[t, :, 0]], gold[t][on[t, :, 0]]), 1)
                both = np.exp(ahead[t - 1][:, :, None] + self.move + (s[t] + back[t])[:, None, :] - total[:, None, None])
                move -= (both * on[t][..., None]).sum(axis=0)
            for w, g in zip([*self.emit, self.move], [*emit, move], strict=True):
                w += rate * (g - l2 * w) / np.sqrt(many)
        return self

    def decode(self, lines: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each line by Viterbi, lines of like length at once."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(lines)
        order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(lines[order[end]]) * (end + 1 - at) <= 200_000:
                end += 1
            ids = order[at:end]
            longest = len(lines[ids[-1]])
            feats = np.zeros((longest, len(ids), len(self.cards)), int)
            size = np.array([len(lines[i]) for i in ids])
            for k, i in enumerate(ids):
                feats[:size[k], k] = lines[i]
            best, back = self.scores(feats[0]) if longest else None, np.zeros((longest, len(ids), len(LABELS)), np.int8)
            same = np.arange(len(LABELS))
            for t in range(1, longest):
                through = best[:, :, None] + self.move[None]
                on = (t < size)[:, None]
                back[t] = np.where(on, through.argmax(axis=1), same)
                best = np.where(on, through.max(axis=1) + self.scores(feats[t]), best)
            path = np.zeros((longest, len(ids)), int)
            if longest:
                path[-1] = best.argmax(axis=1)
                for t in range(longest - 1, 0, -1):
                    path[t - 1] = back[t][np.arange(len(ids)), path[t]]
            for k, i in enumerate(ids):
                out[i] = path[:size[k], k]
            at = end
        return out


def labelled_rows(table: tuple[str, ...] = LABELLED, parts: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of each line; with ``parts`` also of what a line has from an entity, or from two words before it, to its end, as entities stand at the ends of lines too."""
    rows = []
    for line in table:
        words, labels = [], []
        for kind, inside, outside in re.findall(r"\{(\w+) ([^}]*)\}|(\S+)", line):
            for w in inside.split() if kind else [outside]:
                words.append(w)
                labels.append(LABELS.index(kind) if kind else 0)
        held = [i for i, x in enumerate(labels) if x]
        cuts = {(0, len(words))} | ({(0, held[-1] + 1), (max(0, held[0] - 2), held[-1] + 1), (held[0], len(words))} if parts and held else set())
        rows += [(features(words[x:y]), np.array(labels[x:y])) for x, y in sorted(cuts)]
    return rows


@cache
def trained() -> Crf:
    return Crf().train(labelled_rows(parts=True))


_IP6 = re.compile(r"(?=.*[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[^:]*:){2,7}[^:]*$)(?=.*[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?")
_MAIL = re.compile(r"[^\s@]+(?:@|\s*[(\[]at[)\]]\s*)[^\s@]+.*|[A-Za-z0-9._%+-]+\s+at\s+[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+|\s+dot\s+[A-Za-z0-9-]+)+", re.IGNORECASE)
#: A line without any of these has no span that passes `_holds`.
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]|::|[0-9A-F]:[0-9A-F]|\bat\s+\S+(?:\.|\s+dot\s)", re.IGNORECASE)
_PHONE_LIKE = re.compile(r"[+(]?[0-9][0-9\x20()./-]*[0-9]")


def _holds(kind: str, text: str) -> bool:
    """Whether a labelled span can be what its label says: an address has both its parts, a card passes Luhn, a phone has groups of digits."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == "email":
        return bool(_MAIL.fullmatch(text)) and any(c.isalpha() for c in text)
    if kind == "ip":
        return bool(_IP6.fullmatch(text))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and not any(c.isalpha() for c in text)
    return 9 <= len(digits) <= 15 and len(re.findall(r"[0-9]+", text)) >= 2 and bool(_PHONE_LIKE.fullmatch(text))


def model_spans(texts: list[str], crf: Crf) -> list[list[Span]]:
    """Spans that the random field labels in lines with what `_TRIGGER` names; those of other kinds of lines can't hold."""
    lines, where = [], []
    for i, text in enumerate(texts):
        if not _TRIGGER.search(text):
            continue
        at = 0
        for line in text.split("\n"):
            if _TRIGGER.search(line):
                found = [(at + m.start(), at + m.end()) for m in _WORD.finditer(line)]
                lines.append(features([text[a:b] for a, b in found]))
                where.append((i, found))
            at += len(line) + 1
    out: list[list[Span]] = [[] for _ in texts]
    for (i, found), path in zip(where, crf.decode(lines), strict=True):
        t = 0
        while t < len(path):
            end = t + 1
            while end < len(path) and path[end] == path[t]:
                end += 1
            if path[t]:
                kind, a, b = LABELS[path[t]], found[t][0], found[end - 1][1]
                while b > a and texts[i][b - 1] in ".,;!?\"'":
                    b -= 1
                while a < b and texts[i][a] in "\"'<":
                    a += 1
                if a < b and _holds(kind, texts[i][a:b]):
                    out[i].append((a, b, kind))
            t = end
    return out


def all_spans(texts: list[str], crf: Crf) -> list[tuple[list[Span], list[Span]]]:
    """Of each text the spans of the patterns, and all: with those of the random field that overlap none of them."""
    out = []
    for text, more in zip(texts, model_spans(texts, crf), strict=True):
        base = base_spans(text)
        added = [s for s in more if all(s[1] <= b[0] or s[0] >= b[1] for b in base)]
        out.append((base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its first kind in brackets."""
    parts, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _finder(crf: Crf, redact: bool):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found, texts = [], []
            for _, run in textkit.chunks(pdf["text"]):
                found += all_spans(run, crf)
                texts += run
            if redact:
                yield pdf.assign(text=[redacted(t, s) if isinstance(o, str) else None for o, t, (_, s) in zip(pdf["text"], texts, found, strict=True)])
            else:
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "base": [joined(b) for b, _ in found], "spans": [joined(s) for _, s in found]})
    return find


def personal_data(docs: DataFrame) -> DataFrame:
    """Finds personal data in every text: ``doc_id``, ``base`` and ``spans``, each ``kind:start:end`` joined by commas.

    Takes ``doc_id`` and ``text``; other columns are ignored. Offsets count code
    points, ends are exclusive. ``base`` has the matches of the four patterns,
    ``spans`` also those of the random field: addresses without a dot or with
    at, numbers without a leading +, cards with other separators, addresses of
    version 6; they overlap no base span and can be what they are labelled.
    Lines are decoded whole, words of any length too. Null and empty texts have
    none. Repeated rows are each searched; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(docs, _finder(trained(), False), "doc_id long, base string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span in ``text`` replaced by its kind; other columns, and null texts, stay."""
    prepare(docs.sparkSession)
    return map_rows(docs, _finder(trained(), True), as_ddl(docs), whole_numbers(docs))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    n_spans = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ","))).cast("long").alias("n_spans")
    return found.select("doc_id", *map(count, KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", n_spans)
