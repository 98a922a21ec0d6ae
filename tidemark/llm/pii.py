"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds further spans.

The patterns (email, ip, card, phone) always stay. The field segments stretches of text around digits,
at-signs and addresses in words into entities and other tokens: features describe a whole candidate span (its characters, digit
count, checks, separators, neighbours), and a dynamic program over spans of at most ``SPAN`` tokens picks
borders and types together. It is trained here by maximum likelihood on stretches of the corpus that the
patterns label, and on variants of them in forms the patterns do not know (other separators, no country
code, words for the at-sign and the dot). A span is added if it scores ``MARGIN`` above leaving its tokens out and
overlaps no pattern span.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from heapq import merge
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch_map

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the four kinds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Stretches that train the field; those with the smallest hashes in the corpus.
TRAINING = 300
SPAN = 16
MARGIN = 2.0
LETTERED = str.maketrans("0123456789", "abcdefghij")
BUCKETS = 1 << 12
TOKEN = re.compile(r"[0-9]+|[A-Za-zÀ-ɏ]+|[^\sA-Za-zÀ-ɏ0-9]")
#: A stretch: tokens with digits or at-signs and what joins them, with three words around.
DIGIT = re.compile("[0-9]")
CORE = re.compile(r"[@0-9]")
#: An address with words for the at-sign and every dot, plain or in brackets; the bounds keep the search linear.
_AT, _DOT = (rf"(?: {w} | ?[\[(]{w}[\])] ?)" for w in ("at", "dot"))
_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]++", r"[A-Za-z0-9-]++"
SAID = re.compile(rf"(?<![A-Za-zÀ-ɏ0-9._%+-]){_LOCAL}(?:{_DOT}{_LOCAL}){{0,8}}{_AT}({_LABEL})(?:{_DOT}{_LABEL}){{1,8}}(?![A-Za-zÀ-ɏ0-9_%+-])")
#: Before the noun "dot": no host.
ARTICLES = frozenset(("a", "an", "the", "this", "that", "each", "every", "one", "any", "no", "my", "your", "his", "her", "its", "our", "their"))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, per kind leftmost without overlap; linear in the text."""
    out = []
    upto, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > upto and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            upto = m.end()
        else:
            upto = at + 1
        at = text.find("@", upto)
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = re.sub("[^0-9]", "", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        digits = sum(c in "0123456789" for c in m.group())
        if 9 <= digits <= 15:
            out.append((3, m.start(), m.end()))
    return out


def said_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of what may be an address in words."""
    if "dot" not in text:
        return []
    return [m.span() for m in SAID.finditer(text) if m.group(1).lower() not in ARTICLES]


def stretches(text: str, gap: int = 24, said=()):
    """(start, end) of parts of the text around digits, at-signs and ``said`` spans, cut where ``gap`` characters have none."""
    start = last = None
    cores = ((m.start(), m.start()) for m in CORE.finditer(text))
    for at, to in merge(cores, ((a, b - 1) for a, b in said)) if said else cores:
        if start is None:
            start, last = at, to
        elif at - last > gap:
            yield max(0, start - gap), min(len(text), last + 1 + gap)
            start, last = at, to
        last = max(last, to)
    if start is not None:
        yield max(0, start - gap), min(len(text), last + 1 + gap)


class Stretch:
    """Tokens of a stretch and the feature buckets of its candidate spans."""

    def __init__(self, text: str, said=()):
        self.text, self.said = text, said
        self.tokens = [m.span() for m in TOKEN.finditer(text)]

    def candidates(self):
        """(first token, end token, span features) of the spans that may be an entity.

        They begin and end with a letter or digit (or begin with a plus or bracket) outside of a run, and
        hold either letters and an at-sign, or no letters and four numbers or nine to 24 digits. Addresses in
        words are candidates as a whole.
        """
        text, tokens = self.text, self.tokens
        good = [text[a].isalnum() for a, _ in tokens]
        digit = [text[a] in "0123456789" for a, _ in tokens]
        sums = lambda xs: [0, *accumulate(xs)]
        count = sums(b - a if d else 0 for (a, b), d in zip(tokens, digit))
        numbers = sums(digit)
        letters = sums(g and not d for g, d in zip(good, digit))
        signs = sums(text[a] == "@" for a, _ in tokens)
        if self.said:
            first, last = {a: n for n, (a, _) in enumerate(tokens)}, {b: n + 1 for n, (_, b) in enumerate(tokens)}
            for a, b in self.said:
                if a in first and b in last:
                    i, j = first[a], last[b]
                    yield i, j, self.features(a, b, text[a:b], count[j] - count[i])
        for i in range(len(tokens)):
            if not (good[i] or text[tokens[i][0]] in "+("):
                continue
            if i and tokens[i - 1][1] == tokens[i][0] and (good[i - 1] or text[tokens[i - 1][0]] in "@._%+-"):
                continue  # does not start inside a run
            for j in range(i + 1, min(len(tokens), i + SPAN) + 1):
                if not good[j - 1]:
                    continue
                if j < len(tokens) and tokens[j][0] == tokens[j - 1][1] and good[j]:
                    continue
                if letters[j] > letters[i]:
                    if signs[j] == signs[i]:
                        continue
                elif count[j] - count[i] > 24:
                    break
                elif count[j] - count[i] < 9 and numbers[j] - numbers[i] != 4:
                    continue
                a, b = tokens[i][0], tokens[j - 1][1]
                part = text[a:b]
                if "\n" in part or b - a > 80:
                    break
                yield i, j, self.features(a, b, part, count[j] - count[i])

    def features(self, a: int, b: int, part: str, n: int) -> list[int]:
        text = self.text
        shape = re.sub("[A-Za-zÀ-ɏ]+", "a", re.sub("[0-9]+", "9", part))
        marks = "".join(sorted(set(re.sub("[A-Za-zÀ-ɏ0-9]", "", part))))
        groups = re.findall("[0-9]+", part)
        digits = "".join(groups)
        words = re.findall("[A-Za-zÀ-ɏ]+", part)
        octets = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
        card = 13 <= n <= 19 and luhn(digits)
        out = [
            f"shape {shape[:24]}", f"marks {marks}", f"digits {min(n, 24)}", f"groups {min(len(groups), 8)}", f"lens {','.join(str(len(g)) for g in groups[:6])}",
            f"words {min(len(words), 6)}", f"octets {octets}", f"card {card} {13 <= n <= 19}", f"first {shape[0]}", f"plus {part[0] == '+'} {9 <= n <= 15}",
            f"at {part.count('@')} {bool(re.search(r'@[A-Za-z0-9.-]+[.][A-Za-z0-9-]+$', part))}", f"said {SAID.fullmatch(part) is not None}",
            f"before {self._beside(a - 1)}", f"after {self._beside(b)}", f"size {min((b - a) // 4, 12)}", "any",
        ]
        return [bucket(f) for f in out]

    def _beside(self, k: int) -> str:
        if not 0 <= k < len(self.text):
            return "edge"
        c = self.text[k]
        return "space" if c.isspace() else "digit" if c in "0123456789" else "letter" if c.isalpha() else c


def bucket(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % BUCKETS


class Field:
    """Weights per kind and feature bucket; a token outside entities scores 0."""

    def __init__(self, weights: np.ndarray):
        self.w = weights

    def scored(self, stretch: Stretch) -> list[tuple[int, int, np.ndarray, list[int]]]:
        return [(i, j, self.w[:, f].sum(1), f) for i, j, f in stretch.candidates()]

    def best(self, stretch: Stretch, spans=None) -> list[tuple[int, int, int, float]]:
        """(kind, first token, end token, score) of the best segmentation."""
        n = len(stretch.tokens)
        ends: dict[int, list] = {}
        for i, j, s, _ in self.scored(stretch) if spans is None else spans:
            k = int(s.argmax())
            ends.setdefault(j, []).append((i, k, float(s[k])))
        score, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            score[j] = score[j - 1]
            for i, k, s in ends.get(j, ()):
                if score[i] + s > score[j]:
                    score[j], back[j] = score[i] + s, (i, k, s)
        out, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                i, k, s = back[j]
                out.append((k, i, j, s))
                j = i
        return out[::-1]

    def gradient(self, stretch: Stretch, gold: set[tuple[int, int, int]], candidates) -> np.ndarray:
        """Log-likelihood gradient: observed less expected features, by forward and backward sums over spans."""
        n = len(stretch.tokens)
        spans = [(i, j, self.w[:, f].sum(1), f) for i, j, f in candidates]
        by_end, by_start = {}, {}
        for s in spans:
            by_end.setdefault(s[1], []).append(s)
            by_start.setdefault(s[0], []).append(s)
        up, down = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            up[j] = np.logaddexp.reduce([up[j - 1]] + [up[i] + x for i, _, s, _ in by_end.get(j, ()) for x in s])
        for i in range(n - 1, -1, -1):
            down[i] = np.logaddexp.reduce([down[i + 1]] + [x + down[j] for _, j, s, _ in by_start.get(i, ()) for x in s])
        out = np.zeros_like(self.w)
        for i, j, s, f in spans:
            expected = np.exp(up[i] + s + down[j] - up[n])
            for k in range(len(KINDS)):
                change = ((k, i, j) in gold) - expected[k]
                if abs(change) > 1e-4:
                    np.add.at(out[k], f, change)
        return out


def in_words(email: str, rng: random.Random) -> str:
    return email.replace("@", rng.choice([" at ", " [at] ", " (at) "])).replace(".", rng.choice([" dot ", " [dot] ", " (dot) "]))


def forms(kind: int, text: str, rng: random.Random) -> list[str]:
    """An entity in every form that the patterns do not know; of an address's mixed forms, two."""
    digits = re.sub("[^0-9]", "", text)
    if kind == 0:
        plain = [text.replace("@", f" {o}at{c} ").replace(".", f" {o}dot{c} ") for o, c in (("", ""), "[]", "()")]
        return [*plain, *(in_words(text, rng) for _ in range(2))]
    if kind == 1:
        return [text.replace(".", sep) for sep in (" . ", "[.]")]
    if kind == 2:
        return [sep.join(digits[k : k + 4] for k in range(0, len(digits), 4)) for sep in (".", "/", "  ")]
    area, first, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}"]


def variants(kind: int, text: str, rng: random.Random) -> str:
    """One of the forms."""
    return rng.choice(forms(kind, text, rng))


def train(samples: list[str], rounds: int = 12, rate: float = 0.4, decay: float = 2e-3, seed: int = 11) -> np.ndarray:
    """Weights from stretches labelled by the patterns, their variants, and their spoilt copies."""
    rng, words_rng = random.Random(seed), random.Random(seed + 1)
    data = []
    for text in samples:
        spans = _disjoint(base_spans(text))
        texts = [(text, spans)]
        if spans:
            k, a, b = rng.choice(spans)
            for new in forms(k, text[a:b], rng):
                # as it stands, and where a sentence or a clause ends
                for mark in ("", rng.choice(".,")):
                    texts.append((text[:a] + new + mark + text[b:], [(k, a, a + len(new))]))
            bad = "".join(str((int(c) + 1 + 3 * (n % 2)) % 10) if c in "0123456789" else "" if c in "+@()" else c for n, c in enumerate(text[a:b]))
            if not _disjoint(base_spans(text[:a] + bad + text[b:])):
                texts.append((text[:a] + bad + text[b:], []))
            for k, a, b in spans:
                if k == 0:  # in words, as it stands and with letters for its digits; the text around may lack digits too
                    new = in_words(text[a:b], words_rng)
                    texts.append((text[:a] + new + text[b:], [(k, a, a + len(new))]))
                    left, new, right = (x.translate(LETTERED) for x in (text[:a], in_words(text[a:b], words_rng), text[b:]))
                    texts.append((left + new + right, [(k, a, a + len(new))]))
        for t, gold in texts:
            # addresses in words that stand in the corpus are no evidence against such
            s = Stretch(t, [x for x in said_spans(t) if any(x == (a, b) for _, a, b in gold)])
            first = {a: n for n, (a, _) in enumerate(s.tokens)}
            last = {b: n + 1 for n, (_, b) in enumerate(s.tokens)}
            if all(a in first and b in last for _, a, b in gold):
                data.append((s, {(k, first[a], last[b]) for k, a, b in gold}, list(s.candidates())))
    field = Field(np.zeros((len(KINDS), BUCKETS)))
    past = np.full_like(field.w, 1.0)
    for _ in range(rounds):
        rng.shuffle(data)
        for start in range(0, len(data), 16):
            part = data[start : start + 16]
            step = sum(field.gradient(*x) for x in part) - decay * len(part) * field.w
            past += step * step
            field.w += rate * step / np.sqrt(past)
    return field.w


def _disjoint(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Longest first: a stretch is labelled without overlaps."""
    out: list[tuple[int, int, int]] = []
    for s in sorted(spans, key=lambda s: (s[1] - s[2], s)):
        if all(s[2] <= o[1] or s[1] >= o[2] for o in out):
            out.append(s)
    return sorted(out, key=lambda s: s[1])


def find(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Pattern spans, and the spans that the field adds."""
    base = sorted(base_spans(text))
    added = []
    taken: list[tuple[int, int]] = []  # without overlaps
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    starts, ends = [t[0] for t in taken], [t[1] for t in taken]

    def free(x: int, z: int) -> bool:
        k = bisect_left(starts, z) - 1
        return k < 0 or ends[k] <= x

    said = [x for x in said_spans(text) if free(*x)]
    for a, b in stretches(text, said=said):
        inside = taken[bisect_right(ends, a) : bisect_left(starts, b)]
        own = said[bisect_left(said, (a, a)) : bisect_left(said, (b, b))]
        if not own and not _open_core(text, a, b, inside):
            continue
        # cut words at the border are no tokens of the stretch
        while a > 0 and text[a - 1].isalnum() and a < b and text[a].isalnum():
            a += 1
        while b < len(text) and text[b].isalnum() and b > a and text[b - 1].isalnum():
            b -= 1
        s = Stretch(text[a:b], [(x - a, z - a) for x, z in own])
        spans = [x for x in field.scored(s) if free(s.tokens[x[0]][0] + a, s.tokens[x[1] - 1][1] + a)]
        for k, i, j, score in field.best(s, spans):
            if score >= MARGIN:
                added.append((k, s.tokens[i][0] + a, s.tokens[j - 1][1] + a))
    return base, added


def _open_core(text: str, a: int, b: int, inside: list[tuple[int, int]]) -> bool:
    """Is there enough outside the pattern spans for another entity: four digits or an at-sign."""
    rest, upto = [], a
    for x, z in inside:
        rest.append(text[upto : max(x, upto)])
        upto = max(upto, z)
    rest = " ".join([*rest, text[upto:b]])
    return sum(c in "0123456789" for c in rest) >= 4 or "@" in rest


def fit(docs: DataFrame, text_col: str = "text", most: int = TRAINING) -> np.ndarray:
    """Train on the ``most`` distinct labelled stretches with the smallest hashes, of the whole corpus."""
    def rows(source):
        for r in source:
            text = r["text"] or ""
            for a, b in stretches(text):
                if b - a <= 200:
                    part = text[a:b]
                    yield (part, bool(base_spans(part)))

    found = arrow_map(docs.select(F.col(text_col).alias("text")), "part string, labelled boolean", rows)
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.keep(found.distinct().withColumn("hash", F.xxhash64("part")))
    picked = []
    for labelled in (True, False):
        some = found.where(F.col("labelled") == labelled).orderBy("hash", "part").limit(most)
        picked += [r["part"] for r in some.collect()]
    scratch.drop(found)
    return train(picked)


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", training: DataFrame | None = None) -> DataFrame:
    """``id_col, base, spans`` per row: arrays of (kind, start, stop) in code points, by kind and then start.

    ``base`` are the pattern spans, ``spans`` these and what the field adds. Null and empty texts have none.
    Null and repeated ids give a row each; other columns are not read; an empty table gives no rows.
    """
    weights = fit(docs if training is None else training, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(source):
        field = Field(sent.value)
        out = lambda spans: [{"kind": KINDS[k], "start": a, "stop": b} for k, a, b in sorted(spans)]
        for r in source:
            base, added = find(r["text"] or "", field)
            yield r["doc"], out(base), out(base + added)

    span = "array<struct<kind:string,start:long,stop:long>>"
    found = arrow_map(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), f"doc {kind}, base {span}, spans {span}", rows, size=500)
    return found.withColumnRenamed("doc", id_col)


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets; overlapping spans by the first one's.

    A null text stays null; nothing else of a row changes.
    """
    weights = fit(docs, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    at = docs.columns.index(text_col)

    def clean(batches):
        field = Field(sent.value)
        for batch in batches:
            texts = [None if t is None else replace(t, [s for part in find(t, field) for s in part]) for t in batch.column(at).to_pylist()]
            columns = [pa.array(texts, batch.schema.field(k).type) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return batch_map(docs, clean, docs.schema)


def replace(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, upto = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= upto:
            out += [text[upto:a], f"<{KINDS[k].upper()}>"]
        elif b > upto:
            pass  # the rest of an overlapping span goes with the first
        upto = max(upto, b)
    return "".join([*out, text[upto:]])


def joined(spans: str):
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")
