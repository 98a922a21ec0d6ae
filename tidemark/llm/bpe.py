"""Byte-pair encoding as a streaming transducer, and decoding as a byte-to-text state machine.

Encoding walks over the symbols and takes the longest vocabulary entry that fits the token before it; two
neighbours fit if merging their joined symbols gives back the two. A token list in which all neighbours
fit is the result of applying the merge list, and there is only one, so a position from which the walk
can't go on is never entered again.

Lookahead: what follows can change a merge (u, v) only by merging v, or a right part of v, earlier; that
rule must come before it in the list, and so on down the list. The longest such chain bounds how many
symbols after a token can still change it. ``Transducer`` keeps that many symbols and emits all tokens
before them, so memory does not grow with the length of a word.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, worker_state

#: White space of the pattern language in which the tokenizer files state their rules.
SPACE = "\t-\r \x85\xa0  -     　"
END = "\0"


def byte_alphabet() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


def lookahead(merges: list[tuple[str, str]], size) -> int:
    """Most symbols after a token that can still change it. ``size`` gives the symbols of a token."""
    right, best, most = {}, {}, 0
    for u, v in merges:
        reach, x = 0, v
        while x is not None:
            reach = max(reach, best.get(x, 0))
            x = right.get(x)
        reach += size(v)
        best[u] = max(best.get(u, 0), reach)
        right.setdefault(u + v, v)
        most = max(most, reach)
    return most


class Vocabulary:
    """Tables of a tokenizer file: ids, ranks of merges, surfaces, special tokens, and the lookahead."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or model.get("continuing_subword_prefix"):
            raise ValueError("expected a BPE file without decoder and without subword prefix")
        self.suffix = model.get("end_of_word_suffix") or ""
        own = lambda s: s[: -len(self.suffix)] + END if self.suffix and s.endswith(self.suffix) else s
        self.ids = {own(s): i for s, i in model["vocab"].items()}
        self.surface = {i: s for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.surface |= {i: s for s, i in self.special.items()}
        pairs = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.merges = [(own(u), own(v)) for u, v in pairs]
        self.ranks = {m: k for k, m in enumerate(self.merges)}
        self.size = lambda t: len(t) - t.endswith(END)
        self.lookahead = lookahead(self.merges, self.size)
        self.text = {i: s for s, i in self.ids.items()}
        self.longest: dict[str, int] = {}  # by the first four characters; entries not in it are shorter
        for s in self.ids:
            if len(s) > 3:
                self.longest[s[:4]] = max(self.longest.get(s[:4], 0), len(s))
        self.fit: dict[int, bool] = {}

    def symbols(self, s: str) -> list[str]:
        return [*s[:-2], s[-2:]] if s.endswith(END) else [*s]

    def fits(self, x: int, y: int) -> bool:
        key = x << 32 | y
        known = self.fit.get(key)
        if known is None:
            if len(self.fit) > 1_000_000:
                self.fit.clear()
            a, b = self.text[x], self.text[y]
            known = self.fit[key] = merge(self.symbols(a + b), self.ranks) == [a, b]
        return known

    def walk(self, s: str) -> list[int]:
        """Token ids of a symbol string; its last token is only final if the string ends the word."""
        ids, longest, n = self.ids, self.longest, len(s)
        out: list[int] = []
        dead: set[int] = set()
        i, length = 0, min(longest.get(s[:4], 3), n)
        while i < n:
            while length:
                t = ids.get(s[i : i + length])
                if t is not None and i + length not in dead and (not out or self.fits(out[-1], t)):
                    break
                length -= 1
            if length:
                out.append(t)
                i += length
                length = min(longest.get(s[i : i + 4], 3), n - i)
            elif not out:
                raise ValueError("a symbol is not in the vocabulary")
            else:
                dead.add(i)
                length = len(self.text[out.pop()])
                i -= length
                length -= 1
        return out


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the merge list to a short symbol list: always the first rule that applies, from the left."""
    while len(symbols) > 1:
        rank, k = min((ranks.get(p, 1 << 30), k) for k, p in enumerate(zip(symbols, symbols[1:])))
        if rank == 1 << 30:
            break
        symbols = [*symbols[:k], symbols[k] + symbols[k + 1], *symbols[k + 2 :]]
    return symbols


class Transducer:
    """Tokens of one word whose symbols arrive in pieces; holds back what later symbols can still change."""

    def __init__(self, vocabulary: Vocabulary, block: int = 4096):
        self.v, self.block, self.held, self.before = vocabulary, max(block, 4 * vocabulary.lookahead), "", None

    def feed(self, symbols: str) -> Iterator[int]:
        for start in range(0, len(symbols), self.block):
            self.held += symbols[start : start + self.block]
            if len(self.held) >= self.block:
                yield from self._stable()

    def finish(self) -> Iterator[int]:
        if self.held:
            yield from self.v.walk(self.held + END if self.v.suffix else self.held)
        self.held = ""

    def _stable(self) -> Iterator[int]:
        # one more symbol stays back: at the end of the word it takes the end mark
        sure = len(self.held) - self.v.lookahead - 1
        done = 0
        for t in self.v.walk(self.held[:-1]):
            if done + len(self.v.text[t]) > sure:
                break
            done += len(self.v.text[t])
            yield t
        # Whatever tokens follow a stable one fit it: what is held is encoded on its own.
        self.held = self.held[done:]


class Encoder:
    """Ids of whole texts: special tokens, normal form, splitting, then the transducer word by word."""

    WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+")

    def __init__(self, vocabulary: Vocabulary, cache: int = 400_000):
        self.v, self.cache, self.known, self.words = vocabulary, cache, {}, {}
        self.bytes = byte_alphabet()
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.space = regex.compile(f"[{SPACE}]+")
        self.odd = regex.compile("[\x1c-\x1f]")

    def chunk(self, raw: str) -> bytes:
        """Ids, four bytes each, of a run without white space."""
        # Lower case is taken character by character, so a final sigma stays a plain one.
        s = raw.lower() if raw.isascii() else unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
        words = self.words
        if len(words) > self.cache:
            words.clear()
        out = []
        for word in self.WORD.findall(s):
            ids = words.get(word)
            if ids is None:
                ids = self.word(word)
                if len(word) <= 64:
                    words[word] = ids
            out.append(ids)
        return b"".join(out)

    def word(self, word: str) -> bytes:
        out, machine = array("I"), Transducer(self.v)
        coded = word.encode("utf-8", "surrogatepass")
        for start in range(0, len(coded), 1 << 16):
            out.extend(machine.feed("".join(map(self.bytes.__getitem__, coded[start : start + (1 << 16)]))))
        out.extend(machine.finish())
        return out.tobytes()

    def pieces(self, text: str | None) -> Iterator[bytes]:
        """Ids of a text in pieces of bounded size."""
        known = self.known
        for part in self.special.split(text or "") if self.special else [text or ""]:
            if self.special and part in self.v.special:
                yield array("I", [self.v.special[part]]).tobytes()
                continue
            chunks = part.split() if not self.odd.search(part) else [c for c in self.space.split(part) if c]
            for start in range(0, len(chunks), 4096):
                if len(known) > self.cache:
                    known.clear()
                some = chunks[start : start + 4096]
                for c in some:
                    if c not in known:
                        ids = self.chunk(c)
                        if len(c) <= 64:
                            known[c] = ids
                        else:  # long runs are not worth keeping
                            yield from self._long(some, known)
                            break
                else:
                    yield b"".join(map(known.__getitem__, some))

    def _long(self, chunks: list[str], known: dict[str, bytes]) -> Iterator[bytes]:
        for c in chunks:
            ids = known.get(c)
            yield self.chunk(c) if ids is None else ids

    def __call__(self, text: str | None) -> array:
        out = array("I")
        for piece in self.pieces(text):
            out.frombytes(piece)
        return out


class Decoder:
    """Text of a stream of ids, piece by piece.

    ``surface``: token strings joined by a space, which is what the public library gives for a file
    without a decoder. ``text``: the bytes of the tokens read as UTF-8 by a state machine that keeps an
    unfinished character until its last byte has come; an end-of-word mark is a space.
    """

    def __init__(self, vocabulary: Vocabulary, mode: str = "surface"):
        self.mode, self.first = mode, True
        if mode == "surface":
            self.table = vocabulary.surface
        else:
            back = {c: bytes([b]) for b, c in byte_alphabet().items()} | {END: b" "}
            self.table = {i: b"".join(back[c] for c in s) for i, s in vocabulary.text.items()}
            self.table |= {i: s.encode() for s, i in vocabulary.special.items()}
            self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if self.mode != "surface":
            return self.state.decode(b"".join(map(self.table.__getitem__, ids)))
        out = " ".join(map(self.table.__getitem__, ids))
        if not out:
            return ""
        out, self.first = out if self.first else " " + out, False
        return out

    def finish(self) -> str:
        return "" if self.mode == "surface" else self.state.decode(b"", True)


def worker_encoder(text: str) -> Encoder:
    """The encoder of this worker process: what it has learned about frequent words serves later tasks too."""
    return worker_state("bpe", text, lambda: Encoder(Vocabulary(text)))


def _vocabulary(docs: DataFrame, path: str):
    """The tokenizer file travels with the job: a few MB whatever the input."""
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the token ids of every whole text; null and empty texts have none.

    Rows are independent: repeated rows and null ids give a row each, other columns are not read.
    """
    spec = _vocabulary(docs, path)

    def rows(source):
        encoder = worker_encoder(spec.value)
        for r in source:
            yield r["doc"], encoder(r["text"]).tolist()

    out = arrow_map(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")), "doc long, ids array<int>", rows, size=100, state="bpe")
    return out.withColumnRenamed("doc", id_col)


def decode(tokens: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids", mode: str = "surface") -> DataFrame:
    """``id_col, text`` from token ids; null and empty lists give the empty text."""
    spec = _vocabulary(tokens, path)

    def rows(source):
        vocabulary = worker_encoder(spec.value).v
        for r in source:
            machine = Decoder(vocabulary, mode)
            yield r["doc"], machine.feed(r["ids"] or []) + machine.finish()

    out = arrow_map(tokens.select(F.col(id_col).cast("long").alias("doc"), F.col(ids_col).alias("ids")), "doc long, text string", rows, size=100, state="bpe")
    return out.withColumnRenamed("doc", id_col)


def digests(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every whole text, encoded and decoded in pieces.

    Same defined results as ``encode``: null and empty texts have no tokens and decode to the empty text.
    """
    spec = _vocabulary(docs, path)

    def rows(source):
        encoder = worker_encoder(spec.value)
        for r in source:
            machine, n, a, b = Decoder(encoder.v), 0, hashlib.sha256(), hashlib.sha256()
            for piece in encoder.pieces(r["text"]):
                ids = memoryview(piece).cast("I")
                n += len(ids)
                a.update(piece)
                b.update(machine.feed(ids).encode())
            b.update(machine.finish().encode())
            yield r["doc"], n, a.hexdigest(), b.hexdigest()

    schema = "doc long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    out = arrow_map(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")), schema, rows, state="bpe")
    return out.withColumnRenamed("doc", id_col)
