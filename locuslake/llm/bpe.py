"""BPE encoding and decoding (6): a bounded-lookahead streaming transducer over the public merge list.

The tokens of a pre-token's prefix are those of a shorter prefix plus one last token. That last token is the
one whose left neighbour is compatible with it: no merge across their border comes before the merges that
build the two. So the transducer keeps, for each of the last `reach` symbols (the longest token's length,
read off the merge list), only the last token and where it starts. A token is stable, and is emitted, once
all positions that a later token can start at descend from it; what is kept stays constant in size.

Decoding is a state machine fed one id at a time: `Surface` gives the library's form (token strings joined
by a space, as the file names no decoder), `ByteText` the text, holding back an unfinished UTF-8 sequence.

Normal form, split and special tokens are read from the tokenizer file. Defined cases: a null text is an
empty one (no ids, empty decoded text); repeated rows return as often as they came; a null doc_id stays.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from locuslake.llm.shared import small_batches

NEVER = 1 << 60
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else spare))
        spare += b not in plain
    return letters


class Tables:
    """What the transducer reads off a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: r for r, m in enumerate(merges)}
        self.parts: dict[str, tuple[str, str, int]] = {}
        for r, (a, b) in enumerate(merges):
            self.parts.setdefault(a + b, (a, b, r))
        born = {t: r for t, (_, _, r) in self.parts.items()}
        if any(max(born.get(a, -1), born.get(b, -1)) >= r for (a, b), r in self.rank.items()):
            raise ValueError("a merge comes before the merges of its parts; the transducer needs a proper merge list")
        self.reach = max(len(t) for t in self.ids)
        self.tail: dict[str, int] = {}  # of each two last symbols: the longest token that ends in them
        for t in self.ids:
            bare = t.removesuffix(self.suffix)
            for key in {bare[-2:], bare[-1:]}:
                self.tail[key] = max(self.tail.get(key, 0), len(bare) if len(key) == 2 else 1)
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.split = regex.compile(splits[0]["pattern"]["Regex"].replace(r"\s", SPACES))
        names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.names = names
        letters = byte_letters()
        self.letters = letters
        back = {c: b for b, c in enumerate(letters)}
        self.bytes = {i: t.encode() if t in self.special else bytes(back[c] for c in t.removesuffix(self.suffix)) for i, t in names.items()}
        # by id, for the decoders
        by_id = [names.get(i, "") for i in range(max(names) + 1)]
        self.surface = by_id
        self.pieces = [self.bytes[i] + b" " * (t in self.special or t.endswith(self.suffix)) if i in names else b"" for i, t in enumerate(by_id)]
        self.digits = [str(i) for i in range(len(by_id))]
        self.known: dict[tuple[str, str], bool] = {}

    def fits(self, a: str, b: str) -> bool:
        """Whether the merges leave the border between tokens a and b alone.

        On either side of the border stands, at any time, one symbol of a's right edge and one of b's left
        edge. A merge of the two happens if it comes before both are merged away from the border; at the
        same rank the merge further left comes first.
        """
        key = (a, b)
        if len(self.known) > 200_000:
            self.known.clear()
        left, gone = [], NEVER
        while True:
            left.append((a, gone))
            if a not in self.parts:
                break
            _, a, gone = self.parts[a]
        good, gone = True, NEVER
        while good:
            for x, leaves in left:
                r = self.rank.get((x, b))
                if r is not None and r < leaves and r <= gone:
                    good = False
                    break
            if b not in self.parts:
                break
            b, _, gone = self.parts[b]
        self.known[self.names[self.ids[key[0]]], self.names[self.ids[key[1]]]] = good  # the vocabulary's own strings, not slices
        return good


class Transducer:
    """Encodes one pre-token, fed in pieces of byte letters; feed() and finish() return the tokens that became stable."""

    def __init__(self, tables: Tables):
        self.t = tables
        self.ids, self.tail, self.known = tables.ids, tables.tail, tables.known
        self.symbols = ""  # from the first token that is not yet stable, and the one symbol of lookahead for the word's end
        self.last: list[str] = [""]  # last[i]: last token of the first i kept symbols
        self.before = ""  # the token emitted last

    def _token(self, end: int, suffix: str) -> str:
        s, ids, last, known = self.symbols, self.ids, self.last, self.known
        for start in range(max(0, end - self.tail.get(s[end - 2 : end] if end > 1 else s[:end], 1)), end):
            token = s[start:end] + suffix if suffix else s[start:end]
            if token in ids:
                if start:
                    left = last[start] or self._place(start)
                else:
                    left = self.before
                    if not left:
                        return token
                if (good := known.get((left, token))) is None:
                    good = self.t.fits(left, token)
                if good:
                    return token
        raise ValueError("the vocabulary lacks a byte")

    def _place(self, end: int) -> str:
        token = self.last[end] = self._token(end, "")
        return token

    def feed(self, piece: str) -> list[str]:
        self.symbols += piece
        self.last += [""] * (len(self.symbols) - len(self.last))  # the last symbol waits: it may end the word
        if len(self.last) <= 4 * self.t.reach:
            return []  # tokens of so few symbols are placed where finish() needs them
        for end in range(1, len(self.last)):
            if not self.last[end]:
                self._place(end)
        # the furthest border that all positions a later token can start at have in common
        open_ = {*range(len(self.last) - self.t.reach, len(self.last))}
        while len(open_) > 1:
            far = max(open_)
            open_.remove(far)
            open_.add(far - len(self.last[far]))
        border = open_.pop()
        out = self._walk(border)
        if out:
            self.before = out[-1]
            self.symbols, self.last = self.symbols[border:], ["", *self.last[border + 1 :]]
        return out

    def _walk(self, end: int) -> list[str]:
        out = []
        while end:
            out.append(self.last[end] or self._place(end))
            end -= len(self.last[end])
        return out[::-1]

    def finish(self) -> list[str]:
        if not self.symbols:
            return []
        token = self._token(len(self.symbols), self.t.suffix)
        return [*self._walk(len(self.symbols) - len(token) + len(self.t.suffix)), token]


class Surface:
    """The library's decoded form, fed ids: token strings, and a space between two."""

    def __init__(self, tables: Tables):
        self.name, self.any = tables.surface.__getitem__, False

    def feed(self, ids: Sequence[int]) -> str:
        out = " ".join(map(self.name, ids))
        lead, self.any = " " if self.any and ids else "", self.any or bool(ids)
        return lead + out


class ByteText:
    """Text from ids: bytes go through an incremental UTF-8 decoder; the end of a word owes a space to the next id.

    Its state is the bytes of an unfinished character and whether a space is owed.
    """

    def __init__(self, tables: Tables):
        self.pieces, self.utf8, self.owes = tables.pieces, codecs.getincrementaldecoder("utf-8")("replace"), b""

    def feed(self, ids: Sequence[int]) -> str:
        if not ids:
            return ""
        data = self.owes + b"".join(map(self.pieces.__getitem__, ids))
        self.owes = b" " if self.pieces[ids[-1]].endswith(b" ") else b""
        return self.utf8.decode(data[:-1] if self.owes else data)

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


class Codec:
    """Encodes whole texts, a window of them at a time; the ids of white-space-free chunks are remembered in two generations of bounded size."""

    def __init__(self, path: str | None = None, remember: int = 300_000, window: int = 1 << 16):
        self.t = Tables(path or default_path())
        self.remember, self.window = remember, window
        self.words: tuple[dict, dict] = ({}, {})  # of chunks
        self.parts: tuple[dict, dict] = ({}, {})  # of pretokens that are no words of plain letters
        self.special = re.compile("(" + "|".join(map(re.escape, self.t.special)) + ")") if self.t.special else None
        self.spaces = re.compile(f"[{SPACES}]+")
        self.odd = re.compile("[\x1c-\x1f]")  # white space to str.split alone

    def pretokens(self, chunk: str) -> list[str]:
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        low = unicodedata.normalize("NFC", chunk)
        if "Σ" in low:
            low = low.replace("Σ", "σ")  # letter by letter: no final sigma
        return self.t.split.findall(low.lower())

    def tokens(self, pretoken: str) -> list[str]:
        run, out = Transducer(self.t), []
        letters = self.t.letters
        data = pretoken if pretoken.isascii() and pretoken.isprintable() else "".join([letters[b] for b in pretoken.encode("utf-8", "replace")])
        for k in range(0, len(data), 256):
            out += run.feed(data[k : k + 256])
        return out + run.finish()

    def _kept(self, where: tuple[dict, dict], key: str, make: Callable[[str], tuple]) -> tuple[tuple[dict, dict], tuple]:
        """The generations after a look at `key`, and its entry, made where neither holds it."""
        new, old = where
        if (e := new.get(key)) is None:
            e = old.get(key) or make(key)
            if len(key) <= 64:
                if len(new) >= self.remember:
                    new, old = {}, new
                new[key] = e
        return (new, old), e

    def _pretoken(self, pretoken: str) -> tuple:
        make = lambda p: tuple([self.t.ids[t] for t in self.tokens(p)])
        if pretoken.isascii() and pretoken.isalpha():  # as a chunk it is its own pretoken
            self.words, e = self._kept(self.words, pretoken, make)
        else:
            self.parts, e = self._kept(self.parts, pretoken, make)
        return e

    def _chunk(self, chunk: str) -> tuple:
        found = self.pretokens(chunk)
        if found == [chunk] and chunk.isascii() and chunk.isalpha():
            return self._pretoken(chunk)
        made = self.words[0].get(chunk) or self.words[1].get(chunk) or tuple(chain.from_iterable([self._pretoken(p) for p in found]))
        self.words, e = self._kept(self.words, chunk, lambda _: made)
        return e

    def _plain(self, text: str) -> list[tuple]:
        split = [c for c in self.spaces.split(text) if c] if self.odd.search(text) else text.split()
        get, miss = self.words[0].get, self._chunk  # a generation that fills up meanwhile is still good to read
        return [get(c) or miss(c) for c in split]

    def blocks(self, text: str | None) -> Iterator[list[int]]:
        """The ids, a window of the text after the other; windows end at white space, where no token crosses."""
        text, start = text or "", 0
        while start < len(text):
            end = len(text)
            if end - start > self.window and (gap := self.spaces.search(text, start + self.window)):
                end = gap.end()
            part, start = text[start:end], end
            if "<|" in part and self.special:
                found: list[tuple] = []
                for k, piece in enumerate(self.special.split(part)):
                    found += [(self.t.special[piece],)] if k % 2 else self._plain(piece)
            else:
                found = self._plain(part)
            yield list(chain.from_iterable(found))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.blocks(text)))

    def surface(self, ids: Sequence[int]) -> str:
        return Surface(self.t).feed(ids)

    def text(self, ids: Sequence[int]) -> str:
        run = ByteText(self.t)
        return run.feed(ids) + run.finish()

    def digests(self, text: str | None) -> tuple[int, str, str, str]:
        """(n_tokens, hash of the ids, hash of the library's decoded form, hash of the text read back from the ids' bytes):
        each block of ids goes through both decoders as it comes, and nothing of it is kept."""
        n, ids, decoded, back = 0, hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        surface, plain, digit = Surface(self.t), ByteText(self.t), self.t.digits.__getitem__
        for block in self.blocks(text):
            if block:
                ids.update(((" " if n else "") + " ".join(map(digit, block))).encode("ascii"))
                n += len(block)
                decoded.update(surface.feed(block).encode("utf-8", "replace"))
                back.update(plain.feed(block).encode())
        back.update(plain.finish().encode())
        return n, ids.hexdigest(), decoded.hexdigest(), back.hexdigest()


def op6_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, text_sha256) of every whole text; no shuffle. The last is of the text that the
    byte-to-text machine reads back: the normal form, words and marks a space apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 20, 100)  # large caches without cycles
        codec = Codec(path)
        for batch in small_batches(batches):
            got = [codec.digests(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got]), pa.array([g[2] for g in got]), pa.array([g[3] for g in got])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "text_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, text_sha256 string")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with `ids` (array<int>) of each whole text; columns as they came, one of that name replaced."""
    from pyspark.sql.types import ArrayType, IntegerType, StructType

    kept = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 20, 100)  # large caches without cycles
        codec = Codec(path, remember=60_000)  # beside the memory that a pipeline's other stages have taken
        for batch in small_batches(batches):
            found = [np.array(codec.encode(t.as_py()), np.int32) for t in batch.column("text")]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    return kept.mapInArrow(run, StructType([*kept.schema.fields]).add("ids", ArrayType(IntegerType())))
