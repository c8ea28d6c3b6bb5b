"""Token counts (1): trie-shared dynamic programming over a unigram vocabulary.

A pre-token is a run of non-white-space with the word mark in front. The best segmentation of every prefix
of every pre-token is a node of a trie: its forward score and token count come from its ancestors, once,
however many pre-tokens share the prefix. A pre-token's count is read at its last node.

Tokenizers are not trained here: the pieces are those of a public vocabulary file and a piece's score is
the logarithm of a Zipf share of its rank, (rank + shift) ** -exponent. A character in no piece costs one
byte token for each of its UTF-8 bytes, at `byte_score` each. Of equal scores the one with fewer tokens wins.

Defined cases: null and empty texts have 0 tokens; repeated rows return as often as they came; a null
doc_id stays; a pre-token longer than `longest` runs the same recurrence outside the trie, in a window of
the longest piece, so that it needs no memory of its length.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from locuslake.llm.shared import small_batches

MARK = "▁"


def zipf_pieces(path: str | None = None, shift: float = 2.7, exponent: float = 1.0) -> dict[str, float]:
    """Pieces of a public SentencePiece file with Zipf log shares of their ranks."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    raw = [(r + shift) ** -exponent for r in range(1, len(names) + 1)]
    total = math.log(sum(raw))
    return {name: math.log(x) - total for name, x in zip(names, raw, strict=True)}


class TrieCounter:
    """Counts of pre-tokens; the trie is dropped and begun again beyond `nodes` nodes."""

    def __init__(self, pieces: dict[str, float], byte_score: float = -20.0, nodes: int = 700_000, longest: int = 96):
        self.pieces, self.byte_score, self.nodes, self.longest = pieces, byte_score, nodes, longest
        self.reach = max(map(len, pieces))
        self.tail: dict[str, int] = {}  # of each last character: the longest piece that ends in it
        for p in pieces:
            self.tail[p[-1]] = max(self.tail.get(p[-1], 1), len(p))
        self._clear()

    def _clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]
        self.known: dict[str, int] = {}  # pre-token to the count at its last node

    def _extend(self, word: str, end: int, score: list[float], count: list[int], base: int = 0) -> tuple[float, int]:
        """Forward score and count of word[:end]; score[i - base] and count[i - base] are those of word[:i]."""
        c, pieces = word[end - 1], self.pieces
        size = 1 if c < "\x80" else len(c.encode("utf-8", "replace"))
        best, few = score[-1] + size * self.byte_score, count[-1] + size
        for start in range(max(0, end - self.tail.get(c, 0)), end):
            s = pieces.get(word[start:end])
            if s is not None:
                s += score[start - base]
                n = count[start - base] + 1
                if s > best or s == best and n < few:
                    best, few = s, n
        return best, few

    def __call__(self, pretoken: str) -> int:
        if (n := self.known.get(pretoken)) is not None:
            return n
        word = MARK + pretoken
        if len(word) > self.longest:
            return self._long(word)
        if len(self.score) > self.nodes:
            self._clear()
        child, scores, counts = self.child, self.score, self.count
        node, above, many = 0, [0.0], [0]
        for end, c in enumerate(word, 1):
            below = child.get((node, c))
            if below is None:
                best, few = self._extend(word, end, above, many)
                below = child[node, c] = len(scores)
                scores.append(best)
                counts.append(few)
            node = below
            above.append(scores[node])
            many.append(counts[node])
        self.known[pretoken] = counts[node]
        return counts[node]

    def _long(self, word: str) -> int:
        above, many, base = [0.0], [0], 0
        for end in range(1, len(word) + 1):
            best, few = self._extend(word, end, above, many, base)
            above.append(best)
            many.append(few)
            if len(above) > 8 * self.reach:
                cut = len(above) - self.reach
                del above[:cut], many[:cut]
                base += cut
        return many[-1]

    def text(self, text: str | None) -> int:
        get, words = self.known.get, (text or "").split()
        found = list(map(get, words))
        if None not in found:
            return sum(found)
        return sum([self(w) if n is None else n for w, n in zip(words, found, strict=True)])


def op1_token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every whole text; no shuffle, one bounded trie for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 20, 100)  # a large trie without cycles
        count = TrieCounter(zipf_pieces(path))
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len((t or "").split()) for t in texts], pa.int64()), pa.array([count.text(t) for t in texts], pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pretokens long, n_tokens long")
