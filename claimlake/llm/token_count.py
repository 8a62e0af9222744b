"""Token counts under a unigram model, by dynamic programming over a trie.

A text is cut into pre-tokens that no piece of the vocabulary crosses.  The
distinct pre-tokens of a batch are inserted in a trie; the best score of a
segmentation that ends at a node (the unigram forward score) and its number of
tokens depend on the path from the root alone, so they are computed once for
each shared prefix.  The count at a pre-token's terminal node is stored and each
document adds up the stored counts of its pre-tokens.

Vocabulary: the pieces of a public tokenizer file, in their order of merit.  The
file gives ranks, not probabilities, so piece r has the log-probability of a
Zipf law, -log(r + ``ZIPF``).  A character that no piece covers costs the lowest
score less ``PENALTY`` and counts one token for each of its UTF-8 bytes (byte
fallback).  Between equal scores the segmentation with the shorter last piece
stands.

Scale: no shuffle; documents are counted where they are read.  The vocabulary is
read on the driver and broadcast, its number of pieces checked.  A worker keeps
at most ``MEMO`` counts of ``MEMO_CHARS`` code points and the trie of one batch.

Defined cases: a null or empty text has no tokens; repeated rows give repeated
counts; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import map_bodies

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ZIPF, PENALTY, MEMO, MAX_PIECES = 2.7, 10.0, 300_000, 1_000_000
#: Code points of all pre-tokens whose counts are kept, and of one; longer ones are counted again when they come again.
MEMO_CHARS, KEPT_CHARS = 8_000_000, 1_000


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """Pieces in order of merit, a space for the file's word mark; no control,
    unknown, unused or byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    skip = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    return [model.id_to_piece(i).replace("▁", " ") for i in range(model.get_piece_size()) if not any(f(i) for f in skip)]


class UnigramTrie:
    """Forward scores and token counts of the prefixes of pre-tokens."""

    def __init__(self, pieces: list[str]):
        if len(pieces) > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")
        inner = [p for p in pieces if " " in p.lstrip(" ")]
        if inner:
            raise ValueError(f"pieces with spaces inside: {inner[:3]}")
        self.score = {p: -math.log(r + ZIPF) for r, p in reversed(list(enumerate(pieces, 1)))}
        self.unknown = min(self.score.values(), default=0.0) - PENALTY
        self.ends: dict[str, tuple[int, ...]] = {}
        lengths: dict[str, set[int]] = {}
        for p in self.score:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        self.ends = {k: tuple(sorted(v)) for k, v in lengths.items()}
        # a line feed that no piece holds ends a pre-token as well
        self.cut = re.compile(r" *[^ ]+| +" if any("\n" in p for p in pieces) else r" *[^ \n]+| +|\n")
        self.counts: dict[str, int] = {}
        self.held = 0  # code points of the counted pre-tokens

    def insert(self, words: list[str]) -> None:
        """Grow the trie of sorted distinct pre-tokens and store their counts.
        The nodes from the root to the last word are kept; sorted order visits
        each node of the trie once."""
        score, ends, unknown, counts = self.score, self.ends, self.unknown, self.counts
        best, tokens, before = [0.0], [0], ""
        for word in words:
            shared = 0
            for a, b in zip(word, before):  # noqa: B905  the shorter ends it
                if a != b:
                    break
                shared += 1
            del best[shared + 1:], tokens[shared + 1:]
            for i in range(shared, len(word)):
                last = word[i]
                own = score.get(last)
                if own is None:
                    top, n = best[i] + unknown, tokens[i] + len(last.encode("utf-8", "replace"))
                else:
                    top, n = best[i] + own, tokens[i] + 1
                if i:
                    for size in ends.get(word[i - 1:i + 1], ()):
                        if size > i + 1:
                            break
                        own = score.get(word[i + 1 - size:i + 1])
                        if own is not None and best[i + 1 - size] + own > top:
                            top, n = best[i + 1 - size] + own, tokens[i + 1 - size] + 1
                best.append(top)
                tokens.append(n)
            counts[word] = tokens[-1]
            before = word

    def pretokens(self, text: str) -> list[str]:
        return self.cut.findall(f" {text}") if text else []

    def count(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Tokens and pre-tokens of each text."""
        found = [Counter(self.pretokens(t)) for t in texts]
        if len(self.counts) > MEMO or self.held > MEMO_CHARS:
            self.counts.clear()
            self.held = 0
        fresh = sorted({w for words in found for w in words if w not in self.counts})
        self.insert(fresh)
        get = self.counts.__getitem__
        tokens = [sum(get(w) * k for w, k in words.items()) for words in found]
        for w in fresh:
            if len(w) > KEPT_CHARS:
                del self.counts[w]
            else:
                self.held += len(w)
        return tokens, [words.total() for words in found]


_KEPT: dict[str, UnigramTrie] = {}


def _of_worker(shared) -> UnigramTrie:
    """The trie of this Python worker, which serves one task after another."""
    pieces = shared.value
    name = f"{len(pieces)}:{hash(tuple(pieces))}"
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = UnigramTrie(pieces)
    return _KEPT[name]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 pieces: list[str] | None = None, step: int = 500) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_pretokens."""
    pieces = load_pieces(vocabulary) if pieces is None else pieces
    UnigramTrie(pieces)  # checked before any task runs
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def make():
        trie = _of_worker(shared)

        def work(ids: list, texts: list) -> list:
            tokens, words = [], []
            for k in range(0, len(texts), step):
                t, w = trie.count(texts[k:k + step])
                tokens += t
                words += w
            return [ids, tokens, words]

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_bodies(rows, f"doc_id {kind}, n_tokens long, n_pretokens long", make)


def totals(docs: DataFrame, by: list[str], text_col: str = "text", **how) -> DataFrame:
    """Tokens and documents by group."""
    marked = docs.select(F.struct(*[F.col(c) for c in by]).alias("doc_id"), F.col(text_col).alias("text"))
    counted = token_counts(marked, "doc_id", "text", **how)
    return counted.groupBy(*[F.col(f"doc_id.{c}").alias(c) for c in by]).agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"))
