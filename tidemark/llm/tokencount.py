"""Token counts by a linear longest-match automaton.

The greedy longest-match word-piece split of a word is found in one pass
over its characters: the vocabulary is a trie with two roots (word-initial
pieces and continuation pieces), and every node carries a failure link
together with the *number* of pieces that following the link gives off.
Adding these numbers gives the token count; no piece is ever built.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import importable

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CACHE_ENTRIES = 300_000  # distinct words remembered per Python worker

# White-space tokens are cut into runs of word characters and single others.
WORD = re.compile(r"\w+|[^\w\s]")


def pieces_of_model(path: str) -> tuple[list[str], list[str]]:
    """(initial, continuation) pieces of a SentencePiece vocabulary: those
    that begin with the word mark, without it, and all other plain pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    initial, rest = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        if piece.startswith("▁"):
            if piece.strip("▁"):
                initial.append(piece[1:])
        else:
            rest.append(piece)
    return initial, rest


class Automaton:
    """Trie with failure links and counts of given-off pieces."""

    def __init__(self, initial: Iterable[str], continuation: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]  # roots: 0 initial, 1 continuation
        ends = set()
        for root, vocab in ((0, initial), (1, continuation)):
            for piece in vocab:
                at = root
                for c in piece:
                    to = self.next[at].get(c)
                    if to is None:
                        to = self.next[at][c] = len(self.next)
                        self.next.append({})
                    at = to
                if at != root:
                    ends.add(at)
        # -1: no link; the word cannot be cut if the automaton gets stuck here
        self.link, self.given = [-1] * len(self.next), [0] * len(self.next)
        level = [0, 1]
        while level:
            below = []
            for u in level:
                for c, v in self.next[u].items():
                    below.append(v)
                    if v in ends:
                        self.link[v], self.given[v] = 1, 1
                        continue
                    z, n = self.link[u], self.given[u]
                    while z >= 0 and c not in self.next[z]:
                        n += self.given[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[v], self.given[v] = self.next[z][c], n
            level = below

    def count(self, word: str) -> int:
        """Pieces of one word; a word that cannot be cut is one unknown token."""
        step, link, given = self.next, self.link, self.given
        at, n = 0, 0
        for c in word:
            while (to := step[at].get(c)) is None:
                n += given[at]
                at = link[at]
                if at < 0:
                    return 1
            at = to
        while at != 1:
            n += given[at]
            at = link[at]
            if at < 0:
                return 1
        return n


class Counts(dict):
    """White-space token -> pieces, filled by the automaton on first use."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        n = self[token] = sum(map(self.automaton.count, WORD.findall(token)))
        return n


_counts: dict[int, Counts] = {}  # one per vocabulary, kept while the worker lives


def token_counts(df: DataFrame, initial: list[str], continuation: list[str],
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``n_words``, ``n_tokens``) per row: white-space tokens, and
    greedy longest-match pieces of the whole text.

    NULL and empty text have 0 of both.  Rows are independent: repeated
    rows give repeated results, a NULL id stays NULL, an empty table gives
    no rows.  No shuffle; a worker holds the automaton (bounded by the
    vocabulary), a bounded word cache and one Arrow batch.
    """
    importable(df.sparkSession)
    vocab = df.sparkSession.sparkContext.broadcast((list(initial), list(continuation)))
    hash_key = hashlib.sha1("\0".join([*initial, "\1", *continuation]).encode()).hexdigest()
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts.get(hash_key)
        if counts is None:
            counts = _counts[hash_key] = Counts(Automaton(*vocab.value))
        for b in batches:
            n_words, n_tokens = [], []
            for text in b.column(1):
                tokens = (text.as_py() or "").split()
                n_words.append(len(tokens))
                n_tokens.append(sum(map(counts.__getitem__, tokens)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["id", "n_words", "n_tokens"])

    return src.mapInArrow(count, schema).withColumnRenamed("id", id_col)


def op3_token_counts(spark, sf_dir, model: str = DEFAULT_MODEL):
    from tidemark.llm.common import read
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, *pieces_of_model(model))
