"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct chunks (a run of word marks and what follows it, cut
further where no piece has the two characters side by side, so that no merge
can cross) are laid end to end and indexed by a suffix array.  Every piece of the
vocabulary is binary-searched in it, which gives the range of its
occurrences; the occurrences are edges from their start to their end.  The
edges are sorted by position and relaxed from left to right: an edge is
taken if its piece may follow the last piece of the text before it.

The model is a BPE one, whose result is not the path of best total score
but the one that its merges lead to.  Relaxing finds exactly that: pieces
x, y may stand side by side if encoding the string xy gives x, y again, and
the encoding of a text is the only path all of whose neighbours may.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, importable

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BATCH_ROWS = 100         # texts encoded at once
BATCH_CHARS = 100_000    # characters indexed at once
LONG_CHUNK = 32          # characters from which a chunk is cut further
CACHE_CHUNKS = 500_000   # chunks whose encoding a worker remembers
PAIR_SLOTS = 1 << 21     # slots of the cache of judged neighbours


def _fields(data: bytes) -> dict[int, object]:
    """Fields of a protocol buffer message by number, the last of each:
    numbers, and bytes of nested messages and strings."""
    out, at = {}, 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(data):
        key = number()
        if key & 7 == 0:
            out[key >> 3] = number()
            continue
        size = number() if key & 7 == 2 else 8 if key & 7 == 1 else 4
        out[key >> 3] = data[at:at + size]
        at += size
    return out


# Field numbers of a model file, and the number of BPE.
TRAINER, NORMALISER, MODEL_TYPE, CHARS_MAP, MARK_FIRST, SHRINK, MARKS = 2, 3, 3, 2, 3, 4, 5
BPE = 2


def _check(model: bytes) -> None:
    """A model whose texts are encoded as here: merges, characters as they
    are, a mark before the text and for every space, no space left out."""
    parts = _fields(model)
    trainer, normaliser = (_fields(parts.get(n, b"")) for n in (TRAINER, NORMALISER))
    if trainer.get(MODEL_TYPE, 1) != BPE:
        raise ValueError("not a BPE model")
    if normaliser.get(CHARS_MAP, b"") or normaliser.get(SHRINK, 1) or not (
            normaliser.get(MARK_FIRST, 1) and normaliser.get(MARKS, 1)):
        raise ValueError("the model changes characters or spaces of a text before it encodes it")


def vocabulary(path: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind: piece, byte, unknown or other.  A
    model that is not a BPE one, or that normalises texts, is refused."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    _check(sp.serialized_model_proto())
    out = []
    for i in range(sp.get_piece_size()):
        kind = ("unknown" if sp.is_unknown(i) else "byte" if sp.is_byte(i)
                else "other" if sp.is_control(i) or sp.is_unused(i) else "piece")
        out.append((sp.id_to_piece(i), sp.get_score(i), kind))
    return out


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


class Codec:
    def __init__(self, vocab: list[tuple[str, float, str]]):
        self.pieces = [p for p, _, _ in vocab]
        self.size = len(vocab)
        self.id_of = {p: i for i, (p, _, kind) in enumerate(vocab) if kind == "piece"}
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("a piece has a word mark inside; chunks can't be encoded apart")
        byte_ids = [i for i, (_, _, kind) in enumerate(vocab) if kind == "byte"]
        self.bytes_from = byte_ids[0] if len(byte_ids) == 256 else None
        self.unknown = next(i for i, (_, _, kind) in enumerate(vocab) if kind == "unknown")
        self.raw = [b"" if kind in ("other", "unknown") else
                    bytes([int(p[3:5], 16)]) if kind == "byte" else p.encode()
                    for p, _, kind in vocab]
        scores = np.array([s for _, s, _ in vocab] + [0.0])
        # neighbours that a merge joins: sorted keys (left, right) -> score
        joins = {}
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    joins[a * (self.size + 1) + b] = i
        self.join_keys = np.array(sorted(joins), dtype=np.int64)
        self.join_ids = np.array([joins[k] for k in self.join_keys.tolist()], dtype=np.int64)
        self.join_scores = scores[self.join_ids]
        self.joins, self.scores = joins, scores
        self._histories()
        by_len: dict[int, list[int]] = {}
        for piece, i in self.id_of.items():
            if self.whole[i]:
                by_len.setdefault(len(piece), []).append(i)
        self.by_len = {n: (np.array(ids, dtype=np.int64),
                           np.array([[ord(c) for c in self.pieces[i]] for i in ids], dtype=np.int64))
                       for n, ids in by_len.items()}
        self.longest = max(self.by_len)
        self.slot_keys = np.full(PAIR_SLOTS, -1, dtype=np.int64)
        self.slot_ok = np.zeros(PAIR_SLOTS, dtype=bool)
        self.pairs = np.unique(np.array([ord(a) << 21 | ord(b) for p in self.id_of for a, b in zip(p, p[1:], strict=False)],
                                        dtype=np.int64))
        self.chunks: dict[str, bytes] = {}  # by chunk without its first mark: ids as int32
        self.broken: set[str] = set()       # of these, those that do not decode to themselves

    def _histories(self) -> None:
        """For each piece the merges that build it from its characters, in
        order: scores, and the symbols at its left and right end before each.
        ``whole``: pieces that merging their characters leads to."""
        steps = max(map(len, self.id_of)) + 1
        n = self.size + 1
        self.when = np.full((n, steps), -np.inf)
        self.left_end = np.full((n, steps), self.size, dtype=np.int64)
        self.right_end = np.full((n, steps), self.size, dtype=np.int64)
        self.whole = np.zeros(n, dtype=bool)
        self.whole[self.size] = True
        for piece, i in self.id_of.items():
            symbols = [self.id_of.get(c, self.size) for c in piece]
            k = 0
            while True:
                self.left_end[i, k], self.right_end[i, k] = symbols[0], symbols[-1]
                best, at = -np.inf, -1
                for j in range(len(symbols) - 1):
                    to = self.joins.get(symbols[j] * (self.size + 1) + symbols[j + 1])
                    if to is not None and self.scores[to] > best:
                        best, at = self.scores[to], j
                if at < 0:
                    break
                self.when[i, k] = best
                symbols[at:at + 2] = [self.joins[symbols[at] * (self.size + 1) + symbols[at + 1]]]
                k += 1
            self.whole[i] = symbols == [i]

    def _judge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each b may follow its a: the merges of both are replayed
        in order of score, until one across the border would come first."""
        ok = self.whole[a] & self.whole[b]
        live = np.flatnonzero(ok)
        i, j = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
        while len(live):
            x, y, p, q = a[live], b[live], i[live], j[live]
            key = self.right_end[x, p] * (self.size + 1) + self.left_end[y, q]
            at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
            across = np.where(self.join_keys[at] == key, self.join_scores[at], -np.inf)
            own, other = self.when[x, p], self.when[y, q]
            # of equal scores the leftmost goes first
            crossed = (across > own) & (across >= other) & (across > -np.inf)
            done = (own == -np.inf) & (other == -np.inf)
            ok[live[crossed]] = False
            first = own >= other
            i[live] += first
            j[live] += ~first
            live = live[~crossed & ~done]
        return ok

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * (self.size + 1) + b
        slot = (key * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
        ok = self.slot_ok[slot]
        missed = np.flatnonzero(self.slot_keys[slot] != key)
        if len(missed):
            new, first = np.unique(key[missed], return_index=True)
            judged = self._judge(a[missed[first]], b[missed[first]])
            ok[missed] = judged[np.searchsorted(new, key[missed])]
            at = slot[missed[first]]
            self.slot_keys[at], self.slot_ok[at] = new, judged
            # a slot that two new keys share holds the later one of both arrays
        return ok

    def _edges(self, text: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, piece, length) of every occurrence of every piece.
        text: 1-based symbol numbers; symbols: their sorted code points."""
        bits = int(len(symbols) + 1).bit_length()
        n, depth = len(text), 63 // bits
        key = np.zeros(n, dtype=np.int64)
        padded = np.concatenate([text, np.zeros(depth, dtype=np.int64)])
        for k in range(depth):
            key = (key << bits) | padded[k:k + n]
        levels = []  # (depth, sorted distinct keys)
        while depth < self.longest:
            known, rank = np.unique(key, return_inverse=True)
            levels.append((depth, known))
            rank = np.concatenate([rank + 1, np.zeros(depth, dtype=np.int64)])
            key = rank[:n] * (len(known) + 1) + rank[depth:depth + n]
            depth *= 2
        order = np.argsort(key)
        ordered = key[order]

        def key_range(codes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
            """Range of keys at a level that begin with these symbols."""
            length = codes.shape[1]
            if level == 0:
                d = levels[0][0] if levels else depth
                lo = np.zeros(len(codes), dtype=np.int64)
                for k in range(length):
                    lo = (lo << bits) | codes[:, k]
                shift = bits * (d - length)
                return lo << shift, (lo + 1) << shift
            d, known = levels[level - 1]
            m = len(known) + 1
            lo, hi = (np.searchsorted(known, x) + 1 for x in key_range(codes[:, :d], level - 1))
            if length <= d:
                return lo * m, hi * m
            lo2, hi2 = (np.searchsorted(known, x) + 1
                        for x in key_range(codes[:, d:], level - 1))
            found = hi > lo  # the first d symbols are a whole key, so one rank
            return lo * m + lo2, np.where(found, lo * m + hi2, lo * m + lo2)

        starts, ids, lengths = [], [], []
        for length, (piece_ids, chars) in self.by_len.items():
            codes = np.searchsorted(symbols, chars)
            known = (symbols[np.minimum(codes, len(symbols) - 1)] == chars).all(axis=1)
            if not known.any():
                continue
            lo, hi = (np.searchsorted(ordered, x) for x in key_range(codes[known] + 1, len(levels)))
            count = np.maximum(hi - lo, 0)
            starts.append(order[np.repeat(lo, count) + _ranges(count)])
            ids.append(np.repeat(piece_ids[known], count))
            lengths.append(np.full(int(count.sum()), length, dtype=np.int64))
        none = np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(x) if x else none for x in (starts, ids, lengths))

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of each (not empty) chunk, as int32."""
        sizes = np.array([len(c) for c in chunks], dtype=np.int64)
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"),
                             dtype=np.uint32).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        # one stop symbol behind each chunk
        where = np.arange(len(code)) + np.repeat(np.arange(len(chunks)), sizes)
        begin = first + np.arange(len(chunks))
        text = np.full(len(code) + len(chunks), 0x110000, dtype=np.int64)
        text[where] = code
        symbols, numbers = np.unique(text, return_inverse=True)
        start, piece, length = self._edges(numbers + 1, symbols)
        # characters without a piece are edges of their own
        lone = np.ones(len(text), dtype=bool)
        lone[start[length == 1]] = False
        lone[begin + sizes] = False
        lone = np.flatnonzero(lone)
        start = np.concatenate([start, lone])
        piece = np.concatenate([piece, np.full(len(lone), self.size, dtype=np.int64)])
        length = np.concatenate([length, np.ones(len(lone), dtype=np.int64)])
        owner = np.repeat(np.arange(len(chunks)), sizes + 1)
        offset = start - begin[owner[start]]
        end = offset + length
        level = end.astype(np.uint16) if int(sizes.max()) < 65536 else end
        by_end = np.argsort(level, kind="stable")
        start, piece, length, offset, end = (x[by_end] for x in (start, piece, length, offset, end))
        last = np.full(len(text) + 1, self.size, dtype=np.int64)
        origin = np.full(len(text) + 1, -1, dtype=np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1, [len(end)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            s, p = start[lo:hi], piece[lo:hi]
            ok = np.where(offset[lo:hi] == 0, self.whole[p], False)
            inner = np.flatnonzero(offset[lo:hi] > 0)
            ok[inner] = self.may_follow(last[s[inner]], p[inner])
            s, p = s[ok], p[ok]
            to = s + length[lo:hi][ok]
            last[to], origin[to] = p, s
        # walk back from the ends of the chunks
        steps, at, live = [], begin + sizes, np.arange(len(chunks))
        while len(live):
            steps.append((live, last[at], origin[at]))
            at = origin[at]
            go = at > begin[live]
            live, at = live[go], at[go]
        who = np.concatenate([x[0] for x in steps])
        ids = np.concatenate([x[1] for x in steps])
        frm = np.concatenate([x[2] for x in steps])
        back = np.lexsort((frm, who))
        who, ids, frm = who[back], ids[back], frm[back]
        ids, who = self._spell(ids, who, text[frm])
        cuts = (4 * np.searchsorted(who, np.arange(len(chunks) + 1))).tolist()
        flat = ids.astype(np.int32).tobytes()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _spell(self, ids, who, char):
        """Characters without a piece become the bytes of their UTF-8 form."""
        odd = np.flatnonzero(ids == self.size)
        if not len(odd):
            return ids, who
        if self.bytes_from is None:
            ids[odd] = self.unknown
            return ids, who
        spelled = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), dtype=np.uint8)
                   for c in char[odd].tolist()]
        count = np.ones(len(ids), dtype=np.int64)
        count[odd] = [len(x) for x in spelled]
        out, who = np.repeat(ids, count), np.repeat(who, count)
        is_odd = np.repeat(ids == self.size, count)
        out[is_odd] = np.concatenate(spelled).astype(np.int64) + self.bytes_from
        return out, who

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; NULL and empty texts have none."""
        split = [chunks_of(text) if text else [] for text in texts]
        wanted = set().union(*split)
        new = sorted(wanted.difference(self.chunks))
        if len(self.chunks) + len(new) > CACHE_CHUNKS:
            self.chunks = {c: self.chunks[c] for c in wanted if c in self.chunks}
            self.broken &= wanted
        # a very long text is not remembered
        seen = dict(self.chunks) if len(new) > CACHE_CHUNKS else self.chunks
        whole = [MARK + c for c in new]
        parts = {c: self._cut(c) for c in whole if len(c) >= LONG_CHUNK}
        small = sorted({*(c for c in whole if len(c) < LONG_CHUNK), *(x for own in parts.values() for x in own)})
        ids, lo = {}, 0
        while lo < len(small):
            hi, chars = lo, 0
            while hi < len(small) and (hi == lo or chars + len(small[hi]) <= BATCH_CHARS):
                chars += len(small[hi])
                hi += 1
            ids.update(zip(small[lo:hi], self._encode(small[lo:hi]), strict=True))
            lo = hi
        ids.update((c, b"".join(map(ids.__getitem__, own))) for c, own in parts.items())
        seen.update((c, ids[w]) for c, w in zip(new, whole, strict=True))
        if not self._same(whole, ids):
            self.broken.update(c for c, w in zip(new, whole, strict=True) if not self._same([w], ids))
        self.texts = split
        return [np.frombuffer(b"".join(map(seen.__getitem__, own)), dtype=np.int32) for own in split]

    def _same(self, chunks: list[str], ids: dict[str, bytes]) -> bool:
        """Whether the ids of these chunks, end to end, decode to them."""
        flat = np.frombuffer(b"".join(map(ids.__getitem__, chunks)), dtype=np.int32).tolist()
        return b"".join(map(self.raw.__getitem__, flat)) == "".join(chunks).encode("utf-8", "surrogatepass")

    def round_trips(self, texts: list[str | None]) -> list[bool | None]:
        """For the texts that were encoded last, whether decoding their ids
        gives them back: a text's bytes are those of its chunks, one after
        another, each of which was decoded when it was new."""
        return [None if t is None else MARK not in t and self.broken.isdisjoint(own)
                for t, own in zip(texts, self.texts, strict=True)]

    def _cut(self, chunk: str) -> list[str]:
        """A chunk in parts between which no merge is possible."""
        code = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        pair = code[:-1] << 21 | code[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        cuts = np.flatnonzero(self.pairs[at] != pair) + 1
        if not len(cuts):
            return [chunk]
        cuts = [0, *cuts.tolist(), len(chunk)]
        return [chunk[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        text = text.replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def chunks_of(text: str) -> list[str]:
    """The text with a word mark before it and for each space, cut before
    every run of marks; chunks are given without their first mark.  No piece
    has a mark behind another character, so no merge crosses a cut."""
    if MARK not in text and "  " not in text and text[0] != " " != text[-1]:
        return text.split(" ")
    parts = (MARK + text.replace(" ", MARK)).split(MARK)
    out, marks = [], 0
    for p in parts[1:]:
        marks += 1
        if p:
            out.append(MARK * (marks - 1) + p)
            marks = 0
    if marks:
        out.append(MARK * (marks - 1))
    return out


def _digest(vocab: list[tuple[str, float, str]]) -> str:
    return blake2b(repr(vocab).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


_codecs: dict[str, Codec] = {}  # kept while the worker lives


def encode(df: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``df`` with ``token_ids`` (array of int), ``n_tokens`` and
    ``round_trip``: whether decoding the ids gives the text back.  The names
    get a leading underscore where ``df`` has them already.

    The ids are those of the model's own library.  NULL and empty texts have
    an empty array and 0 tokens (round_trip: true for empty, NULL for NULL).
    A text that holds the mark character itself comes back with spaces for
    it.  Rows are independent: repeated rows give repeated results; an empty
    table gives no rows.  No shuffle; a worker holds the vocabulary's
    tables, bounded caches, and one Arrow batch, indexed in pieces of
    BATCH_CHARS.
    """
    return _coded(df, vocabulary(model), text_col)


def _coded(df: DataFrame, vocab: list[tuple[str, float, str]], text_col: str) -> DataFrame:
    importable(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    tag = _digest(vocab)
    names = fresh(df, "token_ids", "n_tokens", "round_trip")
    schema = T.StructType([*df.schema.fields,
                           T.StructField(names[0], T.ArrayType(T.IntegerType())),
                           T.StructField(names[1], T.LongType()),
                           T.StructField(names[2], T.BooleanType())])
    text_at = df.columns.index(text_col)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs.get(tag)
        if codec is None:
            codec = _codecs[tag] = Codec(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                b = batch.slice(lo, BATCH_ROWS)
                texts = b.column(text_at).to_pylist()
                ids = codec.encode_texts(texts)
                ok = codec.round_trips(texts)
                sizes = np.array([len(x) for x in ids], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.ListArray.from_arrays(pa.array(offsets), flat),
                     pa.array(sizes), pa.array(ok, pa.bool_())],
                    names=[*b.schema.names, *names])

    return df.mapInArrow(code, schema)


def decode(df: DataFrame, model: str = DEFAULT_MODEL, ids_col: str = "token_ids") -> DataFrame:
    """``df`` with ``decoded``: the text of the ids.  NULL gives NULL, no ids
    the empty text; bytes that are not UTF-8 become U+FFFD; an id outside the
    vocabulary fails the job."""
    importable(df.sparkSession)
    vocab = vocabulary(model)
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    tag = _digest(vocab)
    name = fresh(df, "decoded")[0]
    at = df.columns.index(ids_col)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs.get(tag)
        if codec is None:
            codec = _codecs[tag] = Codec(shared.value)
        for b in batches:
            texts = [None if x is None else codec.decode(x) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, name])

    return df.mapInArrow(spell, T.StructType([*df.schema.fields,
                                              T.StructField(name, T.StringType())]))


def op5_sentencepiece(spark, sf_dir, model: str = DEFAULT_MODEL):
    from tidemark.llm.common import read
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, model).select(
        "doc_id", "token_ids", "n_tokens", "round_trip",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
