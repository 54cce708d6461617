"""Language identification by a string kernel.

The kernel of two texts is the number of character n-grams (n = 1 to 3, the
blended spectrum) that both hold, divided by the geometric mean of their own
numbers.  Nyström landmarks, a few texts of each language, stand for the
training set; one-versus-rest kernel ridge regression is fitted on a bounded
sample of the labelled texts, whose rows are reduced to sums on the
executors.  The kernel is linear in the presence of n-grams, so landmarks
and dual weights fold to one weight per n-gram and language, and a text's
score is the sum over its n-grams.  Every label is learned, and every letter
of the landmarks is told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import importable, read

UNKNOWN = "und"
TRAIN_PER_LANG = 400   # labelled rows of each language that are fitted
LANDMARKS = 40         # of these, landmarks of each language at most
ALL_LANDMARKS = 2560   # landmarks of all languages together, unless one of each is more
RIDGE = 1e-3
MAX_TABLE = 1 << 24    # n-gram numbers looked up in a table; more are searched for
PARTS = 64             # parts of a language's rows among which the sample is chosen first
BATCH_DOCS = 64        # rows of a kernel matrix
BATCH_CELLS = 1 << 23  # cells of a presence matrix at most, one row at least
BATCH_CHARS = 4_000_000


def classes(letters: str) -> np.ndarray:
    """Code point -> class: 0 not a letter, 1 another letter, 2... the given
    lower-case letters, in upper case too."""
    table = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), dtype=np.int32, count=0x110000)
    for i, c in enumerate(letters):
        for form in {c, c.upper(), c.title()}:
            if len(form) == 1:
                table[ord(form)] = i + 2
    return table


def _codes(text: str, table: np.ndarray) -> np.ndarray:
    """Classes of a text's characters, runs of non-letters as one 0, with a 0
    at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.concatenate([[0], table[points], [0]]).astype(np.int64)
    return c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]


def grams(codes: np.ndarray, width: int) -> list[np.ndarray]:
    """n-gram numbers for n = 1, 2, 3; distinct n have distinct numbers."""
    one = codes + 1
    two = one[:-1] * width + one[1:]
    three = two[:-1] * width + one[2:]
    return [one, two, three]


class Model:
    """``languages``; ``letters``; ``known``: sorted n-gram numbers of the
    landmarks; ``weights``: one row for each, one column per language;
    ``bias`` per language."""

    def __init__(self, languages: list[str], letters: str, known: np.ndarray):
        self.languages, self.letters, self.known = languages, letters, known
        self.weights = np.zeros((len(known), len(languages)), dtype=np.float32)
        self.bias = np.zeros(len(languages))

    def tables(self) -> tuple[np.ndarray, np.ndarray | None]:
        width = len(self.letters) + 3
        index = None
        if width ** 3 <= MAX_TABLE:
            index = np.full(width ** 3, len(self.known), dtype=np.int32)
            index[self.known] = np.arange(len(self.known))
        return classes(self.letters), index

    def places(self, numbers: np.ndarray, index: np.ndarray | None) -> np.ndarray:
        """Places of n-gram numbers in ``known``; its length for all others."""
        if index is not None:
            return index[numbers]
        if not len(self.known):
            return np.zeros(len(numbers), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.known, numbers), len(self.known) - 1)
        return np.where(self.known[at] == numbers, at, len(self.known))

    def scores(self, texts: list[str], tables) -> tuple[np.ndarray, np.ndarray]:
        """(regression values, has a letter): the presence matrix of a batch
        of texts times the folded weights."""
        f, lettered = np.empty((len(texts), len(self.languages))), np.zeros(len(texts), dtype=bool)
        step = max(1, min(BATCH_DOCS, BATCH_CELLS // (len(self.known) + 1)))
        for lo in range(0, len(texts), step):
            some = texts[lo:lo + step]
            x = np.zeros((len(some), len(self.known)), dtype=np.float32)
            for row, (held, letter) in enumerate(self.presence(some, tables)):
                x[row, held] = 1
                lettered[lo + row] = letter
            f[lo:lo + step] = (x @ self.weights) / np.sqrt(np.maximum(1, x.sum(axis=1)))[:, None] + self.bias
        return f, lettered

    def presence(self, texts: list[str], tables) -> Iterator[tuple[np.ndarray, bool]]:
        """(places of the known n-grams, has a letter) of each text."""
        table, index = tables
        seen = np.zeros(len(self.known) + 1, dtype=bool)
        for text in texts:
            lettered = False
            for lo in range(0, len(text), BATCH_CHARS):  # two characters of overlap keep all n-grams
                codes = _codes(text[max(0, lo - 2):lo + BATCH_CHARS], table)
                lettered |= bool(codes.any())
                for g in grams(codes, len(self.letters) + 3):
                    seen[self.places(g, index)] = True
            held = np.flatnonzero(seen[:-1])
            seen[:] = False
            yield held, lettered


class Basis:
    """The landmarks by n-gram: those that hold the n-gram at place i are
    ``marks[start[i]:start[i + 1]]``."""

    def __init__(self, known: np.ndarray, sets: list[np.ndarray]):
        self.sizes = np.array([max(1, len(s)) for s in sets], dtype=np.float64)
        places = np.searchsorted(known, np.concatenate([*sets, np.zeros(0, dtype=np.int64)]))
        marks = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self.marks = marks[np.argsort(places, kind="stable")].astype(np.int32)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(places, minlength=len(known)))])

    def kernel(self, held: np.ndarray) -> np.ndarray:
        """Kernel of a text of these n-grams with each landmark."""
        first, count = self.start[held], self.start[held + 1] - self.start[held]
        at = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
        shared = np.bincount(self.marks[at], minlength=len(self.sizes))
        return shared / np.sqrt(self.sizes * max(1, len(held)))


_ready: dict[str, tuple] = {}  # model digest -> tables, kept while the worker lives


def _tables(tag: str, model: Model) -> tuple:
    if tag not in _ready:
        _ready.clear()
        _ready[tag] = model.tables()
    return _ready[tag]


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    for lo in range(0, batch.num_rows, BATCH_DOCS):
        yield lo, [t or "" for t in batch.column(column).slice(lo, BATCH_DOCS).to_pylist()]


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
        key_col: str = "doc_id") -> Model:
    """Fit on the labelled rows of ``docs`` (not NULL, not empty).

    The sample has TRAIN_PER_LANG rows of each language, those of the least
    hash of the key, so it does not depend on the order of rows.  Only keys
    and labels are shuffled to choose it.  The driver gets the landmarks'
    distinct n-grams and the sums of the fit.  Of more languages than
    ALL_LANDMARKS / LANDMARKS each has fewer landmarks, one at least.
    """
    spark = docs.sparkSession
    importable(spark)
    src = docs.select(F.col(key_col).cast("string").alias("key"), F.col(lang_col).cast("string").alias("lang"),
                      F.col(text_col).alias("text"))
    labels = src.where(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN)).select("key", "lang")
    languages = sorted(r[0] for r in labels.select("lang").distinct().collect())
    if not languages:
        return Model([], "", np.zeros(0, dtype=np.int64))
    # a language's keys are dealt over PARTS, each cut to what all may have
    order = [F.xxhash64("key"), "key"]
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("key")), F.lit(PARTS))
    chosen = (labels.select("lang", "key", part.alias("part"))
              .withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
              .where(F.col("place") <= TRAIN_PER_LANG)
              .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("place") <= TRAIN_PER_LANG)
              .groupBy("key", "lang").agg(F.min("place").alias("place")).collect())
    # at most TRAIN_PER_LANG keys of each language: a bounded broadcast
    few = spark.createDataFrame([(r.key, r.lang, r.place) for r in chosen], "key string, lang string, place int")
    sample = (src.join(F.broadcast(few.select("key", "lang", "place")), ["key", "lang"])
              .where(F.coalesce(F.length("text"), F.lit(0)) > 0).select("lang", "place", "text"))
    marks = sample.where(F.col("place") <= max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages))))

    def alphabet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for b in batches:
            for t in b.column(0).to_pylist():
                found.update(c.lower() for c in set(t) if c.isalpha())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(ord(c) for c in found if len(c) == 1), pa.int32())],
                                         names=["letter"])

    letters = "".join(sorted(chr(r.letter) for r in
                             marks.select("text").mapInArrow(alphabet, "letter int").distinct().collect()))
    width = len(letters) + 3

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes(letters)
        for b in batches:
            sets = [np.unique(np.concatenate(grams(_codes(t, table), width))).astype(np.int64)
                    for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.int64()))], names=["grams"])

    sets = [np.array(r.grams, dtype=np.int64) for r in
            marks.select("text").mapInArrow(spell, "grams array<long>").distinct().orderBy("grams").collect()]
    known = np.unique(np.concatenate([*sets, np.zeros(0, dtype=np.int64)]))
    model = Model(languages, letters, known)
    basis = Basis(known, sets)
    place = {x: i for i, x in enumerate(languages)}
    shared = spark.sparkContext.broadcast((model, basis))
    m, n = len(sets), len(languages)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, basis = shared.value
        tables, total = model.tables(), np.zeros((m + 1, m + 1 + n))
        for b in batches:
            langs = b.column(0).to_pylist()
            for lo, texts in _batches(b, 1):
                k = _kernel(model, basis, texts, tables)
                y = np.full((len(texts), n), -1.0)
                y[np.arange(len(texts)), [place[x] for x in langs[lo:lo + len(texts)]]] = 1
                total += k.T @ np.hstack([k, y])
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)], pa.list_(pa.float64()))],
                                         names=["part"])

    total = np.zeros((m + 1) * (m + 1 + n))
    for r in (sample.select("lang", "text").coalesce(8).mapInArrow(sums, "part array<double>")
              .toLocalIterator()):
        total += np.array(r.part)
    total = total.reshape(m + 1, m + 1 + n)
    gram = np.zeros((m + 1, m + 1))  # the landmarks' own kernel; the bias is barely held
    for j, s in enumerate(sets):
        gram[j, :m] = basis.kernel(np.searchsorted(known, s))
    gram[m, m] = 1e-3
    rows = max(1.0, float(total[m, m]))
    alpha = np.linalg.lstsq(total[:, :m + 1] + RIDGE * rows * (gram + 1e-6 * np.eye(m + 1)),
                            total[:, m + 1:], rcond=None)[0]
    for j, s in enumerate(sets):
        model.weights[np.searchsorted(known, s)] += alpha[j] / np.sqrt(basis.sizes[j])
    model.bias[:] = alpha[m]
    return model


def _kernel(model: Model, basis: Basis, texts: list[str], tables) -> np.ndarray:
    """Kernel of each text with each landmark, and a 1."""
    k = np.ones((len(texts), len(basis.sizes) + 1))
    for row, (held, _) in enumerate(model.presence(texts, tables)):
        k[row, :-1] = basis.kernel(held)
    return k


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``: the language of the
    largest regression value f, and (f + 1) / 2 held to 0..1.  The names are
    fixed; columns of ``docs`` with these names are replaced.

    Whole texts are looked at.  NULL, empty texts and texts without a letter
    are ``und``, with score 0, and so is every text if nothing was learned.
    Ties go to the language that sorts first.  Rows are independent.
    """
    importable(docs.sparkSession)
    gone = {"lang_pred", "lang_score"}
    src = docs.drop(*[c for c in docs.columns if c.lower() in gone])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tag = f"{id(model)}-{len(model.known)}-{float(model.weights.sum())}"
    at = src.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            langs, scores = [], []
            for _, texts in _batches(b, at):
                if not model.languages:
                    langs += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                f, lettered = model.scores(texts, _tables(tag, model))
                best = f.argmax(axis=1)
                # six digits: a row's last bits depend on the rows beside it
                value = np.round(np.clip((f[np.arange(len(f)), best] + 1) / 2, 0, 1), 6)
                langs += [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, lettered, strict=True)]
                scores += np.where(lettered, value, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, "lang_pred", "lang_score"])

    from pyspark.sql import types as T
    return src.mapInArrow(predict, T.StructType([*src.schema.fields,
                                                 T.StructField("lang_pred", T.StringType()),
                                                 T.StructField("lang_score", T.DoubleType())]))


FOLDS = 5


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learned(docs: DataFrame) -> Model:
    """Model of the documents that are not held out."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


def op9_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = learned(docs.select("doc_id", "text", "lang"))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                    F.col("lang_score").alias("score")))
