"""Language of a text by multinomial naive Bayes over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import balanced, strings

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
#: Bytes of text whose n-grams are held at once.
CHUNK_BYTES = 1 << 20


def _letter_table() -> np.ndarray:
    """Code points of the basic plane: a letter's lower case, else a space."""
    table = np.full(1 << 16, 0x20, np.uint32)
    for point in range(1 << 16):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


_LETTERS: list[np.ndarray] = []


def _letters(text: str) -> np.ndarray:
    """Code points of a text: lower-cased letters, and spaces for all else."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points > 0xFFFF, points, _LETTERS[0][np.minimum(points, 0xFFFF)])


def _gram_table(letters: np.ndarray, owner: np.ndarray, orders, buckets: int) -> np.ndarray:
    """A row of buckets per place: the grams of all orders that start there."""
    found = []
    count = len(letters)
    mixed = np.zeros(count, np.uint32)
    for order in range(1, max(orders) + 1):
        # Extends every gram by the character ``order - 1`` places on.
        ahead = np.zeros(count, np.uint32)
        ahead[: max(0, count - order + 1)] = letters[order - 1 :]
        mixed = (mixed ^ ahead) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        if order in orders:
            inside = np.zeros(count, bool)
            inside[: max(0, count - order + 1)] = owner[order - 1 :] == owner[: max(0, count - order + 1)]
            found.append(np.where(inside, mixed % np.uint32(buckets), buckets).astype(np.int32))
    return np.stack(found, axis=1) if found else np.empty((count, 0), np.int32)


def grams(texts: pa.Array, orders=ORDERS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams, number of them per text).

    Characters are lower-cased letters; each run of anything else is one space,
    and so are both ends of a text. Grams of all orders start at each place.
    """
    spelled = [" " + t + " " for t in texts.to_pylist()]
    letters = _letters("".join(spelled))
    owner = np.repeat(np.arange(len(spelled), dtype=np.int32), np.fromiter(map(len, spelled), np.int64))
    # Of neighbouring spaces in one text the first stays.
    space = letters == 0x20
    keep = np.ones(len(letters), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    letters, owner = letters[keep], owner[keep]
    return _gram_table(letters, owner, orders, buckets), np.bincount(owner, minlength=len(spelled))


def windows(text: str, orders=ORDERS, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """The n-grams of one long text, as ``grams`` gives them, a window at a time.

    The last places of a window, whose grams reach beyond it, open the next one.
    """
    ahead = max(orders) - 1
    left = _letters(" ")
    for begin in range(0, max(len(text), 1), CHUNK_BYTES):
        last = begin + CHUNK_BYTES >= len(text)
        letters = np.concatenate([left, _letters(text[begin : begin + CHUNK_BYTES] + (" " if last else ""))])
        space = letters == 0x20
        keep = np.ones(len(letters), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        letters = letters[keep]
        done = len(letters) if last else max(len(letters) - ahead, 0)
        yield _gram_table(letters, np.zeros(len(letters), np.int8), orders, buckets)[:done]
        left = letters[done:]


def _is_long(texts: pa.Array) -> bool:
    """Whether these are one text of more than a chunk."""
    return len(texts) == 1 and texts.nbytes > CHUNK_BYTES


def _only(texts: pa.Array) -> str:
    return texts[0].as_py()


@dataclass
class Model:
    """Log probabilities: a row per bucket (the last, for no gram, is zero)."""

    langs: list[str]
    prior: np.ndarray
    log_prob: np.ndarray

    def _places(self, table: np.ndarray) -> np.ndarray:
        """Sums of log probabilities of the grams at each place, by language."""
        places = np.zeros((len(table), len(self.langs)), np.float32)
        for column in table.T:
            places += self.log_prob[column]
        return places

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index of the best language, its posterior probability) per text."""
        best, posterior = [], []
        buckets = len(self.log_prob) - 1
        for part in balanced(texts, CHUNK_BYTES):
            if _is_long(texts[part]):
                sums = [self._places(t).sum(axis=0, dtype=np.float64) for t in windows(_only(texts[part]), buckets=buckets)]
                total = np.sum(sums, axis=0)[None, :] + self.prior
            else:
                table, counts = grams(texts[part], buckets=buckets)
                begins = np.cumsum(counts) - counts
                total = np.add.reduceat(self._places(table), begins, axis=0, dtype=np.float64) + self.prior
            total -= total.max(axis=1, keepdims=True)
            weight = np.exp(total)
            best.append(total.argmax(axis=1))
            posterior.append(1 / weight.sum(axis=1))
        return np.concatenate([[], *best]).astype(int), np.concatenate([[], *posterior])


def fit(
    labelled: DataFrame,
    rows_per_lang: int = 20_000,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learns from labelled rows (null language: not used).

    Priors come from the counts of all labelled rows; gram counts from at most
    about ``rows_per_lang`` rows of each language, those with the smallest
    hashes of their id and text, so one frequent language costs no more than
    another. Tasks return summed counts; the driver gets one count per language
    and bucket. Whole texts are read.
    """
    rows = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).alias("id"),
    )
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0), np.zeros((buckets + 1, 0), np.float32))
    share = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows_per_lang / n))]
    )
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(place < F.element_at(share, F.col("lang"))).select("lang", "text")
    number = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(langs), buckets + 1), np.int64)
        for batch in batches:
            owners = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            texts = strings(batch.column(1))
            for part in balanced(texts, CHUNK_BYTES):
                if _is_long(texts[part]):
                    for table in windows(_only(texts[part]), buckets=buckets):
                        sums[owners[part]] += np.bincount(table.ravel(), minlength=buckets + 1)
                    continue
                table, counts = grams(texts[part], buckets=buckets)
                key = np.repeat(owners[part], counts) * (buckets + 1)
                for column in table.T:
                    sums += np.bincount(key + column, minlength=sums.size).reshape(sums.shape)
        at = np.flatnonzero(sums[:, :buckets])
        lang, bucket = np.divmod(at, buckets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(bucket), pa.array(sums[lang, bucket])], names=["lang", "bucket", "n"]
        )

    counted = sample.mapInArrow(count, "lang long, bucket long, n long")
    table = np.zeros((len(langs), buckets))
    # At most one row per language and bucket.
    for row in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[row.lang, row.bucket] = row.n
    table += 0.5
    log_prob = np.zeros((buckets + 1, len(langs)), np.float32)
    log_prob[:buckets] = np.log(table / table.sum(axis=1, keepdims=True)).T
    total = sum(sizes.values())
    return Model(langs, np.log([sizes[x] / total for x in langs]), log_prob)


def predict_language(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` per row, over whole texts.

    ``und`` with score 0 where the text is null or has no letter, or where the
    model knows no language. The matrix (buckets by languages) is broadcast;
    there is no shuffle. Repeated rows are each predicted. A text of more than
    ``CHUNK_BYTES`` is scored in windows, whose sums add up to those of the whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = strings(batch.column(1))
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            if known.langs and len(texts):
                best, score = known.score(texts)
                names = np.array(known.langs, object)[best]
            else:
                letters = np.zeros(len(texts), bool)
                names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            names[~letters] = "und"
            columns = [
                batch.column(0),
                pa.array(names.tolist(), pa.string()),
                pa.array(np.where(letters, score, 0.0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), has_letter)
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")
