"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte 2-, 3- and 4-grams, hashed into slots: presence, not counts. The
kernel of two texts blends, per length, the shared slots over the root of the product of both set sizes.
Nyström landmarks turn it into features of bounded size, and one ridge regression per language against the rest
gives the scores. Scoring is two batched matrix products per block of documents; the model is a fixed
number of landmark rows, whatever the corpus.
"""

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfare.llm.common import crc_rest, filter_texts, stage, table
from wayfare.llm.textarrays import STEP, Texts, blocks, mix64

SLOTS = {2: 2048, 3: 8192, 4: 8192}  # n-gram length -> slots
BLEND = {2: 0.2, 3: 0.4, 4: 0.4}
PER_LANGUAGE = 300  # bound of the sample of labelled rows of one language: the lowest hashes of doc_id and text
MARGIN = 4  # by chance fewer than a quarter of the distinct rows expected below a place is out of the question
LANDMARKS = 128
RIDGE = 1e-3
SHARPNESS = 8.0
FOLDS, HELD_OUT = 4, 2  # crc32 of the id: documents of this remainder are never learned from. Fixed values.
UNKNOWN = "und"
BATCH = 64
LEAST_SCORE = 0.35  # below it no language stands out and a corpus does without the document

# letters as they are, A-Z as a-z; every other ASCII byte is one separator
LETTERS = np.arange(256, dtype=np.uint8)
LETTERS[65:91] += 32
LETTERS[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32


def presence(texts: Texts) -> dict[int, np.ndarray]:
    """Per n-gram length a 0/1 matrix, one row per text, one column per slot."""
    data = LETTERS[texts.raw].astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    found, code = {}, data
    for n in range(2, max(SLOTS) + 1):
        code = (code[:-1] << np.uint64(8)) | data[n - 1 :] if len(data) >= n else data[:0]
        if n in SLOTS:
            matrix = np.zeros((len(texts), SLOTS[n]), np.uint8)
            if len(code):
                rows = owner[: len(code)]
                whole = rows == owner[n - 1 :]
                slot = (mix64(code * STEP) >> np.uint64(40)).astype(np.int64) % SLOTS[n]
                matrix[rows[whole], slot[whole]] = 1
            found[n] = matrix
    return found


def has_letters(texts: Texts) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    ascii_ = np.concatenate([[0], np.cumsum((LETTERS[texts.raw] != 32) & (texts.raw < 128))])
    found = ascii_[texts.offsets[1:]] > ascii_[texts.offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(texts.offsets) > 0)):
        text = texts.raw[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(unicodedata.category(c)[0] == "L" for c in text)
    return found


def _kernel(left: dict[int, np.ndarray], right: dict[int, np.ndarray]) -> np.ndarray:
    """Blended kernel of every left row with every right row; ``right`` is scaled already (``_scaled``)."""
    total = 0.0
    for n, weights in right.items():
        x = left[n].astype(np.float32)
        total = total + (x @ weights.T) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return total


def _scaled(rows: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    scaled = {}
    for n, matrix in rows.items():
        x = matrix.astype(np.float32)
        scaled[n] = BLEND[n] * x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return scaled


class Model:
    """Landmarks, and per language the weight of each landmark's kernel."""

    def __init__(self, rows: dict[int, np.ndarray], languages: list[str]):
        self.languages = sorted(set(languages))
        each = max(1, LANDMARKS // max(len(self.languages), 1))
        places = {lang: [i for i, own in enumerate(languages) if own == lang][:each] for lang in self.languages}
        picked = sorted(i for found in places.values() for i in found)
        self.landmarks = _scaled({n: m[picked] for n, m in rows.items()})
        among = _kernel({n: m[picked] for n, m in rows.items()}, self.landmarks).astype(float)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        root = vectors / np.sqrt(np.maximum(values, 1e-6 * max(values.max(), 1e-12)))  # Nyström: K_mm to the minus one half
        features = _kernel(rows, self.landmarks) @ root
        target = np.array([[own == lang for lang in self.languages] for own in languages], float)
        own_share = np.sqrt(1 / target.sum(axis=0))[[self.languages.index(own) for own in languages]][:, None]
        x = np.hstack([features, np.ones((len(features), 1))]) * own_share
        gram = x.T @ x + RIDGE * np.eye(x.shape[1])
        solved = np.linalg.solve(gram, x.T @ (target * own_share))
        self.weights, self.bias = root @ solved[:-1], solved[-1]

    def predict(self, rows: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language of each row, and its share of the sharpened scores."""
        scores = _kernel(rows, self.landmarks) @ self.weights + self.bias
        sharp = np.exp(SHARPNESS * (scores - scores.max(axis=1, keepdims=True)))
        best = scores.argmax(axis=1)
        return best, (1.0 / sharp.sum(axis=1))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, keys = batch.column(0), batch.column(1)
        for row, texts in blocks(batch.column(2)):
            packed = np.packbits(np.hstack(list(presence(texts).values())), axis=1)
            columns = [langs.slice(row, len(texts)), keys.slice(row, len(texts)), pa.array([p.tobytes() for p in packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "key", "bits"])


def train(docs: DataFrame) -> Model | None:
    """Learn from at most PER_LANGUAGE labelled documents of each language outside the held-out fold.

    Rows are sampled, not ids: rows with a null or a repeated doc_id count by their texts. Equal rows count once.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (crc_rest(F.col("doc_id"), FOLDS) != HELD_OUT))
    usable = usable.select("lang", F.xxhash64("doc_id", "text").alias("key"), "text")  # the hash passes over a null
    place = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))  # even in 0 to 1
    placed = stage(usable.select("lang", "key").distinct().withColumn("place", place), "places")
    counts = placed.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    # the lowest PER_LANGUAGE places lie below MARGIN times their share: only those rows meet in a language's group
    low = placed.join(F.broadcast(counts), "lang").filter(F.col("place") < MARGIN * PER_LANGUAGE / F.col("rows"))
    order = W.partitionBy("lang").orderBy("place", "key")
    picked = low.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= PER_LANGUAGE).select("lang", "key")
    rows = usable.join(F.broadcast(picked), ["lang", "key"]).select("lang", "key", "text")
    found = rows.mapInArrow(_vectors, "lang string, key long, bits binary").dropDuplicates(["lang", "key"]).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.lang, r.key))
    bits = np.unpackbits(np.stack([np.frombuffer(r.bits, np.uint8) for r in found]), axis=1)
    edges = np.cumsum([0, *SLOTS.values()])
    rows = {n: bits[:, a:b] for n, a, b in zip(SLOTS, edges, edges[1:])}
    return Model(rows, [r.lang for r in found])


def _predict(model: Model | None, texts: Texts) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, in blocks of BATCH."""
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    for start in range(0, len(texts) if model else 0, BATCH):
        cut = texts.offsets[start : min(start + BATCH, len(texts)) + 1]
        part = Texts(texts.raw[cut[0] : cut[-1]], cut - cut[0])
        best, share = model.predict(presence(part))
        for i in np.flatnonzero(has_letters(part)):
            langs[start + i], scores[start + i] = model.languages[best[i]], share[i]
    return langs, scores


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, lang_pred and score of every document, from its whole text alone.

    Null, empty and letterless texts are ``und`` with score 0, as is everything where no labelled document is there to
    learn from. Rows without lang, or with a null doc_id, are predicted like others. Repeated rows are
    predicted each and alike. An empty table gives an empty result. Other columns are not read. Ties go to
    the language that sorts first.
    """
    model = train(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in blocks(batch.column(1)):
                langs, scores = _predict(model, texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, lang_pred string, score double")


def identified_documents(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is known: not ``und``, and with a score of at least ``least_score``. All columns stay."""
    model = train(docs)

    def known(texts: Texts) -> np.ndarray:
        langs, scores = _predict(model, texts)
        return np.array([lang != UNKNOWN for lang in langs], bool) & (scores >= least_score)

    return filter_texts(docs, known)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    found = identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", (crc_rest(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
