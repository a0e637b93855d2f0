"""Log-bilinear language model: trained by noise-contrastive estimation, scored with a whole softmax.

Words are counted over the corpus by a shuffle. The commonest words have a class of their own;
all others share classes by their last letters, and a class divides among its words by their
counts. The model predicts classes: the classes of the words before, each scaled by a vector per
place, add up to a prediction, whose product with a class's vector (plus its bias) is the class's
score. Training runs in rounds: tasks start from the same weights, take their share of the
training documents in small batches, and what they learnt is averaged by tokens.
A token's probability is that of its class, normalised over all classes, times its share of it.
As a score is a sum over the places before, its exponential is a product of one factor a place;
a trained model's factors are computed once per task, not once per token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from queixa.llm.chunks import Numbering, chunk_writer, offsets, packed, sums, unpacked
from queixa.session import write_and_read_back

# Text in a chunk: a word is asked for once per chunk, so larger chunks ask less often.
CHUNK_BYTES = 12 << 20
# Not a word, as it holds a blank: the token that ends each document.
END = b"\n"
OF_TEN = 10
# Tokens worked on at once, and scored in one product.
PIECE_TOKENS, SCORED = 1 << 18, 512
# Factors are used up to this size, and where no product of them (nor their sum) leaves single precision, whatever the classes.
FACTOR_BYTES, MOST_EXPONENT = 16 << 20, 80

CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
    ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("tokens", pa.binary())])
ENCODED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("inner_score", pa.float64()), ("classes", pa.binary())])


@dataclass(frozen=True)
class Settings:
    """`own` words have a class each, all others share `shared` classes."""
    own: int = 128
    shared: int = 288
    ending: int = 3  # letters that name a shared class
    width: int = 24
    before: int = 4  # words looked back on
    noise: int = 56  # noise classes per batch
    run: int = 32  # consecutive words learnt together
    batch: int = 16  # runs
    rounds: int = 4
    rate: float = 0.15
    seed: int = 7

    @property
    def classes(self) -> int:
        return self.own + self.shared


@dataclass
class Model:
    """Class vectors as context (with one more for 'before the text') and as target, a scale per place, a bias per class."""
    context: np.ndarray
    target: np.ndarray
    scale: np.ndarray
    bias: np.ndarray
    biased: np.ndarray | None = None
    factors: np.ndarray | None = None

    @staticmethod
    def start(shares: np.ndarray, s: Settings) -> Model:
        """Small random vectors; the bias is the class's share of all tokens, so training starts at the frequencies."""
        rng = np.random.default_rng(s.seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        scale = np.repeat((1 / (1 + np.arange(s.before)))[:, None], s.width, axis=1).astype(np.float32)
        return Model(small(s.classes + 1, s.width), small(s.classes, s.width), scale, np.log(shares).astype(np.float32))

    def weights(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.scale, self.bias)])

    def of(self, weights: np.ndarray) -> Model:
        parts, at = [], 0
        for x in (self.context, self.target, self.scale, self.bias):
            parts.append(weights[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Model(*parts)

    def predicted(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """Predictions for the last `n` places of runs of context vectors, each from the places before it."""
        first, scale = vectors.shape[-2] - n, self.scales(n)
        found = vectors[..., first - 1:first - 1 + n, :] * scale[0]
        part = np.empty_like(found)
        for i in range(1, first):
            found += np.multiply(vectors[..., first - 1 - i:first - 1 - i + n, :], scale[i], out=part)
        return found

    def scales(self, n: int) -> np.ndarray:
        """Each place's scale `n` times, so that a run is multiplied in one stretch."""
        return np.repeat(self.scale[:, None], n, axis=1)

    def log_probabilities(self, run: np.ndarray) -> np.ndarray:
        """Natural logarithms for a run's classes but the first ones, which are only looked back on; normalised over all classes."""
        n = len(run) - len(self.scale)
        classes, rows = np.minimum(run[len(self.scale):], len(self.bias) - 1), np.arange(n)
        factors = self._factors()
        if len(factors):
            return self._of_products(factors, run, classes, rows)
        found = self.predicted(self.context[run], n)
        scores = np.concatenate([found, np.ones((n, 1), dtype=np.float32)], axis=1) @ self._biased()
        own = scores[rows, classes].astype(np.float64)
        with np.errstate(over="ignore", divide="ignore"):
            whole = np.log(np.exp(scores, out=scores).sum(axis=1).astype(np.float64))
        if np.isfinite(whole).all():
            return own - whole
        # scores that leave the range of single precision
        scores = found.astype(np.float64) @ self.target.T + self.bias
        top = scores.max(axis=1)
        return scores[rows, classes] - top - np.log(np.exp(scores - top[:, None]).sum(axis=1))

    @staticmethod
    def _of_products(factors: np.ndarray, run: np.ndarray, classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        first, n = len(factors), len(classes)
        chances = factors[0].take(run[first - 1:first - 1 + n], axis=0)
        part = np.empty_like(chances)
        for i in range(1, first):
            factors[i].take(run[first - 1 - i:first - 1 - i + n], axis=0, out=part, mode="clip")  # other modes copy `out`
            chances *= part
        whole = chances @ np.ones(chances.shape[1], dtype=np.float32)
        return np.log(chances[rows, classes].astype(np.float64)) - np.log(whole.astype(np.float64))

    def _factors(self) -> np.ndarray:
        """Per place before and class there, by what each class's chance is multiplied; the first place has the biases too. Empty where they are not to be used."""
        if self.factors is None:
            self.factors = np.empty((0, 0, 0), dtype=np.float32)
            if len(self.scale) * len(self.context) * len(self.target) * 4 <= FACTOR_BYTES:
                found = (self.context * self.scale[:, None].astype(np.float64)) @ self.target.T
                found[0] += self.bias
                if np.abs(found).max(axis=(1, 2)).sum() <= MOST_EXPONENT:
                    self.factors = np.exp(found).astype(np.float32)
        return self.factors

    def _biased(self) -> np.ndarray:
        """Targets and, as one more row, the biases: one product gives whole scores."""
        if self.biased is None:
            self.biased = np.ascontiguousarray(np.concatenate([self.target, self.bias[:, None]], axis=1).T)
        return self.biased


def stream(classes: np.ndarray, sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Texts in a row, each behind as many places of 'before the text' as a word looks back; and where the tokens stand."""
    at = np.arange(len(classes)) + s.before * np.repeat(np.arange(1, len(sizes) + 1), sizes)
    run = np.full(len(classes) + s.before * len(sizes), s.classes, dtype=np.int32)
    run[at] = classes
    return run, at


def _gather(rows: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their gradients."""
    order = np.argsort(rows.astype(np.int16), kind="stable")
    ordered = rows.take(order)
    first = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    starts = np.flatnonzero(first)
    return ordered.take(starts), np.add.reduceat(gradient.take(order, axis=0), starts, axis=0)


class Trainer:
    """Steps of noise-contrastive estimation; a weight's steps shrink with the gradients it has had."""

    def __init__(self, model: Model, noise: np.ndarray, s: Settings, seed: int) -> None:
        self.m, self.s = model, s
        self.log_noise, self.cumulated = np.log(noise).astype(np.float32), np.cumsum(noise)
        self.rng = np.random.default_rng(seed)
        self.had = Model(*(np.full_like(x, 0.1) for x in (model.context, model.target, model.scale, model.bias)))

    def _move(self, name: str, rows, gradient: np.ndarray) -> None:
        had, weights = getattr(self.had, name), getattr(self.m, name)
        grown = gradient * gradient
        grown += had[rows]
        had[rows] = grown
        moved = self.s.rate * gradient
        moved /= np.sqrt(grown, out=grown)
        weights[rows] += moved

    def draw(self, batches: int) -> np.ndarray:
        """Noise classes of so many batches."""
        drawn = np.searchsorted(self.cumulated, self.rng.random((batches, self.s.noise)))
        return np.minimum(drawn, self.s.classes - 1)

    def learn(self, runs: np.ndarray) -> None:
        """All runs once, in batches and any order."""
        order, size = self.rng.permutation(len(runs)), self.s.batch
        starts = range(0, len(order), size)
        for at, drawn in zip(starts, self.draw(len(starts)), strict=True):
            self.step(runs[order[at:at + size]], drawn)

    def step(self, runs: np.ndarray, drawn: np.ndarray | None = None) -> None:
        """One batch of runs of classes; the first places of a run are only looked back on."""
        m, s = self.m, self.s
        if drawn is None:
            drawn = self.draw(1)[0]
        n = runs.shape[1] - s.before
        classes = runs[:, s.before:].ravel()
        real = classes < s.classes  # places before a text are no tokens
        classes = np.where(real, classes, 0)
        vectors, noise_vectors, own_vectors = (x.take(rows, axis=0) for x, rows in ((m.context, runs), (m.target, drawn), (m.target, classes)))
        predicted = m.predicted(vectors, n).reshape(-1, s.width)
        scale = np.log(np.float32(s.noise))
        own = np.einsum("ij,ij->i", predicted, own_vectors) + (m.bias - self.log_noise)[classes] - scale
        # the chance that a token is noise, and that a noise token is not
        with np.errstate(over="ignore"):
            up = real / (1 + np.exp(own))
            down = predicted @ -noise_vectors.T
            down -= m.bias[drawn] - self.log_noise[drawn] - scale
            np.exp(down, out=down)
            down += 1
            np.reciprocal(down, out=down)
        down[~real] = 0
        moved = up[:, None] * own_vectors
        moved -= down @ noise_vectors
        moved = moved.reshape(len(runs), n, s.width)
        target = np.empty((len(classes) + s.noise, s.width + 1), dtype=np.float32)
        target[:len(classes), :-1], target[:len(classes), -1] = up[:, None] * predicted, up
        target[len(classes):, :-1], target[len(classes):, -1] = -(down.T @ predicted), -down.sum(axis=0)
        at, gradient = _gather(np.concatenate([classes, drawn]), target)
        context, scales, scale, part = np.zeros_like(vectors), np.empty_like(m.scale), m.scales(n), np.empty_like(moved)
        for i in range(s.before):
            place = slice(s.before - 1 - i, s.before - 1 - i + n)
            context[:, place] += np.multiply(moved, scale[i], out=part)
            scales[i] = np.einsum("ijk,ijk->k", moved, vectors[:, place])
        context_at, context = _gather(runs.ravel(), context.reshape(-1, s.width))
        self._move("target", at, gradient[:, :-1])
        self._move("bias", at, gradient[:, -1])
        self._move("context", context_at, context)
        self._move("scale", slice(None), scales)


def _pack(table: pa.Table, held: str) -> dict:
    """One chunk's tokens by place in its own list of words, and each word's count in training documents."""
    numbers, sizes, tokens = Numbering(), [], []
    for text in table["text"].to_pylist():
        words = (text or "").encode().lower().split()
        words.append(END)
        sizes.append(len(words))
        tokens.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
    every = np.concatenate(tokens)
    held_out = table[held].combine_chunks()
    learnt = np.repeat(np.array([x is False for x in held_out.to_pylist()], dtype=bool), sizes)
    return {"doc_id": table["doc_id"].combine_chunks(), "held_out": held_out, "sizes": sizes, "words": list(numbers),
            "counts": np.bincount(every[learnt], minlength=len(numbers)), "tokens": packed(every)}


def _encode(chunks: pa.Table, answers: pa.Table, n_tokens: int, n_words: int, totals: np.ndarray, unseen: np.ndarray) -> Iterator[pa.Table]:
    """Documents of one chunk: their classes, and the scores that take no model."""
    for row in chunks.to_batches():
        order = np.argsort(answers["place"].to_numpy())
        count, of = (answers[n].to_numpy()[order] for n in ("count", "class"))
        sizes = row["sizes"][0].values.to_numpy()
        tokens, bounds = unpacked(row["tokens"][0].as_py(), np.int32, int(sizes.sum())), offsets(sizes)
        base = np.log10((count + 0.1) / (n_tokens + 0.1 * (n_words + 1)))
        inner = np.log10((count + 0.1) / (totals[of] + 0.1 * unseen[of]))
        classes = of[tokens].astype(np.int16)
        yield pa.Table.from_arrays([
            row["doc_id"][0].values, row["held_out"][0].values, pa.array(sizes.astype(np.int64)), pa.array(sums((count > 0).astype(np.int64)[tokens], bounds)),
            pa.array(np.add.reduceat(base[tokens], bounds[:-1])), pa.array(np.add.reduceat(inner[tokens], bounds[:-1])),
            pa.array([packed(classes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())], schema=ENCODED)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about PIECE_TOKENS tokens, or one longer row."""
    for batch in batches:
        ends = np.cumsum(batch["n_tokens"].to_numpy())
        at = 0
        while at < batch.num_rows:
            last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_TOKENS, side="right")))
            yield batch.slice(at, last - at)
            at = last


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    sizes = batch["n_tokens"].to_numpy()
    parts = [unpacked(x, np.int16, n) for x, n in zip(batch["classes"].to_pylist(), sizes.tolist(), strict=True)]
    return np.concatenate([np.empty(0, dtype=np.int16), *parts]).astype(np.int32), sizes


def _train(model: Model, noise: np.ndarray, s: Settings, part: int):
    """A function for mapInArrow: the weights after this task's documents, times its tokens."""
    schema = pa.schema([("slot", pa.int32()), ("task", pa.int32()), ("tokens", pa.int64()), ("weights", pa.binary())])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        trainer, seen = Trainer(model.of(model.weights()), noise, s, hash((s.seed, part, task)) % 2**32), 0
        for batch in _pieces(batches):
            classes, sizes = _sequences(batch)
            run, _ = stream(classes, sizes, s)
            run = np.concatenate([run, np.full(-(len(run) - s.before) % s.run, s.classes, dtype=np.int32)])
            runs = np.lib.stride_tricks.sliding_window_view(run, s.run + s.before)[::s.run]
            trainer.learn(runs)
            seen += len(classes)
        if seen:
            weights = trainer.m.weights().astype(np.float64) * seen
            yield pa.RecordBatch.from_arrays([pa.array([task % SLOTS], pa.int32()), pa.array([task], pa.int32()), pa.array([seen]),
                                              pa.array([weights.tobytes()], pa.binary())], schema=schema)
    return learn, from_arrow_schema(schema)


# Tasks' weights are added in so many groups before the driver adds those.
SLOTS = 32


def _add(rows: pa.Table) -> pa.Table:
    """One row for several tasks', added in their order, so that a rerun gives the same sums."""
    rows = rows.sort_by("task")
    total = sum(np.frombuffer(x, dtype=np.float64) for x in rows["weights"].to_pylist())
    return pa.table({"slot": rows["slot"][:1], "task": rows["task"][:1], "tokens": pa.array([sum(rows["tokens"].to_pylist())], pa.int64()),
                     "weights": pa.array([total.tobytes()], pa.binary())})


def train(encoded: DataFrame, shares: np.ndarray, s: Settings) -> Model:
    """Weights after `s.rounds` rounds, each over another share of the training documents."""
    model = Model.start(shares, s)
    part_of = F.pmod(F.xxhash64(F.lit(s.seed), "doc_id", "n_tokens"), F.lit(s.rounds))
    for part in range(s.rounds):
        learn, schema = _train(model, shares, s, part)
        rows = encoded.where(~F.col("held_out") & (part_of == part)).select("n_tokens", "classes").mapInArrow(learn, schema)
        added = sorted(rows.groupBy("slot").applyInArrow(_add, schema).collect(), key=lambda r: r.slot)
        tokens = sum(r.tokens for r in added)
        if tokens:
            model = model.of(sum(np.frombuffer(r.weights, dtype=np.float64) for r in added) / tokens)
    return model


def _score(model: Model, s: Settings, n_tokens: int):
    kept = ("doc_id", "held_out", "n_tokens", "n_known", "base_score")
    schema = pa.schema([*(ENCODED.field(n) for n in kept), ("train_tokens", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            classes, sizes = _sequences(batch)
            run, at = stream(classes, sizes, s)
            found = np.concatenate([np.zeros(s.before), *(
                model.log_probabilities(run[i:i + SCORED + s.before]) for i in range(0, len(run) - s.before, SCORED))])
            total = sums(found[at], offsets(sizes)) / np.log(10) + batch["inner_score"].to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in kept), pa.array(np.full(len(sizes), n_tokens)), pa.array(total)], schema=schema)
    return score, from_arrow_schema(schema)


def fitted(docs: DataFrame, settings: Settings = Settings(), chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, Model, Settings, int]:
    """The documents as classes, the trained model, the settings it has, and the training tokens."""
    spark = docs.sparkSession
    held = (F.crc32(F.col("doc_id").cast("string")) % OF_TEN == 0).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", "text", held)
    stored = write_and_read_back(rows.mapInArrow(
        chunk_writer(lambda t: _pack(t, "held_out"), CHUNKS, chunk_bytes), from_arrow_schema(CHUNKS)), "word-chunks")
    asked = stored.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x")).select(
        "chunk", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    counted = write_and_read_back(asked.groupBy("word").agg(F.sum("n").alias("count")), "word-counts")
    n_tokens, n_words = counted.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 0)).first()

    s = settings
    top = counted.where("count > 0").orderBy(F.desc("count"), "word").limit(s.own).collect()
    own = spark.createDataFrame([(bytes(r.word), i) for i, r in enumerate(top)], "word binary, own int")
    ending = F.right(F.col("word").cast("string"), F.lit(s.ending))
    known = counted.join(F.broadcast(own), "word", "left").select("word", "count", F.coalesce(
        "own", F.lit(s.own) + F.pmod(F.xxhash64(ending), F.lit(s.shared)).cast("int")).alias("class"))
    totals, unseen = np.zeros(s.classes), np.zeros(s.classes)
    unseen[s.own:] = 1  # a shared class keeps room for one word that training has not seen
    for r in known.groupBy("class").agg(F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("words")).collect():
        totals[r["class"]] = r.total
        unseen[r["class"]] += r.words
    answers = asked.join(known, "word").select(F.col("chunk").alias("asked_by"), "place", "count", "class")

    def encode(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.concat_tables(list(_encode(chunks, answers, n_tokens, n_words, totals, unseen)) or [ENCODED.empty_table()])
    encoded = write_and_read_back(stored.drop("words", "counts").groupBy("chunk").cogroup(answers.groupBy("asked_by")).applyInArrow(
        encode, from_arrow_schema(ENCODED)), "word-classes")
    shares = (totals + 0.1 * np.maximum(unseen, 1)) / (totals + 0.1 * np.maximum(unseen, 1)).sum()
    return encoded, train(encoded, shares, s), s, n_tokens


def score_texts(docs: DataFrame, settings: Settings = Settings(), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: tokens, known tokens, training tokens, the score by counts alone and the model's (both log10).

    `docs` needs doc_id and text; other columns are not read. Null and empty texts are the end token alone. Documents
    whose crc32(doc_id) is divisible by ten are held out; one without an id is neither (held_out is null) and is scored only.
    Repeated rows are learnt and scored as often as they are there. An empty table gives an empty result; a table without
    training documents is scored by equal chances. Words not seen in training share what their class keeps for them.

    The model's size is set by `settings`, whatever the corpus; counts, words and classes are shuffled and stored.
    """
    encoded, model, s, n_tokens = fitted(docs, settings, chunk_bytes)
    score, schema = _score(model, s, n_tokens)
    return encoded.mapInArrow(score, schema)
