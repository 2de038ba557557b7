"""Language identification of words in mixed text by a linear-chain conditional random field.

Every word has features: itself (lexicon), its affixes and its character trigrams, hashed to
weights per language. Learned transitions say how languages follow each other. Forward-backward
gives each word a probability per language; a text's language is the one with the largest share.

The field is fitted on a bounded sample of labelled rows: ``PER_LANGUAGE`` rows of each language,
``SEGMENTS`` runs of ``RUN`` words of each. Runs of different languages are chained, so that
transitions are learned from switches too. Prediction reads whole texts of any length.

Defined results: NULL text and text without letters is ``und`` with score 0, and so is all text if
there are no labelled rows; words without letters are passed over. NULL languages are not learned.
A NULL id counts as the empty text in the fold. Rows with equal ids are predicted one by one; of
languages with equal shares the first by name is taken. An empty table gives an empty table.
"""
from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lagwise.llm.common import column, id_type, pick, slices
from lagwise.llm.tokens import ChunkCache, held
from lagwise.sources.layers import staged

PER_LANGUAGE, SEGMENTS, RUN = 250, 12, 20
FEATURES = 1 << 17
ROUNDS, RATE, DECAY = 40, 0.3, 2e-4
UNDETERMINED = "und"
#: Words whose scores a worker remembers in each of two generations.
REMEMBERED = 1 << 17
_STEP = 64  # words of a text that are passed in one block; blocks are passed side by side
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters."""
    found = _WORD.findall(text.lower())
    if any(w.isalpha() for w in found):
        return found
    return found if any(c.isalpha() for w in found for c in w) else []


def features(word: str) -> list[int]:
    """Lexicon entry, prefixes and suffixes of up to three letters, and trigrams, as hashes."""
    held = f"^{word}$"
    names = ["w" + word]
    for n in range(1, min(3, len(word)) + 1):
        names += [f"p{word[:n]}", f"s{word[-n:]}"]
    names += [held[i:i + 3] for i in range(len(held) - 2)]
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(posterior of each word and label, expected transitions if ``pairs``).

    ``emission`` (words, labels) and ``transition`` (labels, labels) are positive weights;
    ``lengths`` are the words of each text, none of them zero. Before the first word all labels
    are equally likely. Texts are cut into blocks of ``_STEP`` words. Per block, one product of
    matrices says how it turns what comes in into what goes out; passing these along each text
    gives what enters each block from both sides, and then all blocks are filled at once.
    """
    labels = emission.shape[1]
    blocks = -(-lengths // _STEP)
    first = np.cumsum(blocks) - blocks
    n_blocks = int(blocks.sum())
    of_text = np.repeat(np.arange(len(lengths)), blocks)
    number = np.arange(n_blocks) - first[of_text]
    at = np.repeat(first * _STEP - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(emission))
    grid = np.ones((n_blocks * _STEP, labels))
    grid[at] = emission
    real = np.zeros(n_blocks * _STEP, dtype=bool)
    real[at] = True
    grid = grid.reshape(n_blocks, _STEP, labels)
    real = real.reshape(n_blocks, _STEP)

    through = np.broadcast_to(np.eye(labels), (n_blocks, labels, labels)).copy()
    for t in range(_STEP):
        now = real[:, t]
        step = (through[now] @ transition) * grid[now, t][:, None, :]
        through[now] = step / step.sum(axis=(1, 2), keepdims=True)

    enter = np.full((n_blocks, labels), 1 / labels)
    leave = np.ones((n_blocks, labels))
    for k in range(1, int(blocks.max())):
        here = np.flatnonzero(number == k)
        enter[here] = _scaled(np.einsum("bi,bij->bj", enter[here - 1], through[here - 1]))
    for k in range(int(blocks.max()) - 2, -1, -1):
        here = np.flatnonzero((number == k) & (np.repeat(blocks, blocks) > k + 1))
        leave[here] = _scaled(np.einsum("bij,bj->bi", through[here + 1], leave[here + 1]))

    alpha = np.empty_like(grid)
    now = enter
    for t in range(_STEP):
        step = _scaled((now @ transition) * grid[:, t])
        now = np.where(real[:, t, None], step, now)
        alpha[:, t] = now
    expected = np.zeros((labels, labels)) if pairs else None
    posterior = np.empty_like(grid)
    beta = leave
    for t in range(_STEP - 1, -1, -1):
        posterior[:, t] = _scaled(alpha[:, t] * beta)
        behind = grid[:, t] * beta
        if pairs:
            before = alpha[:, t - 1] if t else enter
            both = before[:, :, None] * transition * behind[:, None, :]
            both /= both.sum(axis=(1, 2), keepdims=True)
            expected += both[real[:, t]].sum(axis=0)
        beta = np.where(real[:, t, None], _scaled(behind @ transition.T), beta)
    return posterior.reshape(-1, labels)[at], expected


class Field:
    """Weights (features, languages) and log transitions; languages in order of name."""

    def __init__(self, languages: list[str], weights: np.ndarray, transition: np.ndarray):
        self.languages, self.weights, self.transition = languages, weights, transition

    def _emission(self, word: str) -> bytes:
        score = self.weights[features(word)].sum(axis=0)
        return np.exp(np.maximum(score - score.max(), -30.0)).astype("<f4").tobytes()

    def cache(self) -> ChunkCache:
        return ChunkCache(self._emission, REMEMBERED)

    def posteriors(self, texts: list[list[str]], cache: ChunkCache) -> np.ndarray:
        """(words of all texts, languages); no text is empty."""
        raw = b"".join([cache[w] for words in texts for w in words])
        emission = np.frombuffer(raw, "<f4").reshape(-1, len(self.languages)).astype(np.float64)
        lengths = np.asarray([len(words) for words in texts])
        return forward_backward(emission, lengths, np.exp(self.transition))[0]


def fit(runs: list[tuple[str, list[str]]]) -> Field:
    """Maximum penalised likelihood by full-batch adaptive steps, on chains of labelled runs."""
    languages = sorted({lang for lang, _ in runs})
    labels = len(languages)
    place = {lang: i for i, lang in enumerate(languages)}
    order = sorted(range(len(runs)), key=lambda i: zlib.crc32(f"{i} {runs[i][1][0]}".encode()))
    # Four runs make a chain, most of them with switches.
    chains = [order[i:i + 4] for i in range(0, len(order), 4)]
    words, gold, lengths = [], [], []
    for chain in chains:
        for i in chain:
            words += runs[i][1]
            gold += [place[runs[i][0]]] * len(runs[i][1])
        lengths.append(sum(len(runs[i][1]) for i in chain))
    lengths, gold = np.asarray(lengths), np.asarray(gold)
    number: dict[str, int] = {}
    of_word = np.asarray([number.setdefault(w, len(number)) for w in words])
    lists = [features(w) for w in number]
    sizes = np.asarray([len(x) for x in lists])
    index = np.concatenate([np.asarray(x) for x in lists])
    starts = np.cumsum(sizes) - sizes
    weights = np.zeros((FEATURES, labels))
    transition = np.where(np.eye(labels, dtype=bool), 2.0, 0.0)
    seen_pairs = np.zeros((labels, labels))
    inner = np.ones(len(gold), dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False
    np.add.at(seen_pairs, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    n = len(gold)
    target = np.zeros((n, labels))
    target[np.arange(n), gold] = 1.0
    squares_w, squares_t = np.full_like(weights, 1e-8), np.full_like(transition, 1e-8)
    for _ in range(ROUNDS):
        score = np.add.reduceat(weights[index], starts, axis=0)
        score -= score.max(axis=1, keepdims=True)
        emission = np.exp(np.maximum(score, -30.0))[of_word]
        posterior, expected = forward_backward(emission, lengths, np.exp(transition), pairs=True)
        error = target - posterior
        per_word = np.stack([np.bincount(of_word, error[:, k], len(number)) for k in range(labels)], 1)
        spread = np.repeat(per_word, sizes, axis=0)
        gradient = np.stack([np.bincount(index, spread[:, k], FEATURES) for k in range(labels)], 1)
        gradient = gradient / n - DECAY * weights / labels
        squares_w += gradient ** 2
        weights += RATE * gradient / np.sqrt(squares_w)
        # The first word's transition starts from no label: it is in neither count.
        step = (seen_pairs / max(1.0, seen_pairs.sum()) - expected / expected.sum()) - DECAY * transition
        squares_t += step ** 2
        transition = transition + RATE * step / np.sqrt(squares_t)
    return Field(languages, weights.astype(np.float32), transition)


def labelled_runs(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """The bounded sample: at most PER_LANGUAGE * SEGMENTS runs of RUN words per language.

    Rows are drawn by a hash of their id. Only ids are compared; a threshold from the number of
    rows per language leaves about twice the rows wanted, so no task ranks a whole language.
    """
    ids = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "doc_id", F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("draw"))
    counts = staged(ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    near = ids.join(counts, "lang").filter(
        F.col("draw") / F.lit(float(1 << 63)) <= F.lit(2.0 * PER_LANGUAGE + 50) / F.col("n"))
    ranked = near.withColumn("k", F.row_number().over(
        Window.partitionBy("lang").orderBy("draw", "doc_id"))).filter(F.col("k") <= PER_LANGUAGE)
    drawn = F.broadcast(staged(ranked.select("lang", "doc_id").distinct(), "sample"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                step = max(RUN, len(words) // SEGMENTS)
                runs = [words[i:i + RUN] for i in range(0, len(words), step)][:SEGMENTS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(runs), pa.string()),
                     pa.array(runs, pa.list_(pa.string()))], names=["lang", "run"])

    rows = docs.join(drawn, ["lang", "doc_id"]).select("lang", "text").mapInArrow(
        cut, "lang string, run array<string>").collect()
    return sorted((r["lang"], list(r["run"])) for r in rows)


def train(docs: DataFrame) -> Field | None:
    runs = labelled_runs(docs)
    return fit(runs) if runs else None


def _by_document(posterior: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.add.reduceat(posterior, np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]


def predict(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text",
            with_words: bool = False) -> DataFrame:
    """doc_id, lang_pred, score; ``with_words`` adds the words and the label of each."""
    rows = pick(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    key = uuid.uuid4().int

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cache = None if model is None else held(("language", key), model.cache)
        for batch in slices(batches, 256):
            texts = [words_of(t) for t in batch.column(1).to_pylist()]
            names = [UNDETERMINED] * len(texts)
            scores = [0.0] * len(texts)
            labels: list[list[str]] = [[] for _ in texts]
            some = [i for i, words in enumerate(texts) if words and model is not None]
            if some:
                lengths = np.asarray([len(texts[i]) for i in some])
                posterior = model.posteriors([texts[i] for i in some], cache)
                shares = _by_document(posterior, lengths)
                for i, best, share in zip(some, shares.argmax(axis=1), shares.max(axis=1)):
                    names[i], scores[i] = model.languages[best], min(1.0, float(share))
                if with_words:
                    each = np.split(posterior.argmax(axis=1), np.cumsum(lengths)[:-1])
                    for i, found in zip(some, each):
                        labels[i] = [model.languages[k] for k in found]
            arrays = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if with_words:
                arrays += [pa.array(texts, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "lang_pred", "score"] + ["words", "labels"] * int(with_words))

    return rows.mapInArrow(
        work, f"doc_id {id_type(rows)}, lang_pred string, score double"
        + ", words array<string>, labels array<string>" * with_words)


def keep_identified(docs: DataFrame, field: Field | None, least: float = 0.5,
                    text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without texts that have no letters or whose words no language explains:
    of a word's best language the mean probability is below ``least``, so a text may mix languages.
    Without labelled rows, all texts with letters stay. Rows are filtered where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index(text_col)
    key = uuid.uuid4().int

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cache = None if model is None else held(("language", key), model.cache)
        for batch in slices(batches, 256):
            texts = [words_of(t or "") for t in batch.column(place).to_pylist()]
            good = np.asarray([bool(words) for words in texts], dtype=bool)
            some = np.flatnonzero(good)
            if len(some) and model is not None:
                lengths = np.asarray([len(texts[i]) for i in some])
                posterior = model.posteriors([texts[i] for i in some], cache)
                best = posterior.max(axis=1, keepdims=True)
                good[some] = _by_document(best, lengths)[:, 0] >= least
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(work, docs.schema)


def held_out(doc_id, folds: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def identify(docs: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned outside the first fold."""
    labelled = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"),
                           column(lang_col).alias("lang"))
    field = train(labelled.filter(~held_out(F.col("doc_id"), folds)))
    return predict(docs, field, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score")
