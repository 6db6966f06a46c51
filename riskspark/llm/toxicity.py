"""Toxicity scores from class-conditional Kneser-Ney models.

Two word models, toxic and ordinary, learn from labelled documents outside the held-out fold (remainder
``HELD_OUT`` of crc32(id) mod 4). Of a class c, with discount D and kinds for the different words seen:
* a word w after a word v: (n_c(v, w) - D)+ / n_c(v) + D * kinds_c(v) / n_c(v) * P_c(w), P_c(w) where v is new;
* a word: (different words before w - D)+ / all pairs + D * kinds_c / all pairs * P(w);
* the corpus: document frequencies over all documents, shared by both classes.
Every word and pair of the learning documents is in the recursion, however rare, and a pair that is not there gets
the context's backoff mass, not the word's likelihood alone. Counts are documents, so a repeated line counts once.

A document's score compares the log-likelihoods of both models, divided by length: of the whole text, and
of its ``top`` most telling words, so an insult in a long text counts as in a short one. What single words
exceed ``MARGIN`` by is summed up, too. The same is taken once more of the words alone and of pairs that rest on
``SUPPORT`` different contexts or documents (copies of one text make rare pairs look certain), so the curve
learns how far rare expressions can be trusted. A logistic curve over these and the log length gives 0 to
1; it is fitted on labelled documents that the counts have not seen (remainder ``CALIBRATE``).

Bounds: at most about ``max_labelled`` labelled documents of ``max_words`` words together, the least by hash of the
id, for the classifier. The models are sorted arrays of 64-bit hashes, 12 bytes a pair and some 40 a word of
that sample, and broadcast once. Corpus frequencies are a table over every word of every document; those of the sample's
words are joined to it by Spark. Labels, language, source and id are never inputs of a score.

Null and empty texts have length 0 and get the score of no evidence. A null id belongs to no label and
remainder 0. Labels that differ on an id count as toxic if one is. Without labels of both classes every
score is 0. Repeated rows get equal scores. Very long texts are scored whole, in one task each. Empty
tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import map_batches, stored, with_results

WORDS = re.compile(r"\w+")
HELD_OUT, CALIBRATE = 2, 3
DISCOUNT = 0.75
MARGIN = 1.5
SUPPORT = 5
FEATURES = 7
BYTES_A_WORD = 4
SIGN = np.uint64(1 << 63)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def remainder(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4, F.lit(0))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int, max_words: int) -> DataFrame:
    """text, toxic, fold of a bounded sample of labelled documents that are not held out; no text is shuffled."""
    known = stored(
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col) != HELD_OUT))
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")), "toxicity-labels")
    place = F.xxhash64("__id") / 2.0**64 + 0.5
    first = known.where(place <= min(1.0, max_labelled / max(known.count(), 1)))  # about max_labelled rows: bounded
    texts = docs.select(F.col(f"`{id_col}`").alias("__doc"), F.col(f"`{text_col}`").alias("text"))
    found = texts.join(F.broadcast(first), F.col("__doc") == F.col("__id"))
    words = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # no fewer bytes than words
    most = found.where(place <= min(1.0, max_labelled / max(known.count(), 1)) * min(1.0, max_words * BYTES_A_WORD / max(words, 1)))
    return most.select("text", "toxic", remainder("__doc").alias("fold"))


def pair_counts(sample: DataFrame, chunk: int = 200_000) -> DataFrame:
    """before, word, n0, n1: documents of either class that hold a word after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())

        def emit() -> pa.RecordBatch:
            keys = list(found[0] | found[1])
            before, word = zip(*keys) if keys else ((), ())
            cols = [pa.array(before, pa.string()), pa.array(word, pa.string()), *[pa.array([f[k] for k in keys], pa.int32()) for f in found]]
            found[0].clear()
            found[1].clear()
            return pa.RecordBatch.from_arrays(cols, names=["before", "word", "n0", "n1"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                found[toxic].update(set(zip(["", *words], words)))
                if len(found[0]) + len(found[1]) > chunk:  # bounded memory; Spark sums the chunks
                    yield emit()
        yield emit()

    made = sample.select("text", "toxic").mapInArrow(run, "before string, word string, n0 int, n1 int")
    return made.groupBy("before", "word").agg(F.sum("n0").cast("int").alias("n0"), F.sum("n1").cast("int").alias("n1"))


def document_frequencies(docs: DataFrame, text_col: str, chunk: int = 200_000) -> DataFrame:
    """word, n: documents of the whole corpus that hold it, for every word of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def emit() -> pa.RecordBatch:
            cols = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(cols, names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                found.update(set(words_of(text.as_py())))
                if len(found) > chunk:  # bounded memory; Spark sums the chunks
                    yield emit()
        yield emit()

    return docs.select(F.col(f"`{text_col}`")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def codes_of(words: Collection[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))  # as Spark hashes text


def pair_codes(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (((before << np.uint64(1)) | (before >> np.uint64(63))) ^ words).view(np.int64)


@dataclass
class Models:
    """Both models by sorted hash: per pair the discounted parts, per word its likelihoods, per context its backoff masses."""

    pairs: np.ndarray      # codes
    counts: np.ndarray     # pair, class: documents
    following: np.ndarray  # word as context, class: documents of its pairs
    usual: np.ndarray      # word: after SUPPORT different words or more
    words: np.ndarray      # codes, the start of a text among them
    likely: np.ndarray     # word, class
    masses: np.ndarray     # word as context, class
    new: np.ndarray        # class: a word outside the sample, but for the corpus frequency that cancels
    top: int

    def __post_init__(self) -> None:
        self.words_ratio = np.log(self.likely[:, 1] / self.likely[:, 0])
        self.masses_ratio = np.log(self.masses[:, 1] / self.masses[:, 0])
        self.new_ratio = float(np.log(self.new[1] / self.new[0]))

    @cached_property
    def word_starts(self) -> np.ndarray:  # worked out in the tasks, not sent
        return starts_of(self.words)

    @cached_property
    def pair_starts(self) -> np.ndarray:
        return starts_of(self.pairs)

    def ratios(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratios, toxic over ordinary, of each word after the one before: of the full recursion, and of
        what is well supported (the word alone where its pair is rare, 0 where the word is). Words are looked up once
        a text; without a counted pair the recursion is the product of backoff mass and word, a sum of logarithms."""
        seen = dict(zip(dict.fromkeys(("", *words)), count()))
        place = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
        codes = codes_of(seen)
        at, known = find(self.words, self.word_starts, codes)
        word = np.where(known, self.words_ratio[at], self.new_ratio)
        mass = np.where(known, self.masses_ratio[at], 0.0)
        alone = np.where(known & self.usual[at], word, 0.0)
        before = np.concatenate([[0], place[:-1]])
        full, sure = mass[before] + word[place], alone[place]
        asked = np.flatnonzero(known[before] & known[place])
        pair, held = find(self.pairs, self.pair_starts, pair_codes(codes[before[asked]], codes[place[asked]]))
        asked, pair = asked[held], pair[held]
        if len(asked):
            counts, v, w = self.counts[pair], at[before[asked]], at[place[asked]]
            p = discounted(counts, np.maximum(self.following[v], 1)) + self.masses[v] * self.likely[w]
            full[asked] = np.log(p[:, 1] / p[:, 0])
            often = asked[(counts.sum(axis=1) >= SUPPORT) & self.usual[w]]
            sure[often] = full[often]
        return full, sure

    def features(self, text: str | None) -> tuple[float, ...]:
        words = words_of(text)
        if not words:
            return (0.0,) * FEATURES
        out = []
        for made in self.ratios(words):
            best = np.sort(made)[::-1][: self.top]
            out += [float(made.mean()), float(best.sum() / self.top), math.log1p(np.maximum(made - MARGIN, 0).sum())]
        return (*out, math.log1p(len(words)))


def in_order(codes: np.ndarray) -> np.ndarray:
    """Unsigned numbers of the same order."""
    return codes.view(np.uint64) ^ SIGN if codes.dtype == np.int64 else codes


def starts_of(known: np.ndarray) -> np.ndarray:
    """Where each range of leading bits starts in the sorted hashes; a range holds some 2 to 4."""
    bits = max(len(known).bit_length() - 2, 1)
    bounds = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.searchsorted(known, in_order(bounds.view(np.int64)).view(np.int64) if known.dtype == np.int64 else bounds).astype(np.int32)


def find(known: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each code, or of the next known one, and whether it is known: a few steps from the start of its range,
    where a search of the whole array would miss the processor's cache at most of its steps."""
    last = len(known) - 1
    at = np.minimum(starts[in_order(codes) >> np.uint64(65 - len(starts).bit_length())], last)
    rest = np.flatnonzero(known[at] < codes)
    while len(rest):
        rest = rest[at[rest] < last]
        at[rest] += 1
        rest = rest[known[at[rest]] < codes[rest]]
    return at, known[at] == codes


def by_class(pairs: DataFrame, key: str) -> DataFrame:
    """key, n0, n1 (documents of its pairs summed by class), k0, k1 (its different pairs)."""
    return pairs.groupBy(key).agg(*[F.sum(f"n{t}").alias(f"n{t}") for t in (0, 1)], *[F.count_if(F.col(f"n{t}") > 0).alias(f"k{t}") for t in (0, 1)])


def discounted(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.maximum(n - DISCOUNT, 0) / whole


def fitted(docs: DataFrame, sample: DataFrame, text_col: str, top: int) -> Models | None:
    """The two Kneser-Ney models; None without both classes."""
    pairs = stored(pair_counts(sample.where(F.col("fold") != CALIBRATE)), "toxicity-pairs")
    words = stored(by_class(pairs, "word"), "toxicity-words")
    whole = words.agg(*[F.sum(f"k{t}").alias(f"k{t}") for t in (0, 1)], *[F.count_if(F.col(f"k{t}") > 0).alias(f"v{t}") for t in (0, 1)]).first()
    if not whole["k0"] or not whole["k1"]:
        return None
    shared = stored(document_frequencies(docs, text_col), "toxicity-frequencies")
    every = shared.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ahead = by_class(pairs, "before").select("before", *[F.col(c).alias(f"a_{c}") for c in ("n0", "n1", "k0", "k1")])
    table = words.join(shared.withColumnRenamed("n", "df"), "word", "left").join(ahead, F.col("word") == F.col("before"), "full")
    counted = table.select(
        F.xxhash64(F.coalesce("word", "before")).alias("code"), F.coalesce("df", F.lit(0)).cast("long").alias("df"), *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("k0", "k1", "a_n0", "a_n1", "a_k0", "a_k1")])
    frame = counted.toArrow()  # 40 bytes a word of the sample
    codes = frame["code"].to_numpy().view(np.uint64)
    by_code = np.argsort(codes)
    codes = codes[by_code]
    both = lambda name: np.column_stack([frame[f"{name}{t}"].to_numpy()[by_code] for t in (0, 1)])
    total, vocabulary = (np.array([whole[f"{x}{t}"] for t in (0, 1)], float) for x in ("k", "v"))
    backoff = DISCOUNT * vocabulary / total
    base = (frame["df"].to_numpy()[by_code] + 1) / (every["n"] + every["v"] + 1)
    contexts, following = both("k"), both("a_n")
    likely = discounted(contexts, total) + backoff * base[:, None]
    masses = np.where(following > 0, DISCOUNT * both("a_k") / np.maximum(following, 1), 1.0).astype(np.float32)
    usual, following = contexts.sum(axis=1) >= SUPPORT, following.astype(np.float32)
    del frame, by_code, base, contexts

    v, w = F.xxhash64("before"), F.xxhash64("word")
    code = F.shiftleft(v, 1).bitwiseOR(F.shiftrightunsigned(v, 63)).bitwiseXOR(w)  # as pair_codes; counts are no more than max_labelled
    gathered = pairs.select(code.alias("code"), F.col("n0").cast("short"), F.col("n1").cast("short")).toArrow()  # 12 bytes a pair of the sample
    pair, n = gathered["code"].to_numpy(), [gathered[c].to_numpy() for c in ("n0", "n1")]
    del gathered
    order = np.argsort(pair)
    pair, n = pair[order], np.column_stack([c[order] for c in n])
    del order
    pa.default_memory_pool().release_unused()
    return Models(pair, n, following, usual, codes, likely, masses, backoff / backoff.sum(), top)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps on standardised columns: mean, scale, weights (the last is the intercept)."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * len(y) * w
        hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           max_labelled: int = 20_000, max_words: int = 20_000_000, top: int = 3, threshold: float = 0.3) -> DataFrame:
    """Every column of ``docs``, then held_out, score, predicted, whole_ratio and top_ratio."""
    context = docs.sparkSession.sparkContext
    sample = stored(labelled(docs, labels, id_col, text_col, label_col, max_labelled, max_words), "toxicity-sample")
    models = fitted(docs, sample, text_col, top)
    curve, shared, some = None, context.broadcast(models), models is not None
    del models  # the driver need not keep what the executors have
    if some:

        def features(texts: list, toxic: list) -> list:
            return [*map(list, zip(*map(shared.value.features, texts))), toxic] if texts else [[]] * (FEATURES + 1)

        fit = sample.where(F.col("fold") == CALIBRATE).select("text", "toxic")
        rows = np.array(map_batches(fit, features, ", ".join(f"f{i} double" for i in range(FEATURES)) + ", toxic double").collect(), float)  # bounded by max_labelled
        rows = rows.reshape(-1, FEATURES + 1)
        if len(set(rows[:, -1])) == 2:
            curve = logistic(rows[:, :-1], rows[:, -1])

    def row(text: str | None) -> tuple:
        if curve is None:
            return 0.0, 0, 0.0, 0.0
        x = np.array(shared.value.features(text))
        mean, scale, w = curve
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(((x - mean) / scale) @ w[:-1] + w[-1])))))
        return score, int(score >= threshold), float(x[0]), float(x[1])

    out = docs.withColumn("held_out", remainder(id_col) == HELD_OUT)
    return with_results(out, text_col, row, "score double, predicted int, whole_ratio double, top_ratio double")
