"""Quality rules by distribution divergence.

A document's histograms of character classes and of its language's common words are compared to
references by the Jensen-Shannon measure (base 2, 0 to 1; the square of the distance of that name).
References are summed over all documents of a language. Common words are those with at least
``common_share`` of the language's words, so there are at most 1 / common_share of them. A language has
a reference from ``min_reference_words`` words on, whatever else the table holds; the ``max_references``
languages of most words are kept, a bound on what is broadcast.

The word measure cannot exceed what a text without any common word has, which depends on how much of the
language they make up. So its bound is a share of that ceiling (``max_word_share``), each language's own.

A document fails when a measure to its own language and to every other reference is over the bound;
a wrong language label alone does not reject it. Guards: words are judged from ``min_words`` letter
words on, characters from ``min_chars`` characters on. Before that, fixed rules reject texts of fewer
than 50 words or with over half of the words in repeated 3-word windows.

Nulls and empty texts have no words and fail the fixed rules. The divergence keeps documents of a language
without a reference; those without a language are judged by the closest reference, if there is any.
Very long texts are judged whole, in one task each. Repeated rows get equal results and count as often
as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import stored, unused, with_results

LETTERS = re.compile(r"[^\W\d_]+")
CLASSES = ("lower", "upper", "digit", "space", "point", "other_letter", "symbol")
POINTS, SPACES, SYMBOLS = b".,;:!?'\"()-", b" \t\n\r\x0b\x0c", b"#*$%&|<>"
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "js_chars double, js_words double, kept boolean"
)


@dataclass(frozen=True)
class Rules:
    min_total_words: int = 50
    max_repeat_percent: int = 50
    max_js_chars: float = 0.10
    max_word_share: float = 0.75
    min_chars: int = 200
    min_words: int = 50
    common_share: float = 0.005
    min_reference_words: int = 2_000
    max_references: int = 500


def class_counts(text: str, raw: bytes) -> list[int]:
    def of(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    ascii_only = len(raw.translate(None, HIGH))
    counts = [of(LOWER), of(UPPER), of(DIGITS), of(SPACES), of(POINTS), len(text) - ascii_only]
    return [*counts, len(text) - sum(counts)]


HIGH = bytes(range(128, 256))


def letter_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon divergence in bits of two count vectors; 0 when one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return float(sum(np.where(a > 0, a * np.log2(a / m), 0.0).sum() for a in (p, q)) / 2)


def reference_counts(docs: DataFrame, text_col: str, lang_col: str, chunk: int = 100_000) -> DataFrame:
    """Per language: documents, character classes and words, summed within each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        other: dict[tuple[str, str], int] = Counter()

        def columns(langs: list, kinds: list, items: list, n: list) -> pa.RecordBatch:
            made = [pa.array(c, t) for c, t in zip((langs, kinds, items, n), (pa.string(), pa.string(), pa.string(), pa.int64()))]
            return pa.RecordBatch.from_arrays(made, names=["lang", "kind", "item", "n"])

        def emit() -> Iterator[pa.RecordBatch]:
            for lang in list(words):
                found = words.pop(lang)
                yield columns([lang] * len(found), ["word"] * len(found), list(found), list(found.values()))
            yield columns([lang for lang, _ in other], [kind for _, kind in other], [""] * len(other), list(other.values()))
            other.clear()

        held = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py()  # one text at a time in Python
                other[lang, "docs"] += 1
                if text:
                    found, mine = letter_words(text), words[lang]
                    held -= len(mine)
                    mine.update(found)
                    held += len(mine)
                    other[lang, "words"] += len(found)
                    for name, n in zip(CLASSES, class_counts(text, text.encode())):
                        other[lang, name] += n
                if held > chunk:  # bounded memory, whatever the texts of a batch hold; Spark sums the chunks
                    yield from emit()
                    held = 0
        yield from emit()

    counted = docs.select(F.col(text_col), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang")).mapInArrow(run, "lang string, kind string, item string, n long")
    return counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Reference:
    chars: np.ndarray
    common: tuple[str, ...]
    words: np.ndarray  # the common words' counts, then all others

    @property
    def ceiling(self) -> float:
        """The word measure of a text without any common word."""
        return divergence(np.array([0.0] * len(self.common) + [1.0]), self.words)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> dict[str, Reference]:
    """At most ``max_references`` languages of at most 1 / common_share words each."""
    counts = stored(reference_counts(docs, text_col, lang_col), "quality-counts")
    totals = counts.where("kind <> 'word' and lang <> ''").groupBy("lang").pivot("kind", ["docs", "words", *CLASSES]).agg(F.sum("n")).na.fill(0)
    large = totals.where(F.col("words") >= rules.min_reference_words).orderBy(F.desc("words"), "lang").limit(rules.max_references)
    common = (
        counts.where("kind = 'word'").join(F.broadcast(large.select("lang", F.col("words").alias("total"))), "lang")
        .where(F.col("n") >= F.lit(rules.common_share) * F.col("total")).select("lang", "item", "n")
    )
    words: dict[str, dict[str, int]] = defaultdict(dict)
    for r in common.collect():
        words[r["lang"]][r["item"]] = r["n"]
    out = {}
    for r in large.collect():
        ranked = tuple(sorted(words[r["lang"]]))
        listed = [words[r["lang"]][w] for w in ranked]
        out[r["lang"]] = Reference(np.array([r[c] for c in CLASSES], float), ranked, np.array([*listed, r["words"] - sum(listed)], float))
    return out


def base_rules(text: str | None, rules: Rules) -> tuple[int, int, int, int, int, bool]:
    raw = text.encode() if text else b""
    words = raw.split()
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line and not line.isspace():
            seen.add(line)
    triples = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(triples)) < len(triples):
        often, last = Counter(triples), 0
        for p, t in enumerate(triples):
            if often[t] > 1:
                repeat += p + 3 - max(p, last)
                last = p + 3
    n = len(words)
    failed = n < rules.min_total_words or 100 * repeat > rules.max_repeat_percent * n
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACES))) if text else 0
    return n, chars, len(raw) - len(raw.translate(None, SYMBOLS)), dup, repeat, failed


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """Every document with its base figures, distances to the reference it is closest to, and verdict."""
    made = references(docs, text_col, lang_col, rules)
    known = docs.sparkSession.sparkContext.broadcast({lang: (ref, rules.max_word_share * ref.ceiling) for lang, ref in made.items()})

    def row(x: dict) -> tuple:
        text, base = x["t"], base_rules(x["t"], rules)
        own = known.value.get(x["l"] or "")
        if base[-1] or not known.value or (x["l"] and own is None):
            return (*base, None, None, not base[-1])
        chars, words = np.array(class_counts(text, text.encode()), float), letter_words(text)
        found = Counter(words)
        best = None
        for ref, bound in [own] * (own is not None) + [r for r in known.value.values() if r is not own]:
            listed = [found.get(w, 0) for w in ref.common]
            js = (divergence(chars, ref.chars) if len(text) >= rules.min_chars else 0.0,
                  divergence(np.array([*listed, len(words) - sum(listed)], float), ref.words) if len(words) >= rules.min_words else 0.0)
            excess = max(js[0] / rules.max_js_chars, js[1] / bound if bound else 0.0)
            if best is None or excess < best[0]:
                best = (excess, js)
            if best[0] <= 1:
                break
        return (*base, *best[1], best[0] <= 1)

    given = unused(docs, "__in")
    return with_results(docs.withColumn(given, F.struct(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))), given, row, FIELDS).drop(given)


def filtered(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """The columns of ``docs`` for the documents that the rules keep."""
    return judged(docs, text_col, lang_col, rules).where("kept").select(*docs.columns)
