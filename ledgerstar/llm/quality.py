"""Quality rules: counts over words and lines, and bands of n-gram perplexity per language.

A character n-gram model with modified Kneser-Ney smoothing is counted on Spark over all distinct texts,
per language, inside words with a mark before and after. Its tables are two sorted hash arrays: the
discounted share of each n-gram, and the weight that each context leaves to the next lower order.
Texts whose perplexity lies outside their language's band are rejected. The band reaches from the median
of the logarithm some median absolute deviations down and others up, wider for short texts. Both widths
are quantiles over all distinct texts labelled good that pass the base rules, so that each side costs at
most ``LOSS`` of them: per language, or over all languages together, in deviations, for a language with
fewer than ``LEAST_LABELS`` of them. Without that many in all, both widths are ``SPREAD``. A text counts
as good when every label of its rows is 1.

Model and band are taken over distinct texts: texts of a language with the same words in the same order
count once, however many rows repeat them, and every row is judged by that. Copies are merged inside each
task before the shuffle.

The arrays are broadcast, with a bound that does not depend on the input: an order keeps its ``MOST`` most
counted n-grams. No n-gram is lost by that. The probability of a character depends only on the longest n-gram that
ends at it, and Spark works it out for all those that the arrays cannot tell. A text's task adds up the characters
that it can tell, and names the n-grams at the others; these meet their probabilities in a join.

Defined results: a null text has no words; null is a language of its own; a text without words has
null perplexity and fails the base rules; repeated rows are judged alike; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructType

from ledgerstar.llm import words as W
from ledgerstar.llm.tables import Tables

ORDER = 4
MOST = 1_000_000  # n-grams of an order that are broadcast; the others are joined
LOSS = 0.005  # share of the good texts that either side of the band may reject
LEAST_LABELS = 200  # good texts for a width of a language's own; fewer have no such quantile
SPREAD = 20.0  # band half width in median absolute deviations where too few texts are labelled
LEAST_WIDTH = 1.0  # deviations; half of all texts lie within one
SHORT = 200  # words; the band is wider by sqrt(1 + SHORT / n_words), as short texts vary more
LEAST_DEVIATION = 0.001  # of log10 perplexity; holds where almost all texts agree
DISTINCT = 100_000  # words that a counting task holds before it emits their n-grams

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

START, END, ODD = 2, 3, 0xFFFD  # marks, and what stands for control characters
UNSEEN = 1 / 65536  # share of a character never seen, of the weight that order 0 gets

LEAST_PROB = 1e-12

TEXTS = "lang string, digest binary, text binary"
GRAMS = "lang string, gram string, n long"
METRICS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "log_prob": "double",
    "n_scored": "long",
    "digest": "binary",
    "open": MapType(StringType(), LongType()),  # n-grams that the broadcast cannot tell, and how often
}


# Distinct texts ----------------------------------------------------------------------


def _digest(found: list[bytes]) -> bytes:
    """128 bits of the words in their order."""
    return xxhash.xxh3_128_digest(b" ".join(found))


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with words, each once while there is room to remember it."""
    seen: set[tuple[str | None, bytes]] = set()
    for part in W.groups(batches):
        rows = []
        for lang, text in zip(part.column("lang").to_pylist(), W.texts(part.column("text"))):
            if (found := text.split()) and (key := (lang, _digest(found))) not in seen:
                seen.add(key)
                rows.append((*key, text))
        if len(seen) > W.CACHE:
            seen.clear()
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.string(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["lang", "digest", "text"]
        )


def distinct_texts(documents: DataFrame) -> DataFrame:
    """Rows of ``lang, digest, text`` where equal texts are neighbours in one task.

    A text with a third of all rows is a few rows per task before the shuffle.
    """
    texts = documents.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    merged = texts.mapInArrow(_merge, TEXTS)
    return merged.repartition("lang", "digest").sortWithinPartitions("lang", "digest")


# Counting --------------------------------------------------------------------------


def _marked(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with their marks, and each one's position in its word."""
    decoded = [x.decode("utf-8", "replace") for x in found]
    joined = "\x03\x02".join(decoded)
    codes = np.frombuffer(f"\x02{joined}\x03".encode("utf-32-le"), np.uint32).copy()
    lengths = np.fromiter(map(len, decoded), np.int64, len(found)) + 2
    starts = np.cumsum(lengths) - lengths
    inner = np.ones(len(codes), bool)
    inner[starts] = inner[starts + lengths - 1] = False
    codes[inner & (codes < 32)] = ODD
    return codes, np.arange(len(codes)) - np.repeat(starts, lengths)


def _grams(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Longest n-gram that ends at each character, as strings, with counts."""
    found = list(counts)
    codes, place = _marked(found)
    weight = np.repeat(
        np.fromiter(counts.values(), np.int64, len(found)),
        np.diff(np.append(np.flatnonzero(place == 0), len(place))),
    )
    matrix = np.zeros((len(codes), ORDER), np.uint32)  # left aligned, zeros behind
    for size in range(2, ORDER + 1):
        ends = np.flatnonzero(place >= ORDER - 1 if size == ORDER else place == size - 1)
        for i in range(size):
            matrix[ends, i] = codes[ends - size + 1 + i]
    keep = place > 0
    matrix, weight = np.ascontiguousarray(matrix[keep]), weight[keep]
    grams, which = np.unique(matrix.view(f"<U{ORDER}").ravel(), return_inverse=True)
    return grams, np.bincount(which, weight, len(grams)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str | None, Counter] = {}
    last = None

    def emit():
        for lang, counts in held.items():
            grams, n = _grams(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.tolist(), pa.string()), pa.array(n)],
                names=["lang", "gram", "n"],
            )
        held.clear()

    for part in W.groups(batches):
        columns = (part.column("lang").to_pylist(), part.column("digest").to_pylist(), W.texts(part.column("text")))
        for lang, digest, text in zip(*columns):
            if (lang, digest) != last:
                held.setdefault(lang, Counter()).update(text.split())
                last = lang, digest
        if sum(map(len, held.values())) > DISTINCT:
            yield from emit()
    yield from emit()


def count_grams(documents: DataFrame) -> DataFrame:
    """Counts of the longest n-gram at each character of the distinct texts, per language."""
    counted = distinct_texts(documents).mapInArrow(_count, GRAMS)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# Smoothing -------------------------------------------------------------------------


def _smoothed(grams: DataFrame, size: int) -> DataFrame:
    """``(lang, gram, prefix, n, share, weight)`` of one order, from rows of ``(lang, gram, n)``.

    ``weight`` is what the context ``prefix`` leaves to the next lower order.
    """
    of_counts = grams.groupBy("lang").agg(
        *[F.sum(F.expr(f"int(n = {i})")).alias(f"n{i}") for i in range(1, 5)]
    )
    # discounts of modified Kneser-Ney; 0.5, 1, 1.5 where counts of counts do not define them
    ratio = "n1 / nullif(n1 + 2 * n2, 0)"
    falls = {i: f"{i} - {i + 1} * {ratio} * n{i + 1} / nullif(n{i}, 0)" for i in (1, 2, 3)}
    bounded = ", ".join(
        f"CASE WHEN {fall} > 0 AND {fall} < {i} THEN {fall} ELSE {i} / 2D END AS d{i}"
        for i, fall in falls.items()
    )
    discounts = of_counts.selectExpr("lang AS of_lang", f"struct({bounded}) AS fall")
    rows = grams.join(discounts, F.col("lang").eqNullSafe(F.col("of_lang"))).selectExpr(
        "lang",
        "gram",
        f"substring(gram, 1, {size - 1}) AS prefix",
        "n",
        "CASE n WHEN 1 THEN fall.d1 WHEN 2 THEN fall.d2 ELSE fall.d3 END AS fall",
    )
    in_context = rows.groupBy(F.col("lang").alias("of_lang"), F.col("prefix").alias("context")).agg(
        F.sum("n").alias("seen"), F.sum("fall").alias("lost")
    )
    return rows.join(
        in_context, F.col("lang").eqNullSafe(F.col("of_lang")) & F.expr("prefix = context")
    ).selectExpr("lang", "gram", "prefix", "n", "(n - fall) / seen AS share", "lost / seen AS weight")


def _least(rows: DataFrame) -> int:
    """The count from which n-grams are broadcast; 0 if all of them are."""
    table = rows.groupBy("n").agg(F.count("*").alias("times")).toArrow()  # few: counts differ and add up to the text
    n, times = (table.column(x).to_numpy() for x in ("n", "times"))
    if times.sum() <= MOST:
        return 0
    order = np.argsort(-n)
    whole = np.flatnonzero(np.cumsum(times[order]) <= MOST)
    return int(n[order[whole[-1]]] if len(whole) else n.max() + 1)


def train(documents: DataFrame, tables: Tables) -> Model:
    """Count all distinct texts and smooth every order; the part of the model that is broadcast."""
    return _trained(documents, tables)[0]


def _trained(documents: DataFrame, tables: Tables) -> tuple[Model, DataFrame | None]:
    """The broadcast part, and ``lang, gram, log`` of the characters it cannot tell, if there are any."""
    leaves = tables.save(count_grams(documents), "grams")
    grams = leaves.filter(f"char_length(gram) = {ORDER}")
    orders, least, shares, weights = {}, {}, [], []
    for size in range(ORDER, 0, -1):
        if size < ORDER:
            # adjusted counts: how many characters precede it; those at a word's start keep theirs
            before = grams.groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(
                F.count("*").alias("n")
            )
            grams = before.unionByName(leaves.filter(f"char_length(gram) = {size}"))
        grams = tables.save(grams, f"order{size}")
        orders[size] = rows = tables.save(_smoothed(grams, size), f"smoothed{size}")
        least[size] = _least(rows)
        kept = rows.filter(F.col("n") >= least[size])
        left = kept.groupBy("lang", F.col("prefix").alias("gram")).agg(F.max("weight").alias("share"))
        # each at most ``MOST`` rows
        shares.append(_arrays(kept.select("lang", "gram", "share").toArrow(), size))
        weights.append(_arrays(left.toArrow(), size - 1))
    whole = not any(least.values())
    model = Model(*_sorted(shares), *_sorted(weights), whole)
    return model, None if whole else _rest(orders, least, tables)


def _rest(orders: dict[int, DataFrame], least: dict[int, int], tables: Tables) -> DataFrame:
    """``lang, gram, log`` of each longest n-gram where the broadcast lacks it or one that ends it."""
    found, parts = None, []
    for size in range(1, ORDER + 1):
        rows, told = orders[size], F.col("n") >= least[size]
        if found is None:
            below = F.lit(UNSEEN)
        else:
            shorter = found.selectExpr("lang AS of_lang", "gram AS ending", "prob AS below", "told AS told_below")
            rows = rows.join(
                shorter, F.col("lang").eqNullSafe(F.col("of_lang")) & F.expr("substring(gram, 2) = ending")
            )
            below, told = F.col("below"), told & F.col("told_below")
        prob = F.col("share") + F.col("weight") * below
        found = tables.save(rows.select("lang", "gram", prob.alias("prob"), told.alias("told")), f"rated{size}")
        if size > 1:  # shorter ones are the longest only at a word's start
            longest = found if size == ORDER else found.filter(F.col("gram").startswith(chr(START)))
            parts.append(longest.filter("NOT told"))
    return reduce(DataFrame.unionByName, parts).selectExpr(
        "lang", "gram", f"log10(greatest(prob, {LEAST_PROB}D)) AS log"
    )


def _sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    return keys[order], values[order]


def _lang_key(lang: str | None) -> int:
    return xxhash.xxh3_64_intdigest((lang or "").encode() + (b"\0" if lang is None else b""))


def _arrays(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of language and n-gram, as :meth:`Model.word_scores` takes it from code points; values."""
    langs = table.column("lang").to_pylist()
    known = {lang: _lang_key(lang) for lang in set(langs)}
    keys = np.fromiter((known[x] for x in langs), np.uint64, len(langs))
    if size and len(keys):
        grams = np.array(table.column("gram").to_pylist(), f"<U{size}")
        codes = grams.view(np.uint32).reshape(-1, size)
        for i in range(size):
            keys = W.chained(keys, codes[:, i].astype(np.uint64))
    return keys, table.column("share").to_numpy()


@dataclass(frozen=True)
class Model:
    """Sorted hash arrays of shares and of weights; ``whole`` if they hold every n-gram that was counted."""

    gram_keys: np.ndarray
    shares: np.ndarray
    context_keys: np.ndarray
    weights: np.ndarray
    whole: bool = True

    def word_scores(self, lang: str | None, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each word with its end, and its number of characters, by these arrays alone."""
        codes, place = _marked(found)
        at, which = _distinct_ends(codes, place)
        logs, _ = self._ends(lang, codes, place, at)
        return _by_word(place, logs[which])

    def told(self, lang: str | None, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[int, Counter]]:
        """As :meth:`word_scores` over the characters that the arrays tell, and the n-grams at the others by word."""
        codes, place = _marked(found)
        at, which = _distinct_ends(codes, place)
        logs, here = self._ends(lang, codes, place, at)
        if self.whole or here.all():
            return *_by_word(place, logs[which]), {}
        logs[~here] = 0
        grams = {
            i: codes[end - min(place[end], ORDER - 1) : end + 1].tobytes().decode("utf-32-le")
            for i, end in enumerate(at.tolist()) if not here[i]
        }
        missed = np.flatnonzero(~here[which])
        opened: dict[int, Counter] = {}
        for word, i in zip((np.cumsum(place == 0) - 1)[missed].tolist(), which[missed].tolist()):
            opened.setdefault(word, Counter())[grams[i]] += 1
        return *_by_word(place, logs[which]), opened

    def _ends(self, lang, codes, place, at) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of the characters at these positions, and whether the arrays hold all n-grams there."""
        prob = np.full(len(at), UNSEEN)
        here = np.ones(len(at), bool)
        for size in range(1, ORDER + 1):
            # the context of a character is the next shorter n-gram that ends before it
            rows = np.flatnonzero(place[at] >= max(1, size - 1))
            keys = np.full(len(rows), _lang_key(lang), np.uint64)
            for i in range(size - 1, 0, -1):
                keys = W.chained(keys, codes[at[rows] - i].astype(np.uint64))
            weight, _ = _find(self.context_keys, self.weights, keys, 1.0)
            keys = W.chained(keys, codes[at[rows]].astype(np.uint64))
            share, known = _find(self.gram_keys, self.shares, keys, 0.0)
            prob[rows] = share + weight * prob[rows]
            here[rows] &= known
        prob[place[at] == 0] = 1  # the mark before a word is context only
        return np.log10(np.maximum(prob, LEAST_PROB)), here


def _distinct_ends(codes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position for each distinct longest n-gram, and for every position the place of its own among them.

    The model is asked once for each: new words share most of their n-grams.
    """
    keys = np.zeros(len(codes), np.uint64)
    for i in range(ORDER - 1, -1, -1):
        ends = np.flatnonzero(place >= i)
        keys[ends] = W.chained(keys[ends], codes[ends - i].astype(np.uint64))
    order = np.argsort(keys)
    fresh = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return order[fresh], which


def _by_word(place: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(place == 0)
    return np.add.reduceat(logs, starts), np.diff(np.append(starts, len(place))) - 1


def _find(
    keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float
) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys, and which of them there are."""
    if not len(keys):
        return np.full(len(wanted), default), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return np.where(found, values[at], default), found


# Judging ---------------------------------------------------------------------------


def _ranges(flags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over consecutive stretches of the given sizes."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def repeated(hashes: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, words in windows found twice or more in it."""
    cover = np.zeros(len(hashes), bool)
    if len(hashes) >= window:
        keys = hashes[: len(hashes) - window + 1]
        for i in range(1, window):
            keys = W.chained(keys, hashes[i : len(hashes) - window + 1 + i])
        text = np.repeat(np.arange(len(counts)), counts)
        inside = np.flatnonzero(text[: len(keys)] == text[window - 1 :])
        keys = W.chained(keys[inside], text[inside].astype(np.uint64))
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        for at in inside[times[which] > 1][:, None] + np.arange(window):
            cover[at] = True
    return _ranges(cover, counts)


class _Words(dict):
    """A number for each word of one language, and what the model says of it."""

    def __init__(self, model: Model, lang: str | None):
        self.model, self.lang = model, lang
        self.new: list[bytes] = []
        self.logs, self.chars = np.empty(0), np.empty(0, np.int64)
        self.opened: dict[int, Counter] = {}  # n-grams that the model does not tell, by word

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def numbers(self, found: list[bytes]) -> np.ndarray:
        numbers = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        if self.new:
            logs, chars, opened = self.model.told(self.lang, self.new)
            self.opened.update((len(self.logs) + i, grams) for i, grams in opened.items())
            self.logs = np.concatenate([self.logs, logs])
            self.chars = np.concatenate([self.chars, chars])
            self.new = []
        return numbers

    def open_grams(self, numbers: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, Counter]]:
        """For each text with such n-grams, its place among the texts and how often it has each of them."""
        if not self.opened:
            return
        marked = np.zeros(len(self), bool)
        marked[list(self.opened)] = True
        at = np.flatnonzero(marked[numbers])
        text = np.searchsorted(np.cumsum(counts), at, "right")
        cuts = np.flatnonzero(np.diff(text, prepend=-1))
        for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
            grams = Counter()
            for number, times in Counter(numbers[at[start:end]].tolist()).items():
                for gram, n in self.opened[number].items():
                    grams[gram] += n * times
            yield int(text[start]), grams


def _measure(batches, model: Model, columns: list[str]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    known: dict[str | None, _Words] = {}
    for part in W.groups(batches, "_text"):
        documents = W.texts(part.column("_text"))
        langs = part.column("_lang").to_pylist()
        data = np.frombuffer(b"".join(documents), np.uint8)
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        lines = [[x for x in text.split(b"\n") if x.strip()] for text in documents]

        counts, repeats, scored = np.zeros((3, len(documents)), np.int64)
        log_prob = np.zeros(len(documents))
        digests = [b""] * len(documents)
        opened: list[dict | None] = [None] * len(documents)
        if sum(map(len, known.values())) > W.CACHE:
            known.clear()
        for lang in set(langs):
            rows = [i for i, x in enumerate(langs) if x == lang]
            found, n = W.split_all([documents[i] for i in rows])
            words = known.setdefault(lang, _Words(model, lang))
            numbers = words.numbers(found)
            counts[rows] = n
            repeats[rows] = repeated(numbers.astype(np.uint64), n)
            scored[rows] = _ranges(words.chars[numbers], n)
            sums = np.concatenate([[0], np.cumsum(words.logs[numbers])])
            ends = np.cumsum(n)
            log_prob[rows] = sums[ends] - sums[ends - n]
            for i, end, size in zip(rows, ends.tolist(), n.tolist()):
                digests[i] = _digest(found[end - size : end])
            for i, grams in words.open_grams(numbers, n):
                opened[rows[i]] = grams
        metrics = [
            counts,
            _ranges((data & 0xC0) != 0x80, sizes) - _ranges(white[data], sizes),
            _ranges(table[data], sizes),
            np.array([len(x) - len(set(x)) for x in lines], np.int64),
            repeats,
            log_prob,
            scored,
            digests,
        ]
        grams = pa.array([x and list(x.items()) for x in opened], pa.map_(pa.string(), pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [part.column(name) for name in columns] + [pa.array(x) for x in metrics] + [grams],
            names=[*columns, *METRICS],
        )


def measured(documents: DataFrame, tables: Tables, *columns) -> DataFrame:
    """Counts and log probability of each whole text by a model of all of them, beside the given columns."""
    model, rest = _trained(documents, tables)
    frame = documents.select(
        *columns, F.col("lang").cast("string").alias("_lang"), F.col("text").cast("string").alias("_text")
    )
    passed = [name for name in frame.columns if name != "_text"]
    schema = StructType([frame.schema[name] for name in passed])
    for name, kind in METRICS.items():
        schema = schema.add(name, kind)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded, see the module
    run = frame.mapInArrow(lambda batches: _measure(batches, shared.value, passed), schema)
    measures = tables.save(run, "measures")
    if rest is not None:
        measures = tables.save(_completed(measures, rest), "completed")
    return measures.drop("open").withColumns({
        "log_perplexity": F.expr("-log_prob / nullif(n_scored, 0)"),
        "base_failed": F.expr(
            f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
        ),
    })


def _completed(measures: DataFrame, rest: DataFrame) -> DataFrame:
    """The measures with the characters that tasks could not tell, joined once per distinct text."""
    opened = measures.filter("open IS NOT NULL")
    added = (
        opened.groupBy(F.col("_lang").alias("text_lang"), F.col("digest").alias("text_digest"))
        .agg(F.first("open").alias("open"))  # alike in all copies
        .select("text_lang", "text_digest", F.explode("open").alias("of_gram", "times"))
        .join(rest, F.col("text_lang").eqNullSafe(F.col("lang")) & F.expr("of_gram = gram"))
        .groupBy("text_lang", "text_digest")
        .agg(F.sum(F.col("times") * F.col("log")).alias("added"))
    )
    same = F.col("_lang").eqNullSafe(F.col("text_lang")) & F.expr("digest = text_digest")
    completed = opened.join(added, same).withColumn("log_prob", F.expr("log_prob + added"))
    return measures.filter("open IS NULL").unionByName(completed.select(measures.columns))


WIDER = f"sqrt(1 + {SHORT} / greatest(n_words, 1))"


def _widths(suffix: str) -> list:
    """Number of good texts, and deviations down and up that leave ``LOSS`` of them outside."""
    ends = F.percentile_approx("z", [LOSS, 1 - LOSS], 100_000)
    exceeded = 1 + 1e-9  # a text measured again stays on its side of a limit that it sets
    return [
        F.count("*").alias(f"n{suffix}"),
        F.greatest(F.lit(LEAST_WIDTH), -ends[0] * exceeded).alias(f"below{suffix}"),
        F.greatest(F.lit(LEAST_WIDTH), ends[1] * exceeded).alias(f"above{suffix}"),
    ]


def bands(measures: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Middle of each language's log10 perplexity and its widths, from the distinct texts that pass the base rules.

    ``labels`` has ``doc_id, quality``.
    """
    passing = measures.filter("NOT base_failed")
    texts = passing.groupBy("_lang", "digest").agg(F.min("log_perplexity").alias("log_perplexity"))
    middle = texts.groupBy(F.col("_lang").alias("lang")).agg(
        F.percentile_approx("log_perplexity", 0.5).alias("middle")
    )
    spread = (
        texts.join(middle, F.col("_lang").eqNullSafe(F.col("lang")))
        .groupBy("lang", "middle")
        .agg(F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("middle")), 0.5).alias("mad"))
        .selectExpr("lang AS of_lang", "middle", f"greatest({LEAST_DEVIATION}, mad) AS deviation")
    )
    if labels is None:
        return spread.selectExpr("of_lang", "middle", f"{SPREAD} * deviation AS below", f"{SPREAD} * deviation AS above")
    known = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.min("quality").alias("quality")
    )
    good = (
        passing.join(known, F.col("doc_id").cast("long") == F.col("labelled"))
        .groupBy("_lang", "digest")
        .agg(*[F.min(x).alias(x) for x in ("log_perplexity", "n_words", "quality")])
        .filter("quality = 1")
        .join(spread, F.col("_lang").eqNullSafe(F.col("of_lang")))
        .withColumn("z", F.expr(f"(log_perplexity - middle) / (deviation * {WIDER})"))
    )
    own = good.groupBy(F.col("_lang").alias("lang")).agg(*_widths("_own"))
    # the one row over all languages joins as a row for each; no language is lost without labels
    return (
        spread.join(own, F.col("of_lang").eqNullSafe(F.col("lang")), "left")
        .crossJoin(good.agg(*_widths("_all")))
        .selectExpr(
            "of_lang",
            "middle",
            *[
                f"deviation * CASE WHEN n_own >= {LEAST_LABELS} THEN {side}_own"
                f" WHEN n_all >= {LEAST_LABELS} THEN {side}_all ELSE {SPREAD} END AS {side}"
                for side in ("below", "above")
            ],
        )
    )


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """The measures with ``kept``."""
    return (
        measures.join(limits, F.col("_lang").eqNullSafe(F.col("of_lang")), "left")
        .withColumns({"lower": F.expr(f"middle - below * {WIDER}"), "upper": F.expr(f"middle + above * {WIDER}")})
        .withColumn("kept", F.expr("NOT base_failed AND coalesce(log_perplexity BETWEEN lower AND upper, true)"))
    )


def verdicts(documents: DataFrame, tables: Tables, labels: DataFrame | None = None) -> DataFrame:
    """One row per document: its counts, perplexity, and whether it is kept."""
    measures = measured(documents, tables, "doc_id")
    return judged(measures, tables.save(bands(measures, labels), "bands"))


def accepted(documents: DataFrame, tables: Tables, labels: DataFrame | None = None) -> DataFrame:
    """The documents that are kept, with all their columns.

    Rows are told by id, language and a hash of the text, so copies of a text are spread by their ids.
    """
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("print")
    measures = measured(documents, tables, "doc_id", text)
    gone = tables.save(
        judged(measures, tables.save(bands(measures, labels), "bands"))
        .filter("NOT kept")
        .selectExpr("doc_id AS gone_id", "_lang AS gone_lang", "print AS gone_print")
        .distinct(),
        "gone",
    )
    rows = documents.select(F.struct("*").alias("doc"), "doc_id", F.col("lang").cast("string").alias("_lang"), text)
    met = (
        F.col("doc_id").eqNullSafe(F.col("gone_id"))
        & F.col("_lang").eqNullSafe(F.col("gone_lang"))
        & (F.col("print") == F.col("gone_print"))
    )
    return rows.join(gone, met, "left_anti").select("doc.*")
