"""URL filtering by rules on hosts and by mined association rules.

FP-growth counts which combinations of URL features go with pages of low quality. A combination on at least
a share ``MIN_SUPPORT`` of the labelled pages and ``MIN_PAGES`` pages, counting pages of low quality alone, is a
rule where a share ``MIN_CONFIDENCE`` of all pages that have it is of low quality. Only minimal rules are kept:
where a part is a rule by itself, the whole blocks no further page. Rules match by an inverted index: each is
filed under its rarest feature, a page looks up its features there, and the rest of the rule is then compared.

The whole URL is taken apart into distinct features, each tagged with its place: scheme, every label of the
host from its end, every path segment, the extension, every query key and every key with its value, each
also with digits folded; the words of the path, and those of labels with several, wherever they stand; and
a fragment. Of features that occur on exactly the same labelled pages one stands for all.

Bodies grow by length, and each length leaves less to the next. Single features are counted first. Those that
are no rules, and frequent among pages of low quality, form pairs, counted as such at the least support.
A longer minimal rule holds only frequent pairs that are neither rules nor on the same pages as one of their parts;
FP-growth sees pages of low quality with the features of such pairs alone, and what it finds is counted on all
pages. Good pages thus never decide what is mined, however long they are.

FP-growth runs at the least support where at most ``MOST_COMBINATIONS`` per page of it can be frequent, by the sum of
``2**features`` over what is left of the pages of low quality. Elsewhere, where many features stand together
on pages of low quality, bodies grow on by one feature at a time, counted on Spark, until nothing that they grow to can
be a rule. Both find the same rules; no support is raised.

Defined results: a null URL, or one without ``://``, has an empty host and path, no features and the
verdict ``allow``; labels without a page, and null labels, are left out; without labelled pages no
rule is mined; repeated pages are judged alike, and each counts; equal rows of labels count once, and a page with
two different labels counts as both.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm.tables import Tables

MIN_SUPPORT = 0.001
MIN_PAGES = 20  # a combination on fewer labelled pages is no evidence
MIN_CONFIDENCE = 0.5
MOST_COMBINATIONS = 2**10 / MIN_SUPPORT
# All pairs of a page's features, in the order of its list
PAIRS = """flatten(transform(keys, (x, i) ->
    transform(slice(keys, i + 2, size(keys)), y -> struct(x AS a, y AS b))))"""
BLOCK_ROWS = 8192  # pages that are counted at once
CHUNK = 500  # heads that are counted at once
TALLY = "head array<string>, tail string, of_body long, of_low long, remain long"
DIGITS = 19  # of a count, so that text sorts as numbers do
RULE = "body array<string>, key string, support double, confidence double"


class HostRule(NamedTuple):
    """A host with all its subdomains, and the beginning of a path."""

    host: str
    path: str
    verdict: str


RULES = (
    HostRule("com", "/", "allow"),
    HostRule("example.com", "/en/", "block"),
    HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"),
    HostRule("net", "/fr/", "block"),
)


# Digits of a feature folded, those of its tag left
FOLDED = "substring_index(x, ':', 1) || regexp_replace(substring(x, instr(x, ':')), '[0-9]+', '0')"


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path, features`` of every page."""
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    after = "CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END"
    split = (
        pages.select("page_id", "url")
        .withColumn("after", F.expr(after))
        .withColumn("raw_host", F.expr("regexp_extract(after, '^[^/?#]*', 0)"))
        .withColumn("rest", F.expr("substring(after, char_length(raw_host) + 1)"))
        .withColumn("host", F.expr(f"translate(raw_host, {lower})"))
        .withColumn("path", F.expr("regexp_extract(rest, '^[^?#]*', 0)"))
    )
    labels, segments = "reverse(split(host, '[.]'))", "split(path, '/')"
    pairs = "split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '[&;]')"
    words = "split(lower({}), '[^\\\\p{{L}}\\\\p{{N}}]+')"
    several = "filter(split(host, '[.]'), x -> x RLIKE '[-_]')"
    groups = [
        "array('s:' || lower(substring_index(url, '://', 1)))",
        f"transform({labels}, (x, i) -> 'h' || (i + 1) || ':' || x)",
        f"transform({segments}, (x, i) -> 'p' || i || ':' || x)",
        "array('x:' || regexp_extract(path, '[.]([A-Za-z]+)$', 1))",
        f"transform({pairs}, x -> 'q:' || substring_index(x, '=', 1))",
        f"transform(filter({pairs}, x -> contains(x, '=')), x -> 'v:' || x)",
        f"transform({words.format('path')}, x -> 'w:' || x)",
        f"transform({words.format(f'array_join({several}, chr(32))')}, x -> 'hw:' || x)",
        "CASE WHEN contains(rest, '#') THEN array('f:#') ELSE array() END",
    ]
    raw = f"filter(concat({', '.join(groups)}), x -> NOT endswith(x, ':'))"
    both = f"array_union({raw}, transform({raw}, x -> {FOLDED}))"
    features = f"CASE WHEN after != '' THEN array_sort({both}) ELSE array() END"
    return split.select("page_id", "url", "host", "path", F.expr(features).cast("array<string>").alias("features"))


def ruled(pages: DataFrame, rules: Sequence[HostRule] = RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest host rule that fits, or nulls.

    The rules that fit one host are nested, so the longest is the first that fits in that order.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for x in sorted(rules, key=lambda x: len(x.host + x.path)):
        fits = F.concat(F.lit("."), "host").endswith(f".{x.host}") & F.col("path").startswith(x.path)
        rule = F.when(fits, x.host + x.path).otherwise(rule)
        verdict = F.when(fits, x.verdict).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def longer(
    items: DataFrame, live: DataFrame, single: DataFrame, least: int, min_confidence: float, tables: Tables
) -> DataFrame:
    """Bodies of three and more features, on ``least`` pages of low quality, of which some can be minimal rules: ``body``.

    Each feature of such a body has two partners among the ``live`` pairs on every page of the body.
    """
    paired = (
        items.filter("low")
        .select("row", F.explode(F.expr(PAIRS)).alias("pair"))
        .select("row", "pair.*")
        .join(live.select("a", "b"), ["a", "b"])
        .select("row", F.explode(F.array("a", "b")).alias("key"))
    )
    kept = paired.groupBy("row", "key").agg(F.count("*").alias("partners")).filter("partners > 1")
    of_low = kept.groupBy("key").agg(F.count("*").alias("of_low")).filter(F.col("of_low") >= least)
    left = tables.save(
        kept.join(of_low, "key").groupBy("row").agg(F.collect_list("key").alias("items")), "longer_items"
    )
    n, combinations = left.agg(F.count("*"), F.sum(F.expr("pow(2D, size(items))"))).first()
    if not n:
        return tables.spark.createDataFrame([], "body array<string>")
    if combinations > MOST_COMBINATIONS * least:
        return grown(items, live, single, least, min_confidence, tables)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n)).fit(left)
    return model.freqItemsets.select(F.array_sort("items").alias("body")).filter("size(body) > 2")


def _blocks(group: pd.DataFrame) -> pd.DataFrame:
    """Which rows of a block have each feature, and which are of low quality, as bits."""
    names, of = np.unique(np.concatenate(group["keys"].tolist()), return_inverse=True)
    row = np.repeat(np.arange(len(group)), group["keys"].map(len))
    bits = np.zeros((len(names), -(-len(group) // 8)), np.uint8)
    np.add.at(bits, (of, row >> 3), (128 >> (row & 7)).astype(np.uint8))
    low = np.packbits(group["low"].to_numpy(bool))
    return pd.DataFrame({"names": [names.tolist()], "bits": [bits.tobytes()], "low": [low.tobytes()]})


def _tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts in one block of every body that is a head with one of its tails."""
    for batch in batches:
        for block in batch.to_pylist():
            low = np.frombuffer(block["low"], np.uint8)
            bits = np.frombuffer(block["bits"], np.uint8).reshape(-1, len(low))
            bits = np.vstack([bits, np.zeros_like(low)])  # the last for features that no row has
            place = {x: i for i, x in enumerate(block["names"])}
            heads, tails, counts = [], [], [[], [], []]
            for x in block["classes"]:
                head = np.bitwise_and.reduce(bits[[place.get(y, -1) for y in x["head"]]])
                found = bits[[place.get(y, -1) for y in x["tails"]]] & head
                remain = np.bitwise_and.accumulate(found[::-1])[::-1] & ~low
                heads += [x["head"]] * len(found)
                tails += x["tails"]
                for all_counts, part in zip(counts, (found, found & low, remain)):
                    all_counts.append(np.bitwise_count(part).sum(1, dtype=np.int64))
            kinds = (pa.list_(pa.string()), pa.string(), *[pa.int64()] * 3)
            columns = (heads, tails, *map(np.concatenate, counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=[x.split()[0] for x in TALLY.split(", ")]
            )


def grown(
    items: DataFrame, live: DataFrame, single: DataFrame, least: int, min_confidence: float, tables: Tables
) -> DataFrame:
    """Rules of three and more features, all minimal ones among them, grown by one feature at a time: ``body``.

    Features are ordered from the rarest. A body is a ``head`` and a later tail; it grows by the later tails of
    its head. Frequent bodies go on where they are no rules and on fewer pages than what they grew from. None
    grows from a body if nothing below it can be a rule: good pages with all of its later tails remain on
    whatever it grows to, and its pages of low quality only become fewer, as do those of each tail. Pages are
    blocks of bits.
    """
    named = single.selectExpr("key", "of_key", f"lpad(of_key, {DIGITS}, '0') || key AS name")
    of_a, of_b = named.toDF("a", "of_a", "name_a"), named.toDF("b", "of_b", "name_b")
    pairs = tables.save(
        live.join(of_a, "a").join(of_b, "b").selectExpr(
            "array_sort(array(struct(name_a AS name, of_a AS n), struct(name_b AS name, of_b AS n))) AS pair"
        ),
        "named_pairs",
    )
    used = pairs.select(F.explode("pair.name").alias("name")).distinct()
    kept = tables.save(
        items.select("row", "low", F.explode("keys").alias("key"))
        .join(named.join(used, "name"), "key")
        .groupBy("row", "low")
        .agg(F.collect_list("name").alias("keys")),
        "named_items",
    )
    n_blocks = math.ceil(kept.count() / BLOCK_ROWS)
    blocks = kept.groupBy(F.expr(f"pmod(xxhash64(row), {n_blocks})").alias("block")).applyInPandas(
        _blocks, "names array<string>, bits binary, low binary"
    )
    blocks = tables.save(blocks, "blocks")
    classes = pairs.groupBy(F.expr("pair[0]").alias("first")).agg(
        F.sort_array(F.collect_list(F.expr("struct(pair[1].name AS tail, pair[1].n AS of_part)"))).alias("tails")
    )
    classes = classes.selectExpr("array(first.name) AS head", "first.n AS of_head", "tails")
    is_rule = f"of_low >= {min_confidence}D * of_body"
    # a thousandth of a page, as limits are compared with rounded products
    can_be = f"{{0}}of_low + 0.001D >= {min_confidence}D * ({{0}}of_low + {{1}}remain)"
    found, length = [], 2
    while (n := (classes := tables.save(classes, f"classes{length}")).count()):
        chunks = classes.groupBy(F.expr(f"pmod(xxhash64(head), {math.ceil(n / CHUNK)})").alias("chunk")).agg(
            F.collect_list(F.struct("head", F.col("tails.tail").alias("tails"))).alias("classes")
        )
        counts = (
            blocks.crossJoin(chunks.drop("chunk"))
            .mapInArrow(_tally, TALLY)
            .groupBy("head", "tail")
            .agg(*[F.sum(x).alias(x) for x in ("of_body", "of_low", "remain")])
            .filter(f"of_low >= {least}")
        )
        before = classes.select("head", "of_head", F.explode("tails").alias("x")).select("head", "of_head", "x.*")
        counted = tables.save(counts.join(before, ["head", "tail"]), f"counted{length}")
        found.append(counted.filter(is_rule).selectExpr("head || array(tail) AS body"))
        going = counted.filter(f"NOT {is_rule} AND of_body < of_head AND of_body < of_part")
        opened = f"filter(members, x -> {can_be.format('x.', 'x.')})"
        later = f"filter(members, y -> y.tail > x.tail AND {can_be.format('y.', 'x.')})"
        grows = f"""transform({opened}, x -> struct(head || array(x.tail) AS head, x.of_body AS of_head,
            transform({later}, y -> struct(y.tail AS tail, y.of_body AS of_part)) AS tails))"""
        classes = (
            going.groupBy("head")
            .agg(F.sort_array(F.collect_list(F.struct("tail", "of_body", "of_low", "remain"))).alias("members"))
            .select(F.explode(F.expr(grows)).alias("x"))
            .select("x.*")
            .filter("size(tails) > 0")
        )
        length += 1
    plain = f"array_sort(transform(body, x -> substring(x, {DIGITS + 1}))) AS body"
    return reduce(DataFrame.unionByName, found).selectExpr(plain)


def keyed(bodies: DataFrame, single: DataFrame) -> DataFrame:
    """Adds the rarest feature of a body as its ``key``."""
    rarest = (
        bodies.select("body", F.explode("body").alias("key"))
        .join(single.select("key", "of_key"), "key")
        .groupBy("body")
        .agg(F.min(F.struct("of_key", "key"))["key"].alias("key"))
    )
    return bodies.join(rarest, "body")


def minimal(bodies: DataFrame, rules: DataFrame) -> DataFrame:
    """The ``bodies`` of which no part is the body of one of ``rules``."""
    whole = bodies.select(F.col("body").alias("features"))
    implied = matches(whole, rules.select("body", "key")).filter("size(body) < size(features)")
    return bodies.join(implied.select(F.col("features").alias("body")).distinct(), "body", "left_anti")


def mine(
    pages: DataFrame,
    labels: DataFrame,
    tables: Tables,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules ``(body, key, support, confidence)`` towards low quality, from all labelled pages."""
    known = labels.filter("quality IS NOT NULL").select("doc_id", "quality").distinct()
    pages = tables.save(
        parsed(pages)
        .join(known, F.col("page_id") == F.col("doc_id"))
        .filter("size(features) > 0")
        .select(F.monotonically_increasing_id().alias("row"), F.expr("quality = 0").alias("low"), "features"),
        "labelled",
    )
    labelled = pages.count()
    if not labelled:
        return tables.spark.createDataFrame([], RULE)
    least = math.ceil(min(1.0, max(min_support, MIN_PAGES / labelled)) * labelled)
    looked_up = pages.select("row", "low", F.explode("features").alias("feature"))
    # features of exactly the same pages have equal counts and equal hashes over their rows
    single = tables.save(
        looked_up.groupBy("feature")
        .agg(
            F.count("*").alias("of_key"),
            F.count_if("low").alias("of_low"),
            F.bit_xor(F.xxhash64("row")).alias("hash"),
            F.bit_xor(F.xxhash64("row", F.lit(1))).alias("other"),
        )
        .filter(F.col("of_low") >= least)
        .groupBy("of_key", "of_low", "hash", "other")
        .agg(F.min("feature").alias("key"))
        .select("key", "of_key", "of_low"),
        "singles",
    )
    is_rule = f"of_low >= {min_confidence}D * of_body"
    rated = ["body", f"of_low / {labelled} AS support", "of_low / of_body AS confidence"]
    parts = single.withColumn("of_body", F.col("of_key"))
    items = tables.save(
        looked_up.join(parts.filter(f"NOT {is_rule}"), F.col("feature") == F.col("key"))
        .groupBy("row", "low")
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
        .filter("size(keys) > 1"),
        "items",
    )
    pairs = tables.save(
        items.select("low", F.explode(F.expr(PAIRS)).alias("pair"))
        .groupBy("pair")
        .agg(F.count("*").alias("of_body"), F.count_if("low").alias("of_low"))
        .filter(F.col("of_low") >= least)
        .select("pair.*", "of_body", "of_low"),
        "pairs",
    )
    short = (
        parts.withColumn("body", F.array("key"))
        .select("body", "of_body", "of_low")
        .unionByName(pairs.select(F.array("a", "b").alias("body"), "of_body", "of_low"))
        .filter(is_rule)
    )
    short = tables.save(keyed(short.selectExpr(*rated), single), "short")

    alone = single.select("key", "of_key")
    live = (
        pairs.filter(f"NOT {is_rule}")
        .join(alone.withColumnsRenamed({"key": "a", "of_key": "of_a"}), "a")
        .join(alone.withColumnsRenamed({"key": "b", "of_key": "of_b"}), "b")
        .filter("of_body < of_a AND of_body < of_b")
        .select("a", "b", "of_body")
    )
    found = longer(items, tables.save(live, "live"), single, least, min_confidence, tables)
    bodies = tables.save(minimal(keyed(found, single), short), "bodies")
    seen = (
        matches(items.withColumnRenamed("keys", "features"), bodies)
        .groupBy("body", "key")
        .agg(F.count("*").alias("of_body"), F.count_if("low").alias("of_low"))
    )
    long = tables.save(seen.filter(is_rule).selectExpr(*rated, "key"), "long")
    return tables.save(short.unionByName(minimal(long, long)), "rules")


def matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Pairs of a row and a rule whose whole body is among the row's ``features``."""
    looked_up = rows.withColumn("feature", F.explode("features"))
    return looked_up.join(rules, F.col("feature") == F.col("key")).filter(
        "size(array_except(body, features)) = 0"
    )


def judged(
    pages: DataFrame,
    labels: DataFrame,
    tables: Tables,
    rules: Sequence[HostRule] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Every page with the host rule that fits and its verdict.

    Pages that no host rule decides are blocked when a mined rule matches. Rules are looked up once
    per distinct set of features that occur in rules, of which a host with a third of all pages has few.
    """
    mined = mine(pages, labels, tables, min_support, min_confidence)
    # each is on a share of at least the least support of the labelled pages, so they are few
    used = [x.feature for x in mined.select(F.explode("body").alias("feature")).distinct().collect()]
    rows = ruled(parsed(pages), rules).withColumn("features", F.filter("features", lambda x: x.isin(used)))
    distinct = tables.save(rows.select("features").distinct(), "feature_sets")
    best = tables.save(
        matches(distinct, mined)
        .groupBy(F.col("features").alias("of_features"))
        .agg(F.max(F.struct("confidence", "support", "body")).alias("mined")),
        "matched",
    )
    return rows.join(best, F.col("features") == F.col("of_features"), "left").select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.expr(
            "coalesce(rule_verdict, CASE WHEN mined IS NOT NULL THEN 'block' ELSE 'allow' END)"
        ).alias("verdict"),
        F.col("mined.body").alias("mined_rule"),
        F.col("mined.confidence").alias("mined_confidence"),
    )
