"""Personal data by weak supervision, in DataFrame and SQL expressions only.

Four base kinds (email, ip, card, phone) are exact patterns with checks. Beyond them there are two families of
candidates. Runs are characters without white space that hold a digit or an ``@``. Phrases may hold blanks: groups of
digits joined by blanks, hyphens, dots, slashes or brackets; account numbers of the form of an IBAN; street addresses;
and capitalised words that begin with a given name or follow a title or a word such as ``contact``.

Labelers vote on candidates: patterns, check digits, gazetteers of prefixes and given names, and words before them.
One reliability per labeler and the share of personal data per shape of candidate are estimated by
expectation maximisation over the counts of vote patterns. The resulting probabilities train a
logistic classifier per family over the shape and context of a candidate, which makes the final decision, also
where no labeler voted. Its spans are added to the base ones unless they overlap; a phrase goes before a run, and
phrases go in the order of ``SHAPES``.

Votes and features take few values each, so their distinct combinations are bounded whatever the
corpus; all counts run over all candidates of all texts. Only parameters come to the driver.

Patterns are written so that they cannot backtrack beyond their own characters: possessive repeats, and
a look behind so that a run that failed is not tried again from its middle.

Defined results: a null text is empty; spans are code points, the end exclusive; rows are judged on
their own, so equal ids and null ids do not matter; without candidates nothing is added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ledgerstar.scratch import Tables

LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
NUMBER = "(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
DIGITS = "regexp_replace({m}, '[^0-9]', '')"


@dataclass(frozen=True)
class Kind:
    name: str
    contains: str  # SQL test that texts without a match mostly fail
    pattern: str
    valid: str  # SQL test of a match ``{m}``


KINDS = (
    Kind(
        "email",
        "contains({t}, '@')",
        rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:[.]{DOMAIN}++)++",
        "true",
    ),
    Kind(
        "ip",
        "{t} RLIKE '[0-9][.][0-9]'",
        "(?<![0-9])[0-9]++[.][0-9]++[.][0-9]++[.][0-9]++",
        f"{{m}} RLIKE '^(?:0*{NUMBER}(?:[.]|$)){{4}}$'",
    ),
    Kind(
        "card",
        "{t} RLIKE '[0-9][ -]?[0-9]'",
        "[0-9](?:[ -]?[0-9])++",
        f"char_length({DIGITS}) BETWEEN 13 AND 19 AND luhn_check({DIGITS})",
    ),
    Kind(
        "phone",
        "contains({t}, '+')",
        "[+][0-9][ ().0-9-]+[0-9]",
        f"char_length({DIGITS}) BETWEEN 9 AND 15",
    ),
)
NAMES = [kind.name for kind in KINDS]
CANDIDATE = Kind("candidate", "{t} RLIKE '[0-9@]'", r"(?<!\S)(?=\S*?[0-9@])\S++", "true")

# Streets, given names, and words that a person's name follows
STREETS = "Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Terrace|Close|Crescent|Way"
GIVEN = (
    "Alice|Andrea|Andrew|Anna|Anne|Anthony|Antonio|Barbara|Carlos|Charles|Charlotte|Christine|Claire|Daniel|David|"
    "Elena|Elizabeth|Emily|Emma|Francisco|Frank|George|Giulia|Hannah|Hans|Helen|Isabel|Jack|James|Jane|Jean|Jennifer|"
    "Johann|John|Jonas|Jorge|José|Joseph|Juan|Julia|Karen|Karl|Katharina|Kevin|Klaus|Laura|Linda|Lisa|Lucas|Lucia|"
    "Luis|Margaret|Maria|María|Marie|Mark|Martin|Mary|Matthew|Michael|Michel|Nicole|Nina|Pablo|Patricia|Paul|Pedro|"
    "Peter|Philippe|Pierre|Rachel|Richard|Robert|Sandra|Sarah|Sofia|Sophie|Stefan|Stephen|Susan|Thomas|Ursula|William"
)
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Dear|Herr|Frau|Monsieur|Madame|Señor|Señora|Contact|Name|Patient|Customer|Applicant"
NOT_NAMES = "Street|Road|Avenue|University|Institute|College|School|Hospital|Company|Inc|Ltd|Museum|Island|Bay|River"
TITLED = f"(?i)(?:^|[^a-z])(?:{TITLES})[.:]? $"

GROUP, JOINT = "[(]?[0-9]{2,4}[)]?", "[ ./-]"
WORD = r"\p{Lu}\p{Ll}++"
SHAPES = (
    Kind(
        "iban",
        "{t} RLIKE '[A-Z]{2}[0-9]{2}'",
        "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}+(?: [0-9]{1,3}(?![A-Za-z0-9]))?+|[A-Z0-9]{11,30}+)(?![A-Za-z0-9])",
        "true",
    ),
    Kind(
        "number",
        "{t} RLIKE '[0-9)][ ./-][(]?[0-9]'",
        f"(?<![0-9A-Za-z+.(-])(?<![0-9)]{JOINT}){GROUP}(?:{JOINT}{GROUP}){{1,5}}+(?![0-9A-Za-z]|{JOINT}[(]?[0-9])",
        f"char_length({DIGITS}) BETWEEN 7 AND 15",
    ),
    Kind(
        "address",
        "{t} RLIKE '[0-9]'",
        rf"(?<![\p{{L}}\p{{N}}])(?:[0-9]{{1,5}}[A-Za-z]?+,? (?:{WORD} ){{1,3}}?(?:{STREETS})"
        rf"|\p{{Lu}}\p{{Ll}}{{1,30}}?(?:straße|strasse|gasse|weg|platz|allee) [0-9]{{1,4}}[a-z]?"
        rf"|[0-9]{{1,5}},? (?:rue|boulevard|impasse)(?: (?:de|du|des|la))*+ {WORD})(?![\p{{L}}\p{{N}}])",
        "true",
    ),
    Kind(
        "name",
        "{t} RLIKE '[A-Z]'",
        rf"(?<![\p{{L}}\p{{N}}])(?!(?:{TITLES})(?![\p{{L}}])){WORD}(?: \p{{Lu}}[.])?+(?:[ -]{WORD}){{1,3}}+(?![\p{{L}}\p{{N}}])",
        f"({{m}} RLIKE '^(?:{GIVEN})[ -]' OR right(x.g, 24) RLIKE '{TITLED}')"
        f" AND NOT {{m}} RLIKE '(?:{NOT_NAMES})$'",
    ),
)

SPAN = "array<struct<kind:string,start:int,end:int>>"
FOUND = "array<struct<start:int,end:int,body:string,context:string>>"
PHRASES = "array<struct<shape:string,start:int,end:int,body:string,context:string>>"
BLOCK = 256
CONTEXT = 24  # characters before a candidate

# Words and prefixes that go with personal data, or with other numbers
PREFIXES = "AKIA|ASIA|ghp_|gho_|xox|sk-|pk_|eyJ|password[=:]|passwd[=:]|token[=:]|secret[=:]|key[=:]"
BEFORE = "password|passwd|pwd|token|secret|key|phone|tel|mobile|call|fax|card|account|iban|ssn|passport|mail|contact"
OTHERWISE = "version|licen[cs]e|by-nc|chapter|page|section|figure|vol|no|nr|apache|public|cc|year|since|in"

LUHN = f"luhn_check({DIGITS})".replace("{m}", "x.body")

# Votes on a candidate ``x``: 1 for personal data, 0 against, -1 none
LABELERS = {
    "address": "CASE WHEN x.body RLIKE '[A-Za-z0-9]@[A-Za-z0-9]' THEN 1 ELSE -1 END",
    "long_number": "CASE WHEN digits BETWEEN 9 AND 12 AND letters = 0 THEN 1"
    " WHEN digits <= 4 AND letters = 0 THEN 0 ELSE -1 END",
    "checksum": f"CASE WHEN digits BETWEEN 13 AND 19 AND letters = 0 THEN int({LUHN}) ELSE -1 END",
    "mixed_token": "CASE WHEN size >= 16 AND letters >= 3 AND digits >= 3 THEN 1 ELSE -1 END",
    "prefix": f"CASE WHEN x.body RLIKE '^[^A-Za-z0-9]*(?:{PREFIXES})' THEN 1 ELSE -1 END",
    "context": f"CASE WHEN x.context RLIKE '(?i)(?:^|[^a-z])(?:{BEFORE})[^a-z0-9]*$' THEN 1"
    f" WHEN x.context RLIKE '(?i)(?:^|[^a-z])(?:{OTHERWISE})[^a-z0-9]*$' THEN 0 ELSE -1 END",
    "decimal": "CASE WHEN x.body RLIKE '^[0-9]{1,3}(?:[.,][0-9]{1,3})?[.,;:%)]*$' THEN 0 ELSE -1 END",
    "digits_and_signs": "CASE WHEN letters = 0 AND digits BETWEEN 9 AND 12"
    " AND x.body RLIKE '^[(+]?[0-9][0-9().-]+$' THEN 1 ELSE -1 END",
    "word": "CASE WHEN digits <= 2 AND letters >= 1 AND NOT contains(x.body, '@') THEN 0 ELSE -1 END",
}
FEATURES = (
    "least(size div 4, 8)",
    "least(digits div 3, 7)",
    "least(letters div 3, 7)",
    "int(contains(x.body, '@'))",
    "int(x.body RLIKE '[=:]')",
    "int(letters > 0 AND digits > 0)",
    f"int(CASE WHEN digits BETWEEN 13 AND 19 AND letters = 0 THEN NOT {LUHN} ELSE false END)",
    f"int(x.context RLIKE '(?i)(?:{BEFORE})[^a-z0-9]*$')",
    f"int(x.context RLIKE '(?i)(?:{OTHERWISE})[^a-z0-9]*$')",
)

# The same for phrases
CHECKED = (  # remainder by 97 of an IBAN, letters being two digits
    "aggregate(split(substring(code, 5) || left(code, 4), ''), 0, (r, c) -> CASE WHEN c = '' THEN r"
    " WHEN c RLIKE '[0-9]' THEN (r * 10 + int(c)) % 97 ELSE (r * 100 + ascii(c) - 55) % 97 END) = 1"
).replace("code", "replace(x.body, ' ', '')")
SSN = "x.body RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'"
YEAR = "(?:1[5-9]|20)[0-9]{2}"
DATED = (
    f"x.body RLIKE '^[(]?(?:{YEAR}{JOINT}[0-9]{{2}}{JOINT}[0-9]{{2}}|[0-9]{{2}}{JOINT}[0-9]{{2}}{JOINT}{YEAR}"
    f"|{YEAR}(?:{JOINT}{YEAR})+)[)]?(?: [0-9]{{2,4}})?$'"
)
DIALLED = "x.body RLIKE '^[(]?[0-9]{2,4}[)]?[ ./-][0-9]{3,4}(?:[ ./-][0-9]{2,4}){0,2}$'"
CALLED = f"x.context RLIKE '(?i)(?:^|[^a-z])(?:{BEFORE})[^a-z0-9]*$'"
COUNTED = f"x.context RLIKE '(?i)(?:^|[^a-z])(?:{OTHERWISE})[^a-z0-9]*$'"
LIVES = "x.context RLIKE '(?i)(?:^|[^a-z])(?:address|lives? (?:at|in)|resid(?:es|ing) at|home|wohnhaft|adresse)[^a-z0-9]*(?:(?:is|at|in) )?$'"
NAMED, TITLE = f"x.body RLIKE '^(?:{GIVEN})[ -]'", f"x.context RLIKE '{TITLED}'"


def _vote(shape: str, yes: str, no: str = "false") -> str:
    return f"CASE WHEN x.shape != '{shape}' THEN -1 WHEN {yes} THEN 1 WHEN {no} THEN 0 ELSE -1 END"


PHRASE_LABELERS = {
    "iban_digits": _vote("iban", CHECKED, "true"),
    "iban_context": _vote("iban", CALLED),
    "number_context": _vote("number", CALLED, COUNTED),
    "number_dialled": _vote("number", f"{DIALLED} AND NOT {DATED}", DATED),
    "number_ssn": _vote("number", SSN),
    "number_pairs": _vote("number", "false", "x.body RLIKE '^[0-9]{2}(?:[ ./-][0-9]{2})+$'"),
    "address_form": _vote("address", "x.body RLIKE '[0-9]'"),
    "address_context": _vote("address", LIVES, COUNTED),
    "name_given": _vote("name", NAMED),
    "name_title": _vote("name", TITLE),
}
PHRASE_FEATURES = (
    *(f"int(x.shape = '{kind.name}')" for kind in SHAPES),
    f"int(CASE WHEN x.shape = 'iban' THEN {CHECKED} ELSE false END)",
    *(f"int(x.shape = 'number' AND {sql})" for sql in (CALLED, COUNTED, DIALLED, DATED, SSN)),
    "int(x.shape = 'number' AND x.body RLIKE '^[0-9]{2}(?:[ ./-][0-9]{2})+$')",
    f"int(x.shape = 'address' AND {LIVES})",
    *(f"int(x.shape = 'name' AND {sql})" for sql in (NAMED, TITLE)),
)
PHRASE_KIND = f"CASE WHEN x.shape != 'number' THEN x.shape WHEN {SSN} THEN 'ssn' ELSE 'phone' END"
ADDED = ["secret", "iban", "ssn", "address", "name"]
STEPS = 12
START = 0.8  # reliability that estimation starts from, and what it is worth in votes
WORTH = 10.0


def _literal(text: str) -> str:
    return "r'" + text + "'" if "'" not in text else repr(text)


def _matches(kind: Kind, item: str, empty: str, text: str = "text") -> str:
    """SQL for all valid matches of a text; ``item`` sees ``m``, the gap before it, and ``at``.

    Matches and the gaps between them alternate, so adding up their lengths gives the places. Appending copies an
    array, so items gather in blocks of ``BLOCK``: a text with very many matches is not copied once for each.
    """
    pattern = _literal(kind.pattern)
    found, gaps = f"regexp_extract_all({text}, {pattern}, 0)", f"split({text}, {pattern}, -1)"
    pairs = f"zip_with({found}, {gaps}, (m, g) -> struct(coalesce(m, '') AS m, coalesce(g, '') AS g, m IS NOT NULL AS is))"
    valid = kind.valid.replace("{m}", "x.m")
    added = f"CAST(array_append(done.found, {item}) AS {empty})"
    full = f"CAST(array_append(done.full, done.found) AS array<{empty}>)"
    return (
        f"CASE WHEN {kind.contains.replace("{t}", text)} THEN aggregate({pairs},"
        f" struct(0 AS at, CAST(array() AS {empty}) AS found, CAST(array() AS array<{empty}>) AS full),"
        f" (done, x) -> struct(done.at + char_length(x.g) + char_length(x.m) AS at,"
        f" CASE WHEN size(done.found) >= {BLOCK} AND x.is AND {valid} THEN CAST(array({item}) AS {empty})"
        f" WHEN x.is AND {valid} THEN {added} ELSE done.found END AS found,"
        f" CASE WHEN size(done.found) >= {BLOCK} AND x.is AND {valid} THEN {full} ELSE done.full END AS full),"
        f" done -> flatten(array_append(done.full, done.found))) ELSE CAST(array() AS {empty}) END"
    )


def matched(documents: DataFrame, *columns) -> DataFrame:
    """The base spans and the candidates of every text, beside the given columns."""
    place = "done.at + char_length(x.g)"
    base = [
        _matches(k, f"struct('{k.name}' AS kind, {place} AS start, {place} + char_length(x.m) AS end)", SPAN)
        for k in KINDS
    ]
    candidate = (
        f"struct({place} AS start, {place} + char_length(x.m) AS end, x.m AS body,"
        f" right(x.g, {CONTEXT}) AS context)"
    )
    phrases = [
        _matches(k, f"struct('{k.name}' AS shape, {candidate[len('struct('):]}", PHRASES) for k in SHAPES
    ]
    texts = documents.select(*columns, F.expr("coalesce(CAST(text AS STRING), '') AS text"))
    return texts.withColumns({
        **{kind.name: F.expr(sql) for kind, sql in zip(KINDS, base)},
        "candidates": F.expr(_matches(CANDIDATE, candidate, FOUND)),
        "phrases": F.expr(f"concat({', '.join(phrases)})"),
    }).drop("text")


def labelled(found: DataFrame) -> DataFrame:
    """Each candidate trimmed to its core, with its votes, features and kind, unless it overlaps a base span."""
    trimmed = (
        "transform(candidates, x -> named_struct("
        "'start', x.start + char_length(regexp_extract(x.body, '^[^A-Za-z0-9+(]*', 0)),"
        "'end', x.end - char_length(regexp_extract(reverse(x.body), '^[^A-Za-z0-9]*', 0)),"
        "'body', x.body, 'context', x.context,"
        "'digits', char_length(regexp_replace(x.body, '[^0-9]', '')),"
        "'letters', char_length(regexp_replace(x.body, '[^A-Za-z]', '')),"
        "'size', char_length(x.body)))"
    )
    base = ", ".join(NAMES)
    free = (
        f"filter({{}}, x -> x.start < x.end AND NOT exists(concat({base}),"
        " b -> b.start < x.end AND x.start < b.end))"
    )

    def of_x(sql: str) -> str:
        for name in ("digits", "letters", "size"):
            sql = sql.replace(f"{name} ", f"x.{name} ")
        return sql

    votes = ", ".join(f"tinyint({of_x(sql)})" for sql in LABELERS.values())
    features = ", ".join(f"double({of_x(sql)})" for sql in FEATURES)
    kind = (
        "CASE WHEN contains(x.body, '@') THEN 'email'"
        " WHEN x.digits = 9 AND x.body RLIKE '(?:^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?:[^0-9]|$)' THEN 'ssn'"
        " WHEN x.letters = 0 AND x.digits BETWEEN 9 AND 15 THEN 'phone'"
        f" WHEN x.letters = 0 AND x.digits BETWEEN 16 AND 19 AND {LUHN} THEN 'card' ELSE 'secret' END"
    )
    rows = found.withColumn("candidates", F.expr(trimmed)).withColumns(
        {name: F.expr(free.format(name)) for name in ("candidates", "phrases")}
    )
    phrase_votes = ", ".join(f"tinyint({sql})" for sql in PHRASE_LABELERS.values())
    phrase_features = ", ".join(f"double({sql})" for sql in PHRASE_FEATURES)
    judge = "transform({}, x -> named_struct('shape', {}, 'kind', {}, 'start', x.start, 'end', x.end, 'votes', array({}), 'features', array({})))"
    return rows.withColumns({
        "candidates": F.expr(judge.format("candidates", "'run'", kind, votes, features)),
        "phrases": F.expr(judge.format("phrases", "x.shape", PHRASE_KIND, phrase_votes, phrase_features)),
    })


def posterior(shares: dict[str, float], reliability: list[float]) -> str:
    """SQL for the probability that a row of ``shape`` and ``votes`` is personal data."""
    cases = " ".join(f"WHEN '{shape}' THEN ln({x!r} / {1 - x!r})" for shape, x in shares.items())
    odds = [f"CASE shape {cases} END"]
    for i, x in enumerate(reliability):
        weight = f"ln({x!r} / {1 - x!r})"
        odds.append(f"CASE votes[{i}] WHEN 1 THEN {weight} WHEN 0 THEN -{weight} ELSE 0 END")
    return f"1 / (1 + exp(-({' + '.join(odds)})))"


def estimate(patterns: DataFrame, labelers: int, steps: int = STEPS) -> tuple[dict[str, float], list[float]]:
    """Share of personal data per shape and reliability of each labeler, by expectation maximisation."""
    shapes = sorted(x.shape for x in patterns.select("shape").distinct().collect())  # one to four
    shares, reliability = dict.fromkeys(shapes, 0.5), [START] * labelers
    for _ in range(steps):
        rows = patterns.withColumn("p", F.expr(posterior(shares, reliability)))
        sums = [F.expr("sum(n * p)"), F.expr("sum(n)")]
        for i in range(labelers):
            sums.append(F.expr(f"sum(n * CASE votes[{i}] WHEN 1 THEN p WHEN 0 THEN 1 - p ELSE 0 END)"))
            sums.append(F.expr(f"sum(CASE WHEN votes[{i}] >= 0 THEN n ELSE 0 END)"))
        got = rows.groupBy("shape").agg(*[x.alias(f"s{i}") for i, x in enumerate(sums)]).collect()
        shares = {x.shape: float(min(max((x.s0 + 1) / (x.s1 + 2), 0.01), 0.99)) for x in sorted(got)}
        right = [sum(x[f"s{2 + 2 * i}"] for x in sorted(got)) for i in range(labelers)]
        voted = [sum(x[f"s{3 + 2 * i}"] for x in sorted(got)) for i in range(labelers)]
        reliability = [
            float(min(max((r + START * WORTH) / (n + WORTH), 0.05), 0.99)) for r, n in zip(right, voted)
        ]
    return shares, reliability


def train(rows: DataFrame, tables: Tables, column: str = "candidates", labelers: int = len(LABELERS)) -> str | None:
    """SQL for the classifier's log odds of a candidate ``x`` of a column; None without candidates."""
    candidates = rows.select(F.explode(column).alias("x")).select("x.shape", "x.votes", "x.features")
    patterns = tables.save(
        candidates.groupBy("shape", "votes", "features").agg(F.count("*").alias("n")), f"{column}_patterns"
    )
    if patterns.isEmpty():
        return None
    soft = patterns.withColumn("p", F.expr(posterior(*estimate(patterns, labelers))))
    examples = soft.select(
        array_to_vector("features").alias("features"),
        F.explode(F.expr("array(struct(1D AS label, n * p AS weight), struct(0D AS label, n * (1 - p) AS weight))")).alias("y"),
    ).select("features", "y.label", "y.weight")
    examples = tables.save(examples, f"{column}_examples")
    model = LogisticRegression(weightCol="weight", regParam=0.001, maxIter=50).fit(examples)
    terms = [f"{float(w)!r} * x.features[{i}]" for i, w in enumerate(model.coefficients)]
    return " + ".join([repr(float(model.intercept)), *terms])


def judged(documents: DataFrame, tables: Tables, *columns) -> DataFrame:
    """Base spans per kind, and ``spans`` with those that the classifier adds, beside the columns."""
    found = tables.save(matched(documents, *(columns or ("doc_id",))), "matched")
    rows = tables.save(labelled(found), "labelled")
    tables.drop("matched")
    families = {"phrases": len(PHRASE_LABELERS), "candidates": len(LABELERS)}
    accepted = {}
    for name, labelers in families.items():
        odds = train(rows, tables, name, labelers)
        accepted[name] = F.expr(f"filter({name}, x -> {odds} > 0)" if odds else f"slice({name}, 1, 0)")
    order = f"array({', '.join(repr(x.name) for x in SHAPES)})"
    overlap = "y.start < x.end AND x.start < y.end"
    first = (
        f"filter(phrases, x -> NOT exists(phrases, y -> array_position({order}, y.shape)"
        f" < array_position({order}, x.shape) AND {overlap}))"
    )
    rows = rows.withColumns(accepted).withColumn("phrases", F.expr(first))
    runs = f"filter(candidates, x -> NOT exists(phrases, y -> {overlap}))"
    added = f"transform(concat({runs}, phrases), x -> struct(x.kind AS kind, x.start AS start, x.end AS end))"
    kinds = [*NAMES, *ADDED]
    ranked = (
        f"transform(array_sort(transform(concat({', '.join(NAMES)}, {added}),"
        f" x -> struct(array_position(array({', '.join(map(repr, kinds))}), x.kind) AS at, x.start AS start,"
        " x.end AS end, x.kind AS kind))), x -> struct(x.kind AS kind, x.start AS start, x.end AS end))"
    )
    return rows.withColumn("spans", F.expr(ranked)).drop("candidates", "phrases")


def joined(spans: str) -> str:
    """SQL for spans as text, ``kind:start:end`` joined by commas."""
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def masked(documents: DataFrame, tables: Tables) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets."""
    rows = judged(documents, tables, F.struct("*").alias("doc"))
    cut = (
        "aggregate(array_sort(transform(spans, x -> struct(x.start, x.end, x.kind))),"
        " struct(0 AS at, '' AS out), (done, x) -> CASE WHEN x.start < done.at THEN done ELSE"
        " struct(x.end AS at, concat(done.out, substring(doc.text, done.at + 1, x.start - done.at),"
        " '<', x.kind, '>') AS out) END,"
        " done -> concat(done.out, substring(doc.text, done.at + 1)))"
    )
    return rows.withColumn("doc", F.expr("doc").withField("text", F.expr(cut))).select("doc.*")
