"""Secrets: known forms by pattern, others by character Markov models of random strings and of ordinary ones."""

from __future__ import annotations

import math
import string as ascii_sets
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, running_starts, saved, texts

# The known forms.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
ASSIGN_CHARS = 12
KINDS = ("assign", "access", "hex", "markov")

# What the models judge: strings that could be one secret.
STRING = r"[A-Za-z0-9+/_=-]{16,}+"
CODES = 128
SMOOTHING = 0.5
# What a random model leaves for characters outside its alphabet.
OUTSIDE = 0.001
# Least mean log-likelihood ratio of a step in nats, where no samples are held out to choose it.
THRESHOLD = 0.7
# The threshold lies between what so many of the held-out ordinary strings exceed and what so many of the random ones do not reach.
FALSE_ALARMS = 0.005
MISSES = 0.01
HELD_OUT = 5

# Labelled samples: so many random strings of each alphabet, so many identifiers, rulers and dates, the words of about so many documents.
SAMPLES = 3000
IDENTIFIERS = 12000
LAYOUTS = 3000
WORD_DOCS = 2000

# Alphabets of keys and tokens.
ALPHABETS = {
    "lower hex": "0123456789abcdef",
    "upper hex": "0123456789ABCDEF",
    "lower and digits": ascii_sets.ascii_lowercase + ascii_sets.digits,
    "upper and digits": ascii_sets.ascii_uppercase + ascii_sets.digits,
    "letters and digits": ascii_sets.ascii_letters + ascii_sets.digits,
    "base64": ascii_sets.ascii_letters + ascii_sets.digits + "+/",
    "base64 for urls": ascii_sets.ascii_letters + ascii_sets.digits + "-_",
}
# Words that programs name things by.
NAME_WORDS = """
    get set add remove create update delete find read write open close load save send receive start stop init run check
    test build parse format convert validate handle process request response server client user account name address
    customer order product item list map array index count total number value key type class object method function
    field column row table query database connection session config option setting default max min size length width
    height time date year month day event message error warning exception result status state file path folder image
    text string word line page document report data source target input output buffer stream channel thread queue lock
    cache memory local remote public private static abstract base factory manager service controller view model test
    json http html number color button window screen version release branch commit project module package library
    include example share local bin home application context environment variable parameter attribute property element
""".split()
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _pieces(text: Column, pattern: str) -> Column:
    """Matches, and the text around them (one more)."""
    return F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))


def _placed(pieces: Column) -> Column:
    """The matches as ``(match, start)``, in code points."""
    def placed(p: Column) -> Column:
        steps = F.zip_with(p["g"], p["m"], lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("long"))
        starts = F.zip_with(running_starts(steps), p["g"], lambda at, g: at + F.length(g))
        return F.zip_with(p["m"], F.slice(starts, 1, F.size(p["m"])), lambda m, at: F.struct(
            m.alias("match"), at.alias("start")))

    return let(pieces, placed)


def _spans(kind: str, placed: Column) -> Column:
    return F.transform(placed, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (x["start"] + F.length(x["match"])).alias("end")))


def base_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, access, hex, assign, gaps, gap_at)``: spans of the known forms, leftmost, per kind.

    And what lies between the assignments, with its places.
    """
    text = F.col("text")
    none = F.array().cast(SPANS)
    df = texts(docs).select(
        "doc_id", "text",
        *[F.when(text.rlike(p), _spans(k, _placed(_pieces(text, p)))).otherwise(none).alias(k)
          for k, p in (("access", ACCESS), ("hex", HEX))],
        F.when(text.rlike(ASSIGN), F.struct(
            _pieces(text, ASSIGN).alias("pieces"), F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)).alias("values"),
        )).alias("a"),
    )
    found = F.zip_with(_placed(F.col("a.pieces")), F.col("a.values"), lambda x, v: F.struct(
        x["match"].alias("match"), x["start"].alias("start"), (F.length(v) >= ASSIGN_CHARS).alias("ok")))
    return df.select(
        "doc_id", "access", "hex",
        F.when(F.col("a").isNull(), none).otherwise(_spans("assign", F.filter(found, lambda x: x["ok"]))).alias("assign"),
        F.when(F.col("a").isNull(), F.array("text")).otherwise(F.col("a.pieces.g")).alias("gaps"),
        F.when(F.col("a").isNull(), F.array(F.lit(0).cast("long"))).otherwise(running_starts(F.zip_with(
            "a.pieces.g", "a.pieces.m", lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("long"),
        ))).alias("gap_at"),
    )


def _random_samples(docs: DataFrame) -> DataFrame:
    """``SAMPLES`` strings of each alphabet, 16 to 63 characters, drawn by hash: the same on every run."""
    names = list(ALPHABETS)
    kind = F.col("id") % len(names)
    letters = F.array(*[F.lit(v) for v in ALPHABETS.values()])[kind.cast("int")]
    size = F.lit(16) + F.pmod(F.xxhash64("id", F.lit("size")), F.lit(48))
    drawn = F.transform(F.sequence(F.lit(1), size.cast("int")), lambda i: F.substring(
        letters, (F.pmod(F.xxhash64("id", i), F.length(letters)) + 1).cast("int"), F.lit(1)))
    return docs.sparkSession.range(SAMPLES * len(names), numPartitions=8).select(
        F.lit(True).alias("random"), F.array(*map(F.lit, names))[kind.cast("int")].alias("kind"), F.array_join(drawn, "").alias("string"))


def _named(words: Column, seed: Column) -> Column:
    """The words as one identifier, in a style that the seed chooses."""
    low = F.transform(words, F.lower)
    pascal = F.array_join(F.transform(low, F.initcap), "")
    styles = [
        F.array_join(low, "_"), F.concat(F.substring(low[0], 1, 99), F.array_join(F.transform(
            F.slice(low, 2, F.lit(9)), F.initcap), "")), pascal, F.upper(F.array_join(low, "_")), F.array_join(low, "-"),
        F.concat(F.lit("/"), F.array_join(low, "/")), F.array_join(low, ""), F.concat(F.array_join(low, "_"), F.lit("_"), F.pmod(
            seed, F.lit(3000)).cast("string")), F.concat(pascal, F.pmod(seed, F.lit(100)).cast("string")),
    ]
    at = F.pmod(F.shiftright(seed, 20), F.lit(len(styles)))
    out = styles[-1]
    for k, style in enumerate(styles[:-1]):
        out = F.when(at == k, style).otherwise(out)
    return out


def _identifiers(docs: DataFrame) -> DataFrame:
    """``IDENTIFIERS`` names of two to five of ``NAME_WORDS``, drawn by hash."""
    listed = F.array(*map(F.lit, NAME_WORDS))
    n = F.lit(2) + F.pmod(F.xxhash64("id", F.lit("n")), F.lit(4))
    words = F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: listed[
        F.pmod(F.xxhash64("id", i), F.lit(len(NAME_WORDS))).cast("int")])
    return docs.sparkSession.range(IDENTIFIERS, numPartitions=8).select(
        F.lit(False).alias("random"), F.lit("names").alias("kind"), _named(words, F.xxhash64("id", F.lit("style"))).alias("string"))


def _layouts(docs: DataFrame) -> DataFrame:
    """``LAYOUTS`` rulers, runs of the alphabet, dates and times, drawn by hash."""
    def draw(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(n)).cast("int")

    size = F.lit(16) + draw("size", 60)
    sign = F.substring(F.lit("-=_+/xaA0"), draw("sign", 9) + 1, F.lit(1))
    listed = F.substring(F.array(*[F.lit(v * 3) for v in (
        ascii_sets.ascii_lowercase, ascii_sets.ascii_uppercase, ascii_sets.digits)])[draw("list", 3)], draw("from", 26) + 1, size)
    moment = F.timestamp_seconds(draw("moment", 2_000_000_000))
    dated = F.array(*[F.date_format(moment, form) for form in (
        "yyyy-MM-dd'T'HH-mm-ss", "yyyyMMdd_HHmmss", "yyyy/MM/dd/HH/mm/ss", "yyyy-MM-dd_HH-mm")])[draw("form", 4)]
    return docs.sparkSession.range(LAYOUTS, numPartitions=8).select(
        F.lit(False).alias("random"), F.lit("layout").alias("kind"),
        F.array(F.repeat(sign, size), listed, dated)[draw("style", 3)].alias("string"))


def _corpus_names(docs: DataFrame) -> DataFrame:
    """Names of three neighbouring words each, from about ``WORD_DOCS`` documents chosen by hash."""
    share = max(1, docs.count() // WORD_DOCS)
    runs = F.regexp_extract_all("text", F.lit(r"[A-Za-z]{2,}+"), F.lit(0))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0).select(runs.alias("words"))
    starts = F.when(F.size("words") >= 3, F.sequence(F.lit(1), F.size("words") - 2, F.lit(3))).otherwise(F.array().cast("array<int>"))
    named = F.transform(starts, lambda i: _named(F.slice("words", i, F.lit(3)), F.xxhash64(F.element_at("words", i), i)))
    return chosen.select(F.explode(named).alias("string")).select(F.lit(False).alias("random"), F.lit("corpus").alias("kind"), "string")


def labelled(docs: DataFrame) -> DataFrame:
    """``(random, kind, string)`` for training: each kind gives one model.

    Random are strings drawn from ``ALPHABETS`` and the values of all known secrets of the corpus. Ordinary are names of
    ``NAME_WORDS``, names of the corpus's own words, rulers and dates. Strings of the corpus that no pattern knows are no samples,
    since the unknown secrets are among them. How many are drawn does not grow with the corpus.
    """
    text = F.col("text")
    df = texts(docs)
    none = F.array().cast("array<string>")
    values = F.when(text.rlike(ASSIGN), F.filter(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_CHARS))
    access = F.when(text.rlike(ACCESS), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)))
    found = df.select(F.explode(F.concat(F.coalesce(values, none), F.coalesce(access, none))).alias("string")).select(
        F.lit(True).alias("random"), F.lit("values").alias("kind"), "string")
    for more in (_random_samples(docs), _identifiers(docs), _layouts(docs), _corpus_names(df)):
        found = found.unionByName(more)
    return found


def _steps(string: Column) -> Column:
    """Codes of neighbouring characters as one number each."""
    chars = F.transform(F.split(string, ""), lambda c: F.ascii(c) % CODES)
    return F.zip_with(chars, F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(0))), lambda a, b: a * CODES + b)


def _random_model(counts: dict[int, int]) -> list[float]:
    """Log-probability of each step: additive smoothing over the characters seen, a little for all others."""
    alphabet = {s % CODES for s in counts} | {s // CODES for s in counts}
    sums: dict[int, float] = defaultdict(float)
    for step, n in counts.items():
        sums[step // CODES] += n
    size = max(1, len(alphabet))

    def p(step: int) -> float:
        inside = (counts.get(step, 0) + SMOOTHING) / (sums[step // CODES] + SMOOTHING * size) if step % CODES in alphabet else 0.0
        return (1 - OUTSIDE) * inside + OUTSIDE / CODES

    return [math.log(p(s)) for s in range(CODES * CODES)]


def _sort_of(code: int) -> str:
    char = chr(code)
    return "a" if char.islower() else "A" if char.isupper() else "0" if char.isdigit() else char


def _ordinary_model(counts: dict[int, int]) -> list[float]:
    """Log-probability of each step: characters as counted, mixed with the sorts of characters and letters of either case.

    So capitals of a name cost what its letters cost, even where few names have them.
    """
    plain: dict[int, float] = defaultdict(float)
    sorts: dict[tuple, float] = defaultdict(float)
    letters: dict[tuple, float] = defaultdict(float)
    for step, n in counts.items():
        a, b = divmod(step, CODES)
        plain[a] += n
        sorts[_sort_of(a), _sort_of(b)] += n
        sorts[_sort_of(a), None] += n
        if chr(b).isalpha():
            letters[chr(a).lower(), chr(b).lower()] += n
            letters[chr(a).lower(), None] += n
    n_sorts = max(1, len({_sort_of(s % CODES) for s in counts} | {_sort_of(s // CODES) for s in counts}))

    def p(step: int) -> float:
        a, b = divmod(step, CODES)
        one, other = chr(a), chr(b)
        moved = (sorts[_sort_of(a), _sort_of(b)] + SMOOTHING) / (sorts[_sort_of(a), None] + SMOOTHING * n_sorts)
        inside = 1.0
        if other.isalpha():
            inside = (letters[one.lower(), other.lower()] + SMOOTHING) / (letters[one.lower(), None] + SMOOTHING * 26)
        elif other.isdigit():
            inside = 0.1
        return 0.5 * (counts.get(step, 0) / plain[a] if plain[a] else 0.0) + 0.5 * moved * inside

    return [math.log(p(s)) for s in range(CODES * CODES)]


@dataclass(frozen=True)
class Models:
    """Log-probabilities of steps, a table of ``CODES * CODES`` for each kind, and the least mean ratio of a secret."""

    random: tuple[list[float], ...]
    ordinary: tuple[list[float], ...]
    threshold: float


def fit(samples: DataFrame) -> Models:
    """First-order models, one per kind of sample, and the threshold.

    A fifth of the strings, chosen by hash, is held out. The threshold is half way between the ratio that ``FALSE_ALARMS`` of the
    ordinary ones exceed and the one that ``MISSES`` of the random ones do not reach; if these overlap it is the former. Without samples of both sides the models are uniform. The
    counts are a bounded table whatever the corpus.
    """
    samples = saved(samples, "secrets-samples")
    held = F.pmod(F.xxhash64("string", F.lit("held")), F.lit(HELD_OUT)) == 0
    steps = samples.where(~held).select("random", "kind", F.explode(_steps(F.col("string"))).alias("step")).where("step is not null")
    counts: dict[bool, dict[str, dict[int, int]]] = {True: defaultdict(dict), False: defaultdict(dict)}
    for random, kind, step, n in steps.groupBy("random", "kind", "step").count().collect():
        counts[random][kind][step] = n
    random = tuple(_random_model(counts[True][k]) for k in sorted(counts[True])) or (_random_model({}),)
    ordinary = tuple(_ordinary_model(counts[False][k]) for k in sorted(counts[False])) or (_random_model({}),)
    models = Models(random, ordinary, THRESHOLD)
    checked = samples.where(held & (F.col("kind") != "values") & F.col("string").rlike(f"^{STRING}$")).select(
        "random", _ratio(F.col("string"), models).alias("ratio"))
    high, low = checked.agg(
        F.percentile_approx(F.when(~F.col("random"), F.col("ratio")), 1 - FALSE_ALARMS, 10000),
        F.percentile_approx(F.when(F.col("random"), F.col("ratio")), MISSES, 10000)).first()
    if high is None or low is None:
        return models
    return Models(random, ordinary, max(high, (high + low) / 2))


def _ratio(string: Column, models: Models) -> Column:
    """Mean log-likelihood ratio of the string's steps: the likeliest random model against the likeliest ordinary one."""
    tables = [F.split(F.lit(",".join(f"{x:.4f}" for x in t)), ",").cast("array<double>") for t in (*models.random, *models.ordinary)]

    def step(s: Column, code: Column) -> Column:
        at = s["last"] * CODES + code
        return F.struct(code.alias("last"), *[
            F.when(s["last"] < 0, 0.0).otherwise(s[f"s{k}"] + t[at]).alias(f"s{k}") for k, t in enumerate(tables)])

    def gain(s: Column) -> Column:
        sums = [s[f"s{k}"] for k in range(len(tables))]
        return _greatest(sums[: len(models.random)]) - _greatest(sums[len(models.random) :])

    codes = F.transform(F.split(string, ""), lambda c: F.ascii(c) % CODES)
    start = F.struct(F.lit(-1).alias("last"), *[F.lit(0.0).alias(f"s{k}") for k in range(len(tables))])
    return F.aggregate(codes, start, step, gain) / (F.length(string) - 1)


def _greatest(values: list[Column]) -> Column:
    return F.greatest(*values) if len(values) > 1 else values[0]


def find_secrets(docs: DataFrame, models: Models) -> DataFrame:
    """``(doc_id, spans)``: all spans as ``(start, kind, end)`` by start, then kind; kinds index ``KINDS``.

    The models judge strings of 16 characters or more between the assignments, but for those that are a
    known form from end to end; a string that holds one and more besides is judged whole, and its span covers the known one.
    A null text is empty; an empty one has no spans. Rows map to rows.
    """
    none = F.array().cast(SPANS)

    def strings(gap: Column, start: Column) -> Column:
        judged = F.filter(_placed(_pieces(gap, STRING)), lambda x: ~x["match"].rlike(f"^(?:{ACCESS}|{HEX})$") & (
            _ratio(x["match"], models) >= models.threshold))
        return F.when(gap.rlike(STRING), F.transform(judged, lambda x: F.struct(
            (start + x["start"]).alias("start"), F.lit(KINDS.index("markov")).alias("kind"),
            (start + x["start"] + F.length(x["match"])).alias("end"),
        ))).otherwise(none)

    df = base_spans(docs).withColumn("markov", F.flatten(F.zip_with("gaps", "gap_at", strings)))
    return df.select("doc_id", F.sort_array(F.concat("assign", "access", "hex", "markov")).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per known kind, a hash of the known spans, all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != KINDS.index("markov"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )
