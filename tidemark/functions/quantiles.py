"""Exact quantiles by radix selection: no sketch, no list of values, no sorted column.

The 64 bits of a double can be turned so that they order like the doubles. A
round counts the values per digit of those bits, which combines map-side to at
most 65,536 counts per group, finds the digit in which the wanted rank lies,
and leaves the values with that digit for the next round. Equal values share
all digits, so ties and hot values are counts and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.joins import BROADCAST_ROWS
from tidemark.functions.missing import col
from tidemark.session import scratch_path

DIGIT_BITS = 16
# Where no group has more values left than this, all bits that remain are one digit.
EXACT_LIMIT = 1 << DIGIT_BITS

_HIDDEN = float(1 << 52)


def ordered_bits(value: Column) -> Column:
    """A long that orders like the double; null for null and NaN, equal for both zeros.

    Exponent and fraction come from arithmetic with powers of two, which is
    exact, so the expression stays inside generated code.
    """
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    size = F.abs(v)
    # The logarithm may miss the exponent by one next to a power of two: the fraction then lies outside [1, 2).
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1023))
    part = size / F.pow(F.lit(2.0), guess)
    above = F.when(part < 1.0, part + part - 2.0).when(part >= 2.0, part / 2.0).otherwise(part - 1.0)
    normal = F.shiftleft(guess.cast("long") + 1023, 52) + (above * _HIDDEN).cast("long")
    # Below the least normal number the fraction counts steps of 2 ** -1074.
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    bits = F.when(size == 0.0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(0x7FF << 52)).when(
        size < 2.0**-1022, tiny).otherwise(normal)
    return F.when(v < 0, -1 - bits).when(v.isNotNull(), bits)


def double_of(bits: Column) -> Column:
    """The double that ``ordered_bits`` came from."""
    plain = F.when(bits < 0, -1 - bits).otherwise(bits)
    exponent, fraction = F.shiftright(plain, 52), plain.bitwiseAND((1 << 52) - 1).cast("double")
    size = F.when(plain == 0x7FF << 52, F.lit(float("inf"))).when(
        exponent == 0, fraction * F.lit(2.0**-537) * F.lit(2.0**-537)).otherwise(
        (1.0 + fraction / _HIDDEN) * F.pow(F.lit(2.0), exponent - 1023))
    return F.when(bits < 0, -size).otherwise(size)


def _pick(cells: Column, rank: Column) -> Column:
    """Of ``(digit, n)`` in order of digit: the digit with the rank, the rank inside it, its number of values."""
    def step(state: Column, cell: Column) -> Column:
        upto = state["upto"] + cell["n"]
        here = state["digit"].isNull() & (upto > rank)
        return F.struct(
            upto.alias("upto"), F.when(here, cell["digit"]).otherwise(state["digit"]).alias("digit"),
            F.when(here, rank - state["upto"]).otherwise(state["rank"]).alias("rank"),
            F.when(here, cell["n"]).otherwise(state["n"]).alias("n"))

    none = F.lit(None).cast("long")
    return F.aggregate(cells, F.struct(
        F.lit(0).cast("long").alias("upto"), none.alias("digit"), none.alias("rank"), none.alias("n")), step)


def _searches(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame, int]:
    """The searches, computed now: prefixes ``(__k..., __prefix)``, once each, the same with the ranks ``__asked``, and the
    most values any search has left. Few searches are broadcast, many are written and joined by shuffle.
    """
    spark = df.sparkSession
    names = [f"__k{i}" for i in range(len(by))]
    rows = df.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        path = scratch_path(spark, "quantiles")
        df.write.parquet(path)
        stored = spark.read.schema(df.schema).parquet(path)
        asked = stored.groupBy(*[col(b).alias(n) for b, n in zip(by, names)], "__prefix").agg(F.collect_list(
            F.struct(F.col("__side").alias("side"), F.col("__rank").alias("rank"), F.col("__weight").alias("weight"))).alias("__asked"))
        return asked.select(*names, "__prefix"), asked, stored.agg(F.max("__n").alias("n")).first()["n"]
    # The two ranks of a group mostly share their prefix.
    groups: dict[str, tuple] = {}
    for r in rows:
        key = (*(r[b] for b in by), r["__prefix"])
        groups.setdefault(repr(key), (key, []))[1].append((r["__side"], r["__rank"], r["__weight"]))
    prefix = T.StructType([T.StructField(n, df.schema[b].dataType) for n, b in zip(names, by)] + [T.StructField("__prefix", T.LongType())])
    asked = T.StructType([*prefix.fields, T.StructField("__asked", T.ArrayType(T.StructType([
        T.StructField("side", T.IntegerType()), T.StructField("rank", T.LongType()), T.StructField("weight", T.DoubleType())])))])
    return (
        F.broadcast(spark.createDataFrame([k for k, _ in groups.values()], prefix)),
        F.broadcast(spark.createDataFrame([(*k, found) for k, found in groups.values()], asked)),
        max((r["__n"] for r in rows), default=0))


def _select(rows: DataFrame, by: Sequence[str], q: Column, exact_limit: int) -> DataFrame:
    """``(by..., __x)`` from rows ``(by..., __bits)``: the interpolated quantile ``q`` of each group."""
    keys = [col(b) for b in by]
    counts = rows.groupBy(*keys, F.shiftright("__bits", 64 - DIGIT_BITS).cast("long").alias("digit")).agg(F.count("*").alias("n"))
    groups = counts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("digit", "n"))).alias("__cells"), F.sum("n").alias("__total"))
    position = q * (F.col("__total") - 1)
    # Both ranks next to the position are searched for, each by a row of its own.
    wanted = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.floor(position).alias("rank")),
                               F.struct(F.lit(1).alias("side"), F.ceil(position).alias("rank"))))
    searches = groups.select(*keys, (position - F.floor(position)).alias("__weight"), "__cells", wanted.alias("__w")).select(
        *keys, "__weight", F.col("__w.side").alias("__side"), _pick(F.col("__cells"), F.col("__w.rank")).alias("__p")).select(
        *keys, "__weight", "__side", F.col("__p.digit").alias("__prefix"), F.col("__p.rank").alias("__rank"), F.col("__p.n").alias("__n"))
    left = 64 - DIGIT_BITS
    while left:
        prefixes, asked, most = _searches(searches, by)
        width = left if most <= exact_limit else min(left, DIGIT_BITS)
        searches = _narrow(rows, prefixes, asked, by, left, width)
        left -= width
    x0, x1 = (F.max(F.when(F.col("__side") == s, double_of(F.col("__prefix")))) for s in (0, 1))
    ends = searches.groupBy(*keys).agg(x0.alias("__x0"), x1.alias("__x1"), F.max("__weight").alias("__weight"))
    between = F.col("__x0") + (F.col("__x1") - F.col("__x0")) * F.col("__weight")
    return ends.select(*keys, F.when(F.col("__x0") == F.col("__x1"), F.col("__x0")).otherwise(between).alias("__x"))


def _narrow(rows: DataFrame, open_: DataFrame, asked: DataFrame, by: Sequence[str], left: int, width: int) -> DataFrame:
    """The searches with ``width`` more bits, of ``left`` unknown ones, in their prefix."""
    prefixes = [F.col(f"__k{i}") for i in range(len(by))]
    match = [*[col(b).eqNullSafe(k) for b, k in zip(by, prefixes)], F.shiftright("__bits", left) == F.col("__prefix")]
    digit = F.shiftright("__bits", left - width).bitwiseAND((1 << width) - 1)
    counts = rows.join(open_, match).groupBy(*prefixes, "__prefix", digit.alias("digit")).agg(F.count("*").alias("n"))
    cells = counts.groupBy(*prefixes, "__prefix").agg(F.sort_array(F.collect_list(F.struct("digit", "n"))).alias("__cells"))
    theirs = asked.withColumnsRenamed({f"__k{i}": f"__o{i}" for i in range(len(by))} | {"__prefix": "__op"})
    joined = cells.join(theirs, [
        *[k.eqNullSafe(F.col(f"__o{i}")) for i, k in enumerate(prefixes)], F.col("__prefix") == F.col("__op")])
    found = joined.select(*prefixes, "__prefix", "__cells", F.explode("__asked").alias("__a")).select(
        *prefixes, "__prefix", "__a.*", _pick(F.col("__cells"), F.col("__a.rank")).alias("__p"))
    return found.select(
        *[k.alias(b) for k, b in zip(prefixes, by)], F.col("weight").alias("__weight"), F.col("side").alias("__side"),
        F.shiftleft("__prefix", width).bitwiseOR(F.col("__p.digit")).alias("__prefix"), F.col("__p.rank").alias("__rank"),
        F.col("__p.n").alias("__n"))


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, tuple[Column, float]], exact_limit: int = EXACT_LIMIT
) -> dict[str, float | None]:
    """Exact interpolated quantile of each named expression over the whole frame; None without values.

    All names are searched for in the same rounds, four at most.
    """
    if not wanted:
        return {}
    pairs = [F.struct(F.lit(i).alias("__i"), ordered_bits(c).alias("__bits")) for i, (c, _) in enumerate(wanted.values())]
    rows = df.select(F.explode(F.array(*pairs)).alias("__p")).select("__p.*").where(F.col("__bits").isNotNull())
    q = F.element_at(F.array(*[F.lit(float(q)) for _, q in wanted.values()]), F.col("__i") + 1)
    found = {r["__i"]: r["__x"] for r in _select(rows, ["__i"], q, exact_limit).collect()}
    return {name: found.get(i) for i, name in enumerate(wanted)}


def grouped_quantile(
    df: DataFrame, by: Sequence[str], value: str, q: float, out: str, exact_limit: int = EXACT_LIMIT
) -> DataFrame:
    """Exact interpolated quantile per group; null keys are a group, groups without values have no row."""
    if not by:
        raise ValueError("use exact_quantiles for the whole frame")
    # Generated rows keep the expression in one place; a plain projection would be copied to where it is used.
    bits = F.explode(F.array(ordered_bits(col(value)))).alias("__bits")
    rows = df.select(*[col(b) for b in by], bits).where(F.col("__bits").isNotNull())
    return _select(rows, by, F.lit(float(q)), exact_limit).withColumnRenamed("__x", out)
