"""Lenient number parsing and order-independent variance."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amounts are money. Sums of decimals do not depend on the order of the rows,
# so ties and `<` tests come out the same under any partitioning.
DIGITS = 18
SCALE = 2
MONEY = f"decimal({DIGITS},{SCALE})"

# Squares are summed in three parts: an amount in its smallest unit is high * LIMB + low.
LIMB = 10**9
TOO_LARGE = "has more digits than are kept"
SQUARE_SUMS = ("high", "low", "high_high", "high_low", "low_low")


def parse_int(c: Column) -> Column:
    return c.try_cast("int")


def parse_id(c: Column) -> Column:
    return c.try_cast("bigint")


def parse_double(c: Column) -> Column:
    return c.try_cast("double")


def too_fine(scale: int) -> str:
    return f"has more than {scale} decimals; pass a larger scale"


def money(c: Column, scale: int = SCALE) -> Column:
    """Text amount in exact units of 10^-scale; blank, malformed and non-finite become NULL.

    `money_fault` says what else the type does to an amount.
    """
    return parse_double(c).try_cast(f"decimal({DIGITS},{scale})")


def money_fault(c: Column, scale: int = SCALE) -> Column:
    """NULL for an amount that `money` keeps as it is; else missing, malformed, out_of_range or rounded."""
    value, kept = parse_double(c), money(c, scale)
    return (
        F.when(F.coalesce(F.trim(c), F.lit("")) == "", "missing")
        .when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), "malformed")
        .when(kept.isNull(), "out_of_range")
        .when(kept.cast("double") != value, "rounded")
    )


def checked_money(c: Column, scale: int = SCALE) -> Column:
    """As `money`, but a value that the type would lose or change is an error when the row is read."""
    value, kept = parse_double(c), money(c, scale)
    number = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    refuse = lambda why: F.raise_error(F.concat(F.lit("Amount '"), c, F.lit(f"' {why}"))).cast(f"decimal({DIGITS},{scale})")
    return (
        F.when(number & kept.isNull(), refuse(TOO_LARGE))
        .when(number & (kept.cast("double") != value), refuse(too_fine(scale)))
        .otherwise(kept)
    )


def square_sums(amount: Column, scale: int = SCALE) -> dict[str, Column]:
    """Five sums that stand for the sum and the sum of squares and fit 38 digits for any number of rows that can occur.

    The parts of an amount have nine digits or less, so a product has 18 and 10^19 rows are not too many.
    """
    units = (amount * F.lit(10**scale)).cast("decimal(20,0)")
    high = F.floor(units / LIMB).cast("decimal(11,0)")
    low = (units - high * LIMB).cast("decimal(10,0)")
    parts = (high, low, high * high, high * low, low * low)
    return {name: F.sum(part.cast("decimal(24,0)")) for name, part in zip(SQUARE_SUMS, parts, strict=True)}


#: Values by name, as the lines of the reckoning below see them.
Values = Callable[[str], Column]

#: From a count n (1 at least) and the square sums to n times the sum of squares less the squared sum, exactly. Each
#: line uses values of the sums and of lines before it, so all of a line are worked out at once, each once.
LINES: tuple[dict[str, Callable[[Values], Column]], ...] = (
    {"total": lambda v: _whole(v("high") * LIMB) + v("low")},
    # The mean is mean_high * LIMB + mean_low and rest / n.
    {"rest": lambda v: _long(F.pmod(v("total"), v("n")))},
    {"mean": lambda v: _over(v("total") - v("rest"), v("n"))},
    {"mean_low": lambda v: F.pmod(v("mean"), F.lit(LIMB))},
    {"mean_high": lambda v: _over(v("mean") - v("mean_low"), F.lit(LIMB))},
    # Squares about the whole mean: hh * LIMB^2 + hl * LIMB + ll.
    {
        "hh": lambda v: _whole(_moved(v, "high_high", v("mean_high") * 2, "high") + _times(v("n"), v("mean_high") * v("mean_high"))),
        "hl": lambda v: _whole(
            (_moved(v, "high_low", v("mean_high"), "low") - _times(v("mean_low"), v("high")) + _times(v("n"), v("mean_high") * v("mean_low"))) * 2
        ),
        "ll": lambda v: _whole(_moved(v, "low_low", v("mean_low") * 2, "low") + _times(v("n"), v("mean_low") * v("mean_low"))),
    },
    # The same as up * LIMB^2 + down.
    {"middle": lambda v: _long(F.pmod(v("hl"), F.lit(LIMB)))},
    {"lower": lambda v: _whole(v("ll") + v("middle") * LIMB)},
    {"down": lambda v: _long(F.pmod(v("lower"), F.lit(LIMB * LIMB)))},
    {"up": lambda v: _whole(v("hh") + _whole((v("hl") - v("middle")) / F.lit(LIMB)) + _whole((v("lower") - v("down")) / F.lit(LIMB * LIMB)))},
    # n times that, less rest * rest: top * LIMB^4 + mid * LIMB^2 + end.
    {"up_end": lambda v: _long(F.pmod(v("up"), F.lit(LIMB * LIMB))), "ends": lambda v: _whole(_times(v("n"), v("down")) - _times(v("rest"), v("rest")))},
    {"up_top": lambda v: _over(v("up") - v("up_end"), F.lit(LIMB * LIMB)), "end": lambda v: _long(F.pmod(v("ends"), F.lit(LIMB * LIMB)))},
    {"mids": lambda v: _whole(_times(v("n"), v("up_end")) + _whole((v("ends") - v("end")) / F.lit(LIMB * LIMB)))},
    {"mid": lambda v: _long(F.pmod(v("mids"), F.lit(LIMB * LIMB)))},
    {"top": lambda v: _whole(_times(v("n"), v("up_top")) + _whole((v("mids") - v("mid")) / F.lit(LIMB * LIMB)))},
)


def _variance(v: Values, n: Column, scale: int) -> Column:
    """The last line: n times the squares less the squared sum, rounded once from all its digits, over n * n."""
    digits = 2 * len(str(LIMB)) - 2
    written = F.concat(
        v("top").cast("string"),
        *[F.lpad(v(limb).cast("string"), digits, "0") for limb in ("mid", "end")],
        F.lit(f"E-{2 * scale}"),
    )
    counted = v("n").cast("double")
    return F.when(n > 0, written.cast("double") / (counted * counted))


def _inputs(n: Column, sums: Mapping[str, Column]) -> dict[str, Column]:
    known = {name: F.coalesce(_whole(sums[name]), _whole(F.lit(0))) for name in SQUARE_SUMS}
    return {"n": F.greatest(F.coalesce(n, F.lit(0)).cast("bigint"), F.lit(1).cast("bigint"))} | known


def population_variance(n: Column, sums: Mapping[str, Column], scale: int = SCALE) -> Column:
    """Variance of n amounts from their square sums, as one expression; NULL when n is 0.

    Lambdas keep its lines apart, which are interpreted; over many rows `with_variances` is the faster way.
    """

    def line(number: int, record: Column, names: list[str]) -> Column:
        v = lambda name: record[name]
        if number == len(LINES):
            return _variance(v, v("known"), scale)
        more = {name: value(v) for name, value in LINES[number].items()}
        together = F.struct(*[v(x).alias(x) for x in names], *[value.alias(x) for x, value in more.items()])
        return F.transform(F.array(together), lambda r: line(number + 1, r, [*names, *more]))[0]

    values = _inputs(n, sums) | {"known": n}
    first = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.transform(F.array(first), lambda r: line(0, r, list(values)))[0]


def with_variances(rows: DataFrame, groups: Mapping[str, tuple[str, Mapping[str, str]]], scale: int = SCALE) -> DataFrame:
    """The rows with a column for each group of amounts, its variance, from the names of its count and of its square sums.

    Each line of the reckoning is a projection. The optimiser does not merge projections whose values are used more
    than once, so each value is worked out once, in compiled code.
    """

    def values(group: str) -> Values:
        return lambda name: F.col(f"__{group}_{name}")

    def named(group: str, made: Mapping[str, Column]) -> dict[str, Column]:
        return {f"__{group}_{name}": value for name, value in made.items()}

    frame = rows
    for line in (None, *LINES):
        new: dict[str, Column] = {}
        for group, (n, sums) in groups.items():
            own = _inputs(F.col(n), {k: F.col(c) for k, c in sums.items()}) if line is None else {k: f(values(group)) for k, f in line.items()}
            new |= named(group, own)
        frame = frame.withColumns(new)
    return frame.select(*rows.columns, *[_variance(values(g), F.col(n), scale).alias(g) for g, (n, _) in groups.items()])


def _moved(v: Values, squares: str, twice: Column, values: str) -> Column:
    """A sum of squares or products less what moving their middle takes."""
    return v(squares) - _times(twice, v(values))


def _over(value: Column, base: Column) -> Column:
    """The quotient of a multiple of the base, as a long."""
    return F.call_function("div", value, base)


def _times(a: Column, b: Column) -> Column:
    return _whole(a.cast("decimal(38,0)") * b)


def _long(value: Column) -> Column:
    return value.cast("bigint")


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")
